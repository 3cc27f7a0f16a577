"""Quantile bands around a point forecast: trees boosted on the quantile loss of held-out residuals.

Each stage grows a small tree on the sign of what is left of the residual and gives every leaf the
exact quantile of what is left in it, shrunk. All rows stay on the executors; a stage brings back one
figure a leaf, so what reaches the driver is bounded by the model.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession

from wattloom.operators.quantiles import grouped_quantiles

STAGES = 6
STEP = 0.5
DEPTH = 3


@dataclass
class QuantileTrees:
    """One quantile: a constant, and trees with a shift a leaf. The constant is None if there was no residual."""

    start: float | None
    trees: list[DecisionTreeRegressionModel] = field(default_factory=list)
    shifts: list[list[float]] = field(default_factory=list)

    def attach(self, df: DataFrame, name: str) -> DataFrame:
        """Adds the quantile of the residual, given the assembled features."""
        kept, terms = df.columns, ["cast(null as double)" if self.start is None else f"{self.start!r}D"]
        for i, (tree, shifts) in enumerate(zip(self.trees, self.shifts, strict=True)):
            leaf = f"_leaf_{name}_{i}"
            df = tree.transform(df, {tree.leafCol: leaf, tree.predictionCol: ""})
            terms.append(f"element_at(array({', '.join(f'{s!r}D' for s in shifts)}), cast({leaf} as int) + 1)")
        return df.selectExpr(*kept, f"{' + '.join(terms)} as {name}")


def fit_quantile(rows: DataFrame, q: float, max_bins: int, min_rows: int, stages: int = STAGES) -> QuantileTrees:
    """Boosts one quantile of ``_residual`` on ``_features``. Too few rows to split leave the constant alone."""
    return fit_bands(rows, [q], max_bins, min_rows, stages)[0]


def fit_bands(rows: DataFrame, quantiles: list[float], max_bins: int, min_rows: int, stages: int = STAGES) -> list[QuantileTrees]:
    """Boosts the quantiles stage by stage: the trees of a stage grow side by side, and one pass finds the shifts of all their leaves.

    ``rows`` hold ``_features`` and ``_residual`` and are read often: pass a written table.
    """
    overall = grouped_quantiles(rows, [], "_residual", {f"v{i}": q for i, q in enumerate(quantiles)}).first()
    fitted = [QuantileTrees(overall[f"v{i}"] if overall else None) for i in range(len(quantiles))]
    growing = [i for i, one in enumerate(fitted) if one.start is not None]
    share = f"case _of {' '.join(f'when {i} then {q}D' for i, q in enumerate(quantiles))} end"

    def grow(place: int, stage: int) -> tuple[DecisionTreeRegressionModel, DataFrame]:
        """A tree on the side of the quantile a row is on, and the rows with their leaf."""
        q = quantiles[place]
        left = fitted[place].attach(rows.select("_features", "_residual"), "_shift").selectExpr(
            "_features", "_residual - _shift as _left", f"case when _residual > _shift then {q}D else {q}D - 1 end as _side"
        )
        tree = DecisionTreeRegressor(
            featuresCol="_features", labelCol="_side", leafCol="_leaf", maxDepth=DEPTH, maxBins=max_bins,
            minInstancesPerNode=min_rows, seed=42 + stage,
        ).fit(left)
        return tree, tree.transform(left).selectExpr(f"{place} as _of", "cast(_leaf as int) as _leaf", "_left")

    job = inheritable_thread_target(rows.sparkSession)(grow)
    with ThreadPoolExecutor(max(len(growing), 1)) as pool:
        for stage in range(stages):
            grown = dict(zip(growing, pool.map(job, growing, [stage] * len(growing)), strict=True))
            growing = [i for i in growing if grown[i][0].depth]
            if not growing:
                break
            placed = reduce(DataFrame.unionByName, [grown[i][1] for i in growing])
            found = {
                (r["_of"], r["_leaf"]): r["v"]
                for r in grouped_quantiles(placed, ["_of", "_leaf"], "_left", {"v": f"{share} * (_total - 1)"}).collect()
            }
            for i in growing:
                tree = grown[i][0]
                fitted[i].trees.append(tree)
                fitted[i].shifts.append([STEP * found.get((i, leaf), 0.0) for leaf in range((tree.numNodes + 1) // 2)])
    return fitted


def save_bands(spark: SparkSession, bands: list[QuantileTrees], folder: str) -> None:
    """The trees as one pipeline in order, and a row a quantile with its constant and shifts."""
    PipelineModel([t for b in bands for t in b.trees]).write().overwrite().save(f"{folder}/trees")
    rows = [(i, b.start, b.shifts) for i, b in enumerate(bands)]
    shape = "place int, start double, shifts array<array<double>>"
    spark.createDataFrame(rows, shape).coalesce(1).write.mode("overwrite").parquet(f"{folder}/shifts")


def load_bands(spark: SparkSession, folder: str) -> list[QuantileTrees]:
    trees = iter(PipelineModel.load(f"{folder}/trees").stages)
    rows = spark.read.parquet(f"{folder}/shifts").orderBy("place").collect()
    return [QuantileTrees(r["start"], [next(trees) for _ in r["shifts"]], [list(s) for s in r["shifts"]]) for r in rows]
