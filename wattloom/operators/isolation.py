"""Isolation forest as Spark work: trees grow from hashed subsamples, rows are scored in batches.

The forest is fixed in size (trees x 256 sampled rows), so growing it never depends on how much
data there is; only counting, sampling and scoring pass over the rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TREES = 150
SAMPLE = 256
SEED = 42
DEPTH = math.ceil(math.log2(SAMPLE))
_NODES = "feature array<int>, threshold array<double>, left array<int>, right array<int>, length array<double>"


def expected_length(n: int) -> float:
    """Mean path length of an unsuccessful search among n values."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def grow_tree(values: np.ndarray, rng: np.random.Generator) -> dict[str, list]:
    """One isolation tree as parallel node arrays; a leaf carries its adjusted path length."""
    tree: dict[str, list] = {"feature": [], "threshold": [], "left": [], "right": [], "length": []}

    def add(rows: np.ndarray, depth: int) -> int:
        node = len(tree["feature"])
        for name, start in (("feature", -1), ("threshold", 0.0), ("left", node), ("right", node), ("length", 0.0)):
            tree[name].append(start)
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(0), np.zeros(0))
        usable = np.flatnonzero(high > low)
        if depth >= DEPTH or len(rows) <= 1 or not len(usable):
            tree["length"][node] = depth + expected_length(len(rows))
            return node
        feature = int(rng.choice(usable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        below = rows[:, feature] <= threshold
        tree["feature"][node], tree["threshold"][node] = feature, threshold
        tree["left"][node] = add(rows[below], depth + 1)
        tree["right"][node] = add(rows[~below], depth + 1)
        return node

    add(values, 0)
    return tree


def fit_forest(rows: DataFrame, identity: list[str], features: list[str], trees: int = TREES, seed: int = SEED) -> list[dict]:
    """Grow the forest: 256 rows per tree, picked by hash, one tree per group.

    Rows are dealt to trees by a hash of their identity; with fewer rows than the forest needs, a
    row is dealt to several trees. The sampled rows are bounded by the size of the forest.
    """
    pool = trees * SAMPLE
    total = max(rows.count(), 1)
    copies = max(1, math.ceil(1.3 * pool / total))
    share = min(1.0, 1.3 * pool / (total * copies))
    key = ", ".join(identity)
    space = 2**31
    dealt = (
        rows.selectExpr(*identity, *features, f"explode(sequence(1, {copies})) as _copy")
        .where(f"pmod(xxhash64({key}, _copy, {seed}), {space}L) < {int(share * space)}L")
        .selectExpr(
            *features,
            f"cast(pmod(xxhash64({key}, _copy, {seed + 1}), {trees}L) as int) as tree",
            f"xxhash64({key}, _copy, {seed + 2}) as _order",
            f"xxhash64({key}) as _row",
        )
    )

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        sample = group.drop_duplicates("_row").sort_values("_order").head(SAMPLE)  # a row is in a tree once
        number = int(sample["tree"].iloc[0])
        grown = grow_tree(sample[features].to_numpy(dtype=float), np.random.default_rng(seed + number))
        return pd.DataFrame([{"tree": number, "size": len(sample), **grown}])

    return [
        row.asDict() for row in dealt.groupBy("tree").applyInPandas(grow, f"tree int, size int, {_NODES}").orderBy("tree").collect()
    ]


def score(rows: DataFrame, features: list[str], forest: list[dict], name: str = "iso_score") -> DataFrame:
    """Anomaly score of each row: 2 to the minus mean path length over the expected one."""
    arrays = [
        (
            np.array(t["feature"]),
            np.array(t["threshold"]),
            np.array(t["left"]),
            np.array(t["right"]),
            np.array(t["length"]),
        )
        for t in forest
    ]
    norm = expected_length(max(t["size"] for t in forest)) or 1.0
    shared = rows.sparkSession.sparkContext.broadcast(arrays)

    @F.pandas_udf("double")
    def path_score(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        rows_at = np.arange(len(x))
        length = np.zeros(len(x))
        for feature, threshold, left, right, leaf in shared.value:
            node = np.zeros(len(x), dtype=int)
            for _ in range(DEPTH):
                below = x[rows_at, np.maximum(feature[node], 0)] <= threshold[node]
                node = np.where(below, left[node], right[node])
            length += leaf[node]
        return pd.Series(np.power(2.0, -length / (len(shared.value) * norm)))

    return rows.withColumn(name, path_score(*[F.col(c) for c in features]))
