"""The global boosted forecaster: scaled target, early stopping, quantile bands, persistence."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.scalars import sorted_row
from wattloom.operators import metrics
from wattloom.operators.windows import global_stats, target_stats, with_target_stats
from wattloom.plans.bands import QuantileTrees, fit_bands, load_bands, save_bands
from wattloom.plans.baselines import build_all_baselines
from wattloom.plans.features import FEATURES, TARGET, training_split
from wattloom.schemas import QUANTILES
from wattloom.session import shared_folder, side_by_side, written

# Training settings (quick, full).
ROUNDS = {True: 20, False: 200}
STEP = {True: 0.3, False: 0.1}
MIN_ROWS_PER_LEAF = 60
HYBRID_COVERAGE = 0.9
#: The key is a category through so many hash buckets, whatever the number of keys; few keys have a bucket each.
KEY_BUCKETS = 256
BAND_COLUMNS = [f"pred_gbm_p{int(q * 100)}" for q in QUANTILES]


@dataclass
class Forecaster:
    """A fitted pipeline with the figures that bring its output back to physical units."""

    pipeline: PipelineModel
    features: list[str]
    stats: DataFrame
    overall: DataFrame
    bands: list[QuantileTrees] | None = None

    def predict(self, frame: DataFrame, name: str = "pred_gbm") -> DataFrame:
        """Point forecast, and the bands in ascending order where they were fitted."""
        scored = self.pipeline.transform(with_target_stats(frame, self.stats, self.overall))
        kept = list(frame.columns)
        columns = [f"prediction * _spread + _centre as {name}"]
        for quantile, column in zip(self.bands or [], BAND_COLUMNS):
            scored = quantile.attach(scored, f"_{column}")
            columns.append(f"(prediction + _{column}) * _spread + _centre as {column}")
        result = scored.selectExpr(*kept, *columns)
        if self.bands is not None:
            ordered = sorted_row(BAND_COLUMNS)
            result = result.selectExpr(*kept, name, *[f"{text} as {c}" for c, text in ordered.items()])
        return result

    def importance(self, top: int = 25) -> DataFrame:
        """Features by gain; the figures are as many as there are features."""
        spark = self.stats.sparkSession
        gains = self.pipeline.stages[-1].featureImportances.toArray()
        names = self.pipeline.stages[-2].getInputCols()
        rows = [(n.removesuffix("_imputed"), float(g)) for n, g in zip(names, gains, strict=True)]
        return spark.createDataFrame(rows, "feature string, gain double").orderBy(F.desc("gain"), "feature").limit(top)

    def save(self, folder: str) -> None:
        self.pipeline.write().overwrite().save(f"{folder}/pipeline")
        for name, table in {"stats": self.stats, "overall": self.overall}.items():
            table.write.mode("overwrite").parquet(f"{folder}/{name}")
        spark = self.stats.sparkSession
        if self.bands is not None:
            save_bands(spark, self.bands, f"{folder}/bands")
        meta = [(self.features, self.bands is not None, self.pipeline.stages[-1].getNumTrees, list(QUANTILES), KEY_BUCKETS)]
        spark.createDataFrame(meta, "features array<string>, has_bands boolean, rounds int, quantiles array<double>, key_buckets int").write.mode("overwrite").json(f"{folder}/meta")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Forecaster:
        meta = spark.read.schema("features array<string>, has_bands boolean").json(f"{folder}/meta").first()
        return cls(
            PipelineModel.load(f"{folder}/pipeline"), list(meta["features"]),
            spark.read.parquet(f"{folder}/stats"), spark.read.parquet(f"{folder}/overall"),
            load_bands(spark, f"{folder}/bands") if meta["has_bands"] else None,
        )


@dataclass
class TrainingRows:
    """Labelled train and validation rows, written once, with the figures that scale their target."""

    labelled: DataFrame
    stats: DataFrame
    overall: DataFrame


def training_rows(train: DataFrame, valid: DataFrame, features: list[str]) -> TrainingRows:
    """Every model whose inputs are among ``features`` can be fitted on the same rows."""
    stats, overall = side_by_side(
        train.sparkSession, lambda: written(target_stats(train), "target_stats"), lambda: written(global_stats(train), "global_stats")
    )
    between = F.expr("datediff(to_date(period_utc), date'1970-01-01') % 2 = 1")
    both = train.withColumns({"_valid": F.lit(False), "_band": F.lit(False)}).unionByName(valid.withColumns({"_valid": F.lit(True), "_band": between}))
    labelled = with_target_stats(both, stats, overall).selectExpr(
        "*", f"({TARGET} - _centre) / _spread as _label"
    ).where("_label is not null")
    labelled = written(
        labelled.withColumns({c: F.col(c).cast("double") for c in features}), "training_rows"
    )
    return TrainingRows(labelled, stats, overall)


def fit_forecaster(
    train: DataFrame, valid: DataFrame, features: list[str] | None = None, quick: bool = False, bands: bool = True, rounds: int | None = None,
    rows: TrainingRows | None = None,
) -> Forecaster:
    """Fit on the train rows, stop early on every other validation day, boost the bands on the residuals of the days between.

    The key is a categorical feature by its hash bucket; the scaled target and the lags carry the
    level of keys that share one. ``rows`` are the training rows, where they are written already.
    """
    spark = train.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    features = list(features or FEATURES)
    rows = rows or training_rows(train, valid, features)
    labelled, stats, overall = rows.labelled, rows.stats, rows.overall
    imputed = [f"{c}_imputed" for c in features]
    bucket = f"lpad(cast(pmod(xxhash64(ba_code), {KEY_BUCKETS}) as string), 3, '0')"
    stages = [
        Imputer(strategy="median", inputCols=features, outputCols=imputed),
        SQLTransformer(statement=f"SELECT *, {bucket} AS _bucket FROM __THIS__"),
        StringIndexer(inputCol="_bucket", outputCol="_key", stringOrderType="alphabetAsc", handleInvalid="keep"),
        VectorAssembler(inputCols=[*imputed, "_key"], outputCol="_features", handleInvalid="keep"),
        GBTRegressor(
            featuresCol="_features", labelCol="_label", validationIndicatorCol="_valid", validationTol=0.0, maxIter=rounds or ROUNDS[quick],
            stepSize=STEP[quick], maxDepth=6, maxBins=KEY_BUCKETS + 2, subsamplingRate=0.8,
            featureSubsetStrategy="0.8", minInstancesPerNode=MIN_ROWS_PER_LEAF, checkpointInterval=10, seed=42,
        ),
    ]
    model = Pipeline(stages=stages).fit(labelled.where("not _band"))
    fitted = Forecaster(model, features, stats, overall)
    if bands:
        residuals = model.transform(labelled.where("_band")).selectExpr("_features", "_label - prediction as _residual")
        fitted.bands = fit_bands(written(residuals, "residuals"), QUANTILES, KEY_BUCKETS + 2, MIN_ROWS_PER_LEAF)
    return fitted


def benchmark_coverage(train: DataFrame) -> float:
    """Share of training rows with a published forecast."""
    return train.agg(F.expr("avg(cast(demand_forecast_mwh is not null as double))")).first()[0] or 0.0


@dataclass
class TrainingRun:
    model: Forecaster
    hybrid: Forecaster | None
    predictions: DataFrame
    leaderboard: DataFrame
    coverage_pct: float | None


def baseline_rows(frame: DataFrame) -> DataFrame:
    """The test rows with their baselines. The earlier rows only lend their demand, so they travel without their features."""
    needed = ["period_utc", "ba_code", TARGET, "demand_forecast_mwh", "split"]
    others = [c for c in frame.columns if c not in needed]
    narrow = frame.selectExpr(*needed, f"case when split = 'test' then struct({', '.join(others)}) end as _others")
    rows = build_all_baselines(narrow).where("split = 'test'")
    return rows.selectExpr(*[c for c in rows.columns if c not in ("split", "pred_drift_naive", "_others")], "_others.*")


def train_all(
    frame: DataFrame, test_days: int = 90, valid_days: int = 60, quick: bool = False, rounds: int | None = None, dated: DataFrame | None = None
) -> TrainingRun:
    """Features to leaderboard: baselines, point model with bands, hybrid and ensemble on the test rows.

    ``dated`` has the hours of ``frame`` without its features, so that these are not made twice to find the last hour.
    """
    from wattloom.functions.scalars import row_mean

    frame = written(training_split(frame, test_days, valid_days, dated=dated), "features")
    train, valid = (frame.where(f"split = '{s}'").drop("split") for s in ("train", "valid"))
    inputs = [FEATURES]
    if benchmark_coverage(train) > HYBRID_COVERAGE:
        inputs.append([*FEATURES, "demand_forecast_mwh"])
    rows = training_rows(train, valid, inputs[-1])

    def fit(features: list[str]) -> Forecaster:
        return fit_forecaster(train, valid, features, quick, bands=features is FEATURES, rounds=rounds, rows=rows)

    def point() -> tuple[Forecaster, DataFrame]:
        model, tested = side_by_side(frame.sparkSession, lambda: fit(FEATURES), lambda: written(baseline_rows(frame), "baselines"))
        return model, written(model.predict(tested), "point_predictions")

    # A round is a row of small jobs, one a level of its tree; the models do not wait for each other's, and what
    # needs none or one of them is written meanwhile.
    (model, predictions), *others = side_by_side(frame.sparkSession, point, *[partial(fit, i) for i in inputs[1:]])
    hybrid, parts = others[0] if others else None, ["pred_gbm"]
    if hybrid:
        predictions = hybrid.predict(predictions, "pred_gbm_hybrid")
        parts.append("pred_gbm_hybrid")
    if len(parts) > 1:
        predictions = predictions.selectExpr("*", f"{row_mean(parts)} as pred_ensemble")
    wanted = [c for c in predictions.columns if c.startswith("pred_")]
    predictions = written(
        predictions.select("period_utc", "ba_code", "demand_mwh", "demand_forecast_mwh", "demand_lag_24h", "demand_lag_168h", *wanted),
        "model_predictions",
    )
    covered = metrics.coverage(predictions, [], BAND_COLUMNS[0], BAND_COLUMNS[-1], TARGET).first()
    share = covered[0] if covered else None
    board = metrics.leaderboard(predictions)
    note = f"case when model = 'gbm' then {'cast(null as double)' if share is None else f'round({share}D, 2)'} end"
    board = written(board.selectExpr("*", f"{note} as p10_p90_coverage_pct"), "leaderboard")
    return TrainingRun(model, hybrid, predictions, board, share)


def stamped_scores(board: DataFrame, test_start: str, trained_at: str = "current_timestamp()") -> DataFrame:
    """Leaderboard rows for the append log of scores."""
    return board.selectExpr("*", f"{trained_at} as trained_at_utc", f"{test_start} as test_window_start")
