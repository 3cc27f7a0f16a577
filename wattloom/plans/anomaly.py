"""Anomalous hours: seasonal z-score, isolation forest, day shape and rules, by votes."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import half_up, only_finite, severity
from wattloom.operators import isolation
from wattloom.operators.chunking import with_previous
from wattloom.operators.quantiles import grouped_quantiles
from wattloom.session import written

# Thresholds of the detectors.
Z_THRESHOLD = 4.0
CONTAMINATION = 0.01
SHAPE_PERCENTILE = 0.99
SHAPE_COMPONENTS = 8
MIN_DAYS = 100
MAD_TO_SIGMA = 0.6745

CELL = ["ba_code", "hour_local", "month"]
ISO_FEATURES = ["demand_mwh", "ramp_mwh", "ramp_pct", "temperature_2m", "demand_per_degree"]
SCORE_INPUTS = [
    "period_utc", "ba_code", "date_local", "hour_local", "month", "demand_mwh", "temperature_2m",
    "flag_missing_demand", "flag_nonpositive_demand", "flag_frozen_reading", "flag_extreme_ramp",
    "flag_implausible_magnitude",
]
SCORE_COLUMNS = [
    "period_utc", "ba_code", "date_local", "hour_local", "demand_mwh", "temperature_2m", "robust_z", "iso_score",
    "ae_reconstruction_error", "ramp_pct", "z_flag", "iso_flag", "ae_anomalous_day", "rule_flag", "detector_votes",
    "is_anomaly", "severity", "anomaly_type",
]


def scored_hours(fact: DataFrame) -> DataFrame:
    """Hours with a plausible reading."""
    return fact.select(*SCORE_INPUTS).where("demand_mwh is not null and not coalesce(flag_implausible_magnitude, false)")


def _middle(values: str) -> str:
    return f"(({values})[cast((size({values}) - 1) div 2 as int)] + ({values})[cast(size({values}) div 2 as int)]) / 2"


def seasonal_cells(rows: DataFrame, target: str = "demand_mwh") -> DataFrame:
    """Median and median absolute deviation per (key, hour of day, month).

    A cell gains at most 31 readings a year, so its sorted values fit one array; both figures
    come from that one aggregation.
    """
    return (
        rows.where(f"{target} is not null")
        .groupBy(*CELL)
        .agg(F.expr(f"sort_array(collect_list({target}))").alias("_values"))
        .selectExpr(*CELL, "_values", f"{_middle('_values')} as cell_median")
        .selectExpr(*CELL, "cell_median", "sort_array(transform(_values, v -> abs(v - cell_median))) as _away")
        .selectExpr(*CELL, "cell_median", f"{_middle('_away')} as cell_mad")
    )


def robust_seasonal_z(rows: DataFrame, target: str = "demand_mwh") -> DataFrame:
    """Distance from the cell median in robust deviations (0 where the cell does not vary), and its sign."""
    z = f"abs(({target} - cell_median) / nullif(cell_mad / {MAD_TO_SIGMA}D, 0D))"
    return rows.join(seasonal_cells(rows, target), CELL, "left").selectExpr(
        *rows.columns, f"coalesce({z}, 0D) as robust_z", f"signum({target} - cell_median) as residual_sign"
    )


def with_ramps(rows: DataFrame) -> DataFrame:
    """Change against the previous scored hour of the key, absolute and in percent of it."""
    pct = """case when _previous = 0 then case when demand_mwh > 0 then double('Infinity')
                  when demand_mwh < 0 then double('-Infinity') end
             else (demand_mwh - _previous) / _previous * 100 end"""
    return with_previous(rows, ["ba_code"], "period_utc", "demand_mwh", "_previous").selectExpr(
        *rows.columns, "demand_mwh - _previous as ramp_mwh", f"{pct} as ramp_pct"
    )


def isolation_inputs(rows: DataFrame) -> DataFrame:
    """The forest's features under ``x_`` names: infinities and NaN become missing."""
    away = "greatest(abs(temperature_2m - 18D), 0.5D)"
    inputs = {c: only_finite(c) for c in ISO_FEATURES[:4]}
    inputs["demand_per_degree"] = f"case when temperature_2m is not null then demand_mwh / {away} end"
    return rows.selectExpr("*", *[f"{text} as x_{c}" for c, text in inputs.items()])


def impute_and_scale(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values become the median, then columns are centred and scaled; one pass each for the figures."""
    medians = {c: grouped_quantiles(rows, [], c, {"m": 0.5}).select("m").scalar() for c in columns}
    filled = rows.withColumns({c: F.coalesce(F.col(c), medians[c], F.lit(0.0)) for c in columns})
    filled = written(filled, "isolation_inputs")
    figures = filled.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return filled.withColumns(
        {c: (F.col(c) - F.lit(figures[f"m_{c}"])) / F.lit(figures[f"s_{c}"] or 1.0) for c in columns}
    )


def isolation_scores(rows: DataFrame, contamination: float = CONTAMINATION, trees: int = isolation.TREES) -> DataFrame:
    """``iso_score`` above the contamination quantile (so flagged rows are positive), and ``iso_flag``."""
    columns = [f"x_{c}" for c in ISO_FEATURES]
    ready = impute_and_scale(isolation_inputs(rows), columns)
    forest = isolation.fit_forest(ready, ["ba_code", "period_utc"], columns, trees)
    scored = written(isolation.score(ready, columns, forest, "_raw").select(*rows.columns, "_raw"), "isolation_scores")
    cut = grouped_quantiles(scored, [], "_raw", {"cut": 1 - contamination}).select("cut").scalar()
    return scored.withColumn("_cut", cut).selectExpr(*rows.columns, "_raw - _cut as iso_score", "_raw > _cut as iso_flag")


def daily_profiles(rows: DataFrame) -> DataFrame:
    """Complete days as 24 values over the day's median; days without a usable level are left out."""
    hours = [F.expr(f"avg(case when hour_local = {h} then demand_mwh end)").alias(f"h{h}") for h in range(24)]
    names = [f"h{h}" for h in range(24)]
    complete = rows.groupBy("ba_code", "date_local").agg(*hours).na.drop(subset=names)
    return (
        complete.selectExpr("ba_code", "date_local", f"array({', '.join(names)}) as _day")
        .selectExpr("*", "sort_array(_day) as _sorted")
        .selectExpr("ba_code", "date_local", "_day", f"{_middle('_sorted')} as level")
        .where("level > 1")
        .selectExpr("ba_code", "date_local", "level", "transform(_day, v -> v / level) as profile")
        .where("forall(profile, v -> v > 0.05D and v < 20D)")
    )


def shape_errors(profiles: DataFrame, components: int = SHAPE_COMPONENTS) -> DataFrame | None:
    """Reconstruction error of each day from the leading components of all days; None below 100 days.

    The fit reduces to a 24 x 24 covariance on the cluster; days are scored in SQL.
    """
    vectors = profiles.withColumn("_vector", array_to_vector("profile"))
    summary = vectors.agg(Summarizer.mean(F.col("_vector")).alias("mean"), F.count(F.lit(1)).alias("n")).first()
    if summary["n"] < MIN_DAYS:
        return None
    basis = PCA(k=components, inputCol="_vector", outputCol="_pc").fit(vectors).pc.toArray()
    mean = F.array(*[F.lit(float(v)) for v in summary["mean"]])
    by_component = "array(" + ", ".join("array(" + ", ".join(f"{v!r}D" for v in col.tolist()) + ")" for col in basis.T) + ")"
    by_hour = "array(" + ", ".join("array(" + ", ".join(f"{v!r}D" for v in row.tolist()) + ")" for row in basis) + ")"
    dot = "aggregate(zip_with({a}, {b}, (p, q) -> p * q), 0D, (s, v) -> s + v)"
    return (
        profiles.withColumn("_mean", mean)
        .selectExpr("ba_code", "date_local", "zip_with(profile, _mean, (v, m) -> v - m) as _x")
        .selectExpr("*", f"transform({by_component}, c -> {dot.format(a='_x', b='c')}) as _s")
        .selectExpr("ba_code", "date_local", "_x", f"transform({by_hour}, r -> {dot.format(a='_s', b='r')}) as _back")
        .selectExpr(
            "ba_code", "date_local",
            "aggregate(zip_with(_x, _back, (a, b) -> (a - b) * (a - b)), 0D, (s, v) -> s + v) / 24 as ae_reconstruction_error",
        )
    )


def shape_scores(rows: DataFrame) -> DataFrame | None:
    """Days whose shape is reconstructed worse than the 99th percentile."""
    errors = shape_errors(written(daily_profiles(rows), "daily_profiles"))
    if errors is None:
        return None
    errors = written(errors, "shape_errors")
    cut = grouped_quantiles(errors, [], "ae_reconstruction_error", {"cut": SHAPE_PERCENTILE}).select("cut").scalar()
    return errors.withColumn("ae_threshold", cut).selectExpr(
        "*", "ae_reconstruction_error > ae_threshold as ae_anomalous_day"
    )


def combine(rows: DataFrame, min_votes: int = 1) -> DataFrame:
    """Votes, severity and type from the detectors' columns; a flag that is not known is no vote."""
    flagged = rows.selectExpr(
        "*",
        f"robust_z > {Z_THRESHOLD}D as z_flag",
        """(coalesce(flag_frozen_reading, false) or coalesce(flag_nonpositive_demand, false)
            or coalesce(flag_extreme_ramp, false)) as rule_flag""",
    )
    voters = ("z_flag", "iso_flag", "ae_anomalous_day", "rule_flag")
    votes = " + ".join(f"cast({v} as int)" for v in voters)
    kind = f"""case
        when detector_votes < {min_votes} then 'normal'
        when coalesce(flag_frozen_reading, false) then 'frozen_telemetry'
        when coalesce(flag_nonpositive_demand, false) then 'invalid_reading'
        when coalesce(flag_missing_demand, false) then 'missing_interval'
        when abs(ramp_pct) > 40 then 'extreme_ramp'
        when robust_z > {Z_THRESHOLD}D then case when residual_sign > 0 then 'demand_spike' else 'demand_drop' end
        when ae_anomalous_day then 'unusual_daily_shape'
        else 'multivariate_outlier' end"""
    return (
        flagged.selectExpr("*", f"{votes} as detector_votes")
        .selectExpr(
            "*", f"detector_votes >= {min_votes} as is_anomaly", f"{severity('detector_votes')} as severity", f"{kind} as anomaly_type"
        )
        .select(*SCORE_COLUMNS)
    )


def rule_and_season_scores(fact: DataFrame) -> DataFrame:
    """The detectors that need no fitted model; the other two abstain."""
    rows = with_ramps(robust_seasonal_z(scored_hours(fact)))
    return combine(
        rows.selectExpr(
            "*", "cast(null as double) as iso_score", "false as iso_flag",
            "cast(null as double) as ae_reconstruction_error", "false as ae_anomalous_day",
        )
    )


def detect(fact: DataFrame, min_votes: int = 1, trees: int = isolation.TREES) -> DataFrame:
    """``anomaly_scores``: every detector over every plausible hour."""
    rows = written(with_ramps(robust_seasonal_z(scored_hours(fact))), "scored_hours")
    scored = isolation_scores(rows, trees=trees)
    days = shape_scores(rows)
    if days is None:
        scored = scored.selectExpr("*", "cast(null as double) as ae_reconstruction_error", "false as ae_anomalous_day")
    else:
        known = days.select("ba_code", "date_local", "ae_reconstruction_error", "ae_anomalous_day")
        scored = scored.join(known, ["ba_code", "date_local"], "left").withColumn(
            "ae_anomalous_day", F.coalesce("ae_anomalous_day", F.lit(False))
        )
    return combine(scored, min_votes)


def summary(scores: DataFrame) -> DataFrame:
    """Hours scored, anomalies and their rate; ``breakdown`` has the counts behind them."""
    counted = scores.groupBy("is_anomaly").agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        F.sum("n").alias("hours_scored"),
        F.expr("sum(case when is_anomaly then n else 0 end)").alias("anomalies_found"),
        F.expr(half_up("100D * sum(case when is_anomaly then n else 0 end) / sum(n)", 3)).alias("anomaly_rate_pct"),
    )


def breakdown(scores: DataFrame) -> DataFrame:
    """Hours by severity, over all hours, and by type, over the anomalies, in one scan: rows of (of, name, hours)."""
    counted = scores.groupBy("anomaly_type", "severity", "is_anomaly").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.selectExpr("stack(2, 'severity', severity, n, 'type', case when is_anomaly then anomaly_type end, n) as (of, name, n)")
    return rows.where("name is not null").groupBy("of", "name").agg(F.sum("n").alias("hours"))


def counts_by(scores: DataFrame, *columns: str, anomalies_only: bool = True) -> DataFrame:
    rows = scores.where("is_anomaly") if anomalies_only else scores
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
