"""Sixteen data-quality checks, their result frame, scorecard and verdict."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.scalars import half_up, ratio
from wattloom.plans.warehouse import demand_bounds

# Weight of a check in the suite score.
WEIGHTS = {"critical": 3.0, "warning": 1.0, "info": 0.5}
DIMENSIONS = ("completeness", "validity", "consistency", "timeliness", "uniqueness", "accuracy")
FRESH_HOURS = 48
MIN_BENCHMARK_ROWS = 1000

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Check:
    """A named rule. It passes while failed / total stays within the threshold.

    ``failed`` and ``total`` are aggregates over the per-key totals of the fact table (one scan
    serves all such checks); a rule that needs other tables gives ``measure`` instead.
    """

    name: str
    dimension: str
    severity: str
    description: str
    threshold: float = 0.0
    failed: str | None = None
    total: str | None = None
    measure: Callable[[Tables, str], DataFrame] | None = None


# One row per key: the single scan of the fact table behind most checks.
KEY_TOTALS = {
    "n": "count(*)",
    "n_demand": "count(demand_mwh)",
    "n_nonpositive": "count_if(demand_mwh <= 0)",
    "n_rejected": "count_if(demand_clean_mwh is null and demand_mwh is not null)",
    "n_missing": "count_if(flag_missing_demand)",
    "n_frozen": "count_if(flag_frozen_reading)",
    "n_ramps": "count_if(flag_extreme_ramp)",
    "n_temperature": "count(temperature_2m)",
    "n_unphysical": "count_if(temperature_2m < -60 or temperature_2m > 60)",
    "n_clean": "count(demand_clean_mwh)",
    "sd_clean": "stddev_samp(demand_clean_mwh)",
    "mean_clean": "avg(demand_clean_mwh)",
    "last_demand": "max(case when demand_mwh is not null then period_utc end)",
}


def key_totals(fact: DataFrame) -> DataFrame:
    return fact.groupBy("ba_code").agg(*[F.expr(text).alias(name) for name, text in KEY_TOTALS.items()])


def _one_row(df: DataFrame, failed: str, total: str) -> DataFrame:
    return df.agg(F.expr(failed).cast("long").alias("failed"), F.expr(total).cast("long").alias("total"))


def _magnitude(tables: Tables, as_of: str) -> DataFrame:
    fact = tables["fact_demand_hourly"].where("demand_mwh is not null")
    rows = fact.join(demand_bounds(fact), "ba_code")
    return _one_row(rows, "count_if(demand_mwh < lower_bound or demand_mwh > upper_bound)", "count(*)")


def _duplicates(tables: Tables, as_of: str) -> DataFrame:
    grain = tables["fact_demand_hourly"].groupBy("ba_code", "period_utc").agg(F.count(F.lit(1)).alias("n"))
    return _one_row(grain, "coalesce(sum(n - 1), 0)", "count(*)")


def _orphan_keys(tables: Tables, as_of: str) -> DataFrame:
    dim = tables["dim_ba"].selectExpr("ba_code", "true as known")
    return _one_row(tables["key_totals"].join(dim, "ba_code", "left"), "sum(case when known is null then n else 0 end)", "sum(n)")


def _orphan_dates(tables: Tables, as_of: str) -> DataFrame:
    dates = tables["dim_date"].selectExpr("date_day as date_local", "true as known")
    used = tables["fact_demand_hourly"].groupBy("date_local").agg(F.count(F.lit(1)).alias("n"))
    return _one_row(used.join(dates, "date_local", "left"), "sum(case when known is null then n else 0 end)", "sum(n)")


def _benchmark(tables: Tables, as_of: str) -> DataFrame:
    return _one_row(
        tables["fact_forecast_accuracy"], f"case when count(*) < {MIN_BENCHMARK_ROWS} then 1 else 0 end", "max(1)"
    ).selectExpr("failed", "1L as total")


def _absent_keys(tables: Tables, as_of: str) -> DataFrame:
    present = tables["key_totals"].selectExpr("ba_code", "true as present")
    return _one_row(tables["dim_ba"].join(present, "ba_code", "left"), "count_if(present is null)", "count(*)")


def _freshness(tables: Tables, as_of: str) -> DataFrame:
    stale = f"case when max(last_demand) < {as_of} - interval {FRESH_HOURS} hours then 1 else 0 end"
    return _one_row(tables["key_totals"], stale, "max(1)").selectExpr("failed", "1L as total")


CHECKS = (
    Check("demand_not_null", "completeness", "warning", "Every hour of the spine carries a demand reading.",
          0.02, "sum(n - n_demand)", "sum(n)"),
    Check("demand_positive", "validity", "critical", "Reported demand is above zero.",
          0.001, "sum(n_nonpositive)", "sum(n_demand)"),
    Check("demand_magnitude_plausible", "validity", "critical", "Demand lies within 0.2 to 5 times the key's own median.",
          0.0005, measure=_magnitude),
    Check("demand_dispersion_sane", "validity", "critical", "No key's trusted demand spreads wider than its mean.",
          0.0, "count_if(n_clean > 0 and sd_clean > mean_clean)", "count_if(n_clean > 0)"),
    Check("cleaned_series_is_usable", "validity", "critical", "Cleaning keeps nearly all reported readings.",
          0.01, "sum(n_rejected)", "sum(n_demand)"),
    Check("no_duplicate_intervals", "uniqueness", "critical", "One row per key and hour.", measure=_duplicates),
    Check("no_missing_hours", "completeness", "warning", "No hour between first and last reading lacks demand.",
          0.02, "sum(n_missing)", "sum(n)"),
    Check("no_frozen_readings", "validity", "warning", "Readings do not repeat for three hours or more.",
          0.005, "sum(n_frozen)", "sum(n)"),
    Check("no_extreme_ramps", "consistency", "warning", "Demand moves by at most 40 percent from hour to hour.",
          0.01, "sum(n_ramps)", "sum(n)"),
    Check("referential_integrity_ba", "consistency", "critical", "Every fact row has its key in dim_ba.", measure=_orphan_keys),
    Check("referential_integrity_date", "consistency", "critical", "Every fact row has its date in dim_date.", measure=_orphan_dates),
    Check("weather_coverage", "completeness", "warning", "Nearly every hour has a temperature.",
          0.05, "sum(n - n_temperature)", "sum(n)"),
    Check("temperature_physically_plausible", "validity", "critical", "Temperatures lie between -60 and 60 degrees.",
          0.0, "sum(n_unphysical)", "sum(n_temperature)"),
    Check("data_freshness", "timeliness", "warning", "The latest reading is at most 48 hours old.", measure=_freshness),
    Check("eia_benchmark_available", "accuracy", "critical", "The published forecast is there to be scored.", measure=_benchmark),
    Check("all_bas_present", "completeness", "critical", "Every key of dim_ba has fact rows.", measure=_absent_keys),
)


def check_catalogue(spark: SparkSession, checks: tuple[Check, ...] = CHECKS) -> DataFrame:
    rows = [(i, c.name, c.dimension, c.severity, c.description, float(c.threshold)) for i, c in enumerate(checks)]
    return spark.createDataFrame(rows, "ord int, check_name string, dimension string, severity string, description string, threshold double")


def measure_checks(tables: Tables, as_of: str = "current_timestamp()", checks: tuple[Check, ...] = CHECKS) -> DataFrame:
    """(check_name, failed, total) of every check; fact-only checks share one aggregate."""
    tables = {"key_totals": key_totals(tables["fact_demand_hourly"]), **tables}
    shared = [c for c in checks if c.measure is None]
    frames = []
    if shared:
        pairs = ", ".join(f"'{c.name}', cast(failed_{i} as bigint), cast(total_{i} as bigint)" for i, c in enumerate(shared))
        totals = tables["key_totals"].agg(
            *[F.expr(text).alias(f"{kind}_{i}") for i, c in enumerate(shared) for kind, text in (("failed", c.failed), ("total", c.total))]
        )
        frames.append(totals.selectExpr(f"stack({len(shared)}, {pairs}) as (check_name, failed, total)"))
    for check in checks:
        if check.measure is not None:
            frames.append(check.measure(tables, as_of).selectExpr(f"'{check.name}' as check_name", "failed", "total"))
    measured = frames[0]
    for frame in frames[1:]:
        measured = measured.unionByName(frame)
    return measured


def result_frame(measured: DataFrame, run_at: str, checks: tuple[Check, ...] = CHECKS) -> DataFrame:
    """``dq_results``: one row per check; a check without a measurement failed with its error."""
    spark = measured.sparkSession
    if "error" not in measured.columns:
        measured = measured.selectExpr("*", "cast(null as string) as error")
    rate = f"coalesce({ratio('failed', 'cast(total as double)')}, 0D)"
    return (
        check_catalogue(spark, checks)
        .join(measured, "check_name", "left")
        .selectExpr(
            f"{run_at} as run_at_utc",
            "check_name", "dimension", "severity", "description",
            "coalesce(failed, 0L) as failed_rows",
            "coalesce(total, 0L) as total_rows",
            f"{half_up(f'100 * {rate}', 4)} as failure_rate_pct",
            f"{half_up('100 * threshold', 4)} as threshold_pct",
            f"(error is null and {rate} <= threshold) as passed",
            "error",
        )
    )


def run_suite(tables: Tables, as_of: str = "current_timestamp()", run_at: str = "current_timestamp()", checks: tuple[Check, ...] = CHECKS) -> DataFrame:
    """Measure all checks in one job; if that fails, one by one, recording the error of each.

    The result has one row per check and is brought to the driver, so later reads do not repeat it.
    """
    spark = tables["fact_demand_hourly"].sparkSession
    schema = "check_name string, failed long, total long, error string"
    try:
        rows = [(r.check_name, r.failed, r.total, None) for r in measure_checks(tables, as_of, checks).collect()]
    except Exception:  # noqa: BLE001
        rows = []
        for check in checks:
            try:
                r = measure_checks(tables, as_of, (check,)).first()
                rows.append((check.name, r.failed, r.total, None))
            except Exception as exc:  # noqa: BLE001
                rows.append((check.name, 0, 0, str(exc)[:300]))
    return result_frame(spark.createDataFrame(rows, schema), run_at, checks)


def latest_run(results: DataFrame) -> DataFrame:
    return results.where(F.col("run_at_utc") == results.select(F.max("run_at_utc")).scalar())


def scorecard(results: DataFrame) -> DataFrame:
    """``dq_scorecard``: share of checks passed per dimension in the latest run."""
    return latest_run(results).groupBy("dimension").agg(
        F.count(F.lit(1)).alias("checks_run"),
        F.expr("count_if(passed)").alias("checks_passed"),
        F.expr(half_up("100D * count_if(passed) / count(*)", 1)).alias("pass_pct"),
        F.max("run_at_utc").alias("run_at_utc"),
    )


def verdict(results: DataFrame) -> DataFrame:
    """Weighted score of the latest run, and whether every critical check passed."""
    cases = " ".join(f"when '{name}' then {weight}D" for name, weight in WEIGHTS.items())
    weight = f"case severity {cases} end"
    return latest_run(results).agg(
        F.expr(half_up(f"100 * sum(case when passed then {weight} else 0D end) / sum({weight})", 1)).alias("score"),
        F.expr("count_if(severity = 'critical' and not passed) = 0").alias("suite_passed"),
        F.expr("count_if(passed)").alias("checks_passed"),
        F.count(F.lit(1)).alias("checks_run"),
    )
