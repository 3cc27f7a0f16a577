"""The queries the service answers, as functions over the warehouse frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import bin_half_even, half_up, iso_z
from wattloom.sources.sinks import recent_window


def _agg(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(text).alias(name) for name, text in columns.items()])


def latest_hours(fact: DataFrame, ba_code: str, hours: int, columns: list[str]) -> DataFrame:
    """The newest ``hours`` rows of a key (a top-n, no full sort), oldest first."""
    rows = fact.where(F.col("ba_code") == ba_code.upper()).select("period_utc", *columns)
    return rows.orderBy(F.desc("period_utc")).limit(hours).orderBy("period_utc")


def recent_demand(fact: DataFrame, ba_code: str, hours: int = 168) -> DataFrame:
    rows = latest_hours(fact, ba_code, hours, ["demand_mwh", "demand_forecast_mwh", "temperature_2m"])
    return rows.selectExpr(f"{iso_z()} as period_utc", "demand_mwh", "demand_forecast_mwh", "temperature_2m")


def latest_leaderboard(scores: DataFrame) -> DataFrame:
    newest = scores.select(F.max("trained_at_utc")).scalar()
    return scores.where(F.col("trained_at_utc") == newest).orderBy("mape_pct")


def accuracy_by_key(accuracy: DataFrame) -> DataFrame:
    return _agg(
        accuracy,
        ["ba_code"],
        {
            "eia_mape_pct": half_up("avg(abs_pct_error)", 3),
            "mean_bias_mwh": half_up("avg(error_mwh)", 1),
            "hours": "count(*)",
        },
    ).orderBy("eia_mape_pct", "ba_code")


def recent_anomalies(scores: DataFrame, severity: str = "high", limit: int = 200) -> DataFrame:
    rows = scores.where("is_anomaly")
    if severity != "all":
        rows = rows.where(F.col("severity") == severity)
    return rows.orderBy(F.desc("period_utc"), "ba_code").limit(limit).selectExpr(
        f"{iso_z()} as period_utc", "ba_code", "demand_mwh", "temperature_2m", "anomaly_type", "severity", "detector_votes",
        f"{half_up('robust_z', 2)} as robust_z",
    )


def serious_anomalies(scores: DataFrame, limit: int = 200) -> DataFrame:
    rows = scores.where("is_anomaly and severity in ('high', 'medium')").orderBy(F.desc("period_utc"), "ba_code").limit(limit)
    return rows.selectExpr(
        "period_utc", "ba_code", f"{half_up('demand_mwh')} as demand_mw", f"{half_up('temperature_2m', 1)} as temp_c",
        "anomaly_type", "severity", "detector_votes", f"{half_up('robust_z', 2)} as robust_z",
    )


def quality_detail(results: DataFrame) -> DataFrame:
    from wattloom.plans.quality import latest_run

    return latest_run(results).select(
        "check_name", "dimension", "severity", "failed_rows", "total_rows", "failure_rate_pct", "threshold_pct", "passed", "description"
    ).orderBy("passed", "severity", "check_name")


def fleet_summary(fact: DataFrame) -> DataFrame:
    return fact.where("demand_clean_mwh is not null").groupBy("ba_code").agg(
        F.count(F.lit(1)).alias("n"), F.sum("demand_clean_mwh").alias("s"), F.max("demand_clean_mwh").alias("m")
    ).agg(
        F.sum("n").alias("hours"), F.count(F.lit(1)).alias("bas"),
        F.expr(half_up("sum(s) / sum(n)")).alias("avg_demand"), F.max("m").alias("peak"),
    )


def coverage_span(fact: DataFrame) -> DataFrame:
    return fact.agg(F.min("period_utc").alias("lo"), F.max("period_utc").alias("hi"), F.count(F.lit(1)).alias("n"))


def history_window(fact: DataFrame, ba_code: str, days: int = 30) -> DataFrame:
    """A key's hours within ``days`` of the newest hour of the whole table."""
    return recent_window(fact, days).where(F.col("ba_code") == ba_code.upper()).selectExpr(
        "period_utc", "hour_local", "demand_clean_mwh as demand_mwh", "demand_forecast_mwh", "temperature_2m",
        "is_weekend", "is_holiday", "season",
    )


def binned_response(history: DataFrame, min_hours: int = 5) -> DataFrame:
    """Median demand by two-degree bin (halves to the even bin); a history window is a bounded input."""
    rows = history.where("temperature_2m is not null and demand_mwh is not null").selectExpr(
        "demand_mwh", f"{bin_half_even('temperature_2m', 2.0)} as bin"
    )
    return _agg(rows, ["bin"], {"median": "median(demand_mwh)", "size": "count(*)"}).where(f"size >= {min_hours}")


def load_shape(history: DataFrame) -> DataFrame:
    return _agg(history, ["hour_local", "is_weekend"], {"demand_mwh": half_up("avg(demand_mwh)", 4)})


def fleet_comparison(fact: DataFrame, days: int = 30) -> DataFrame:
    rows = recent_window(fact, days).where("demand_clean_mwh is not null")
    figures = {"mean_demand_mw": half_up("avg(demand_clean_mwh)"), "peak_demand_mw": half_up("max(demand_clean_mwh)")}
    return _agg(rows, ["ba_code"], figures).orderBy(F.desc("mean_demand_mw"), "ba_code")


def peak_by_key(fact: DataFrame, season: str, limit: int = 10) -> DataFrame:
    rows = fact.where(F.col("season") == season)
    return _agg(rows, ["ba_code"], {"peak_mwh": "max(demand_mwh)"}).orderBy(F.desc("peak_mwh"), "ba_code").limit(limit)


def demand_by_degree(fact: DataFrame, ba_code: str, limit: int = 100) -> DataFrame:
    rows = fact.where((F.col("ba_code") == ba_code) & F.col("temperature_2m").isNotNull()).selectExpr(
        f"{half_up('temperature_2m')} as temp_c", "demand_mwh"
    )
    return _agg(rows, ["temp_c"], {"avg_demand_mwh": half_up("avg(demand_mwh)"), "hours": "count(*)"}).orderBy("temp_c").limit(limit)


def average_by_key(fact: DataFrame) -> DataFrame:
    return _agg(fact, ["ba_code"], {"avg_demand_mwh": half_up("avg(demand_mwh)", 2)}).orderBy(F.desc("avg_demand_mwh"), "ba_code")


def average_by_hour(fact: DataFrame, ba_code: str, season: str) -> DataFrame:
    rows = fact.where((F.col("ba_code") == ba_code) & (F.col("season") == season))
    return _agg(rows, ["hour_local"], {"avg_demand_mwh": half_up("avg(demand_mwh)", 2)})


def highest_hours(fact: DataFrame, n: int = 10) -> DataFrame:
    return fact.orderBy(F.desc_nulls_last("demand_mwh"), "ba_code", "period_utc").limit(n).select("ba_code", "period_utc", "demand_mwh")


def weekday_against_weekend(fact: DataFrame, ba_code: str) -> DataFrame:
    rows = fact.where(F.col("ba_code") == ba_code)
    return _agg(rows, ["is_weekend"], {"avg_demand_mwh": half_up("avg(demand_mwh)", 2), "hours": "count(demand_mwh)"})


def best_model(scores: DataFrame) -> DataFrame:
    return latest_leaderboard(scores).limit(1).select("model", "mape_pct", "skill_vs_eia_pct")


def anomalies_of_severity(scores: DataFrame, severity: str = "high") -> DataFrame:
    rows = scores.where((F.col("severity") == severity) & F.col("is_anomaly"))
    return _agg(rows, ["ba_code"], {"anomalies": "count(*)"})
