"""Where forecasts go wrong, and what the tail of a series looks like."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import half_up
from wattloom.operators.quantiles import grouped_quantiles

THRESHOLDS = (10, 25, 50, 100, 500)


def with_ape(predictions: DataFrame, predicted: str, actual: str = "demand_mwh") -> DataFrame:
    return predictions.selectExpr("*", f"abs({predicted} - {actual}) / nullif({actual}, 0D) * 100 as ape")


def scaler_spread(stats: DataFrame) -> DataFrame:
    """Largest over smallest centre of the fitted keys."""
    return stats.agg(F.expr("max(centre) / min(centre)").alias("scale_ratio"), F.count(F.lit(1)).alias("keys"))


def keys_without_stats(rows: DataFrame, stats: DataFrame) -> DataFrame:
    return rows.select("ba_code").distinct().join(stats, "ba_code", "left_anti")


def error_by_key(predictions: DataFrame, predicted: str, actual: str = "demand_mwh") -> DataFrame:
    return with_ape(predictions, predicted, actual).groupBy("ba_code").agg(
        F.count(F.lit(1)).alias("hours"),
        F.expr(half_up(f"avg({actual})", 2)).alias("actual_mean_mw"),
        F.expr(half_up(f"avg({predicted})", 2)).alias("pred_mean_mw"),
        F.expr(half_up("avg(ape)", 2)).alias("mape_pct"),
        F.expr(half_up("max(ape)", 2)).alias("worst_ape_pct"),
    )


def worst_rows(predictions: DataFrame, predicted: str, n: int = 15) -> DataFrame:
    return with_ape(predictions, predicted).orderBy(F.desc_nulls_last("ape"), "ba_code", "period_utc").limit(n)


def error_shares(predictions: DataFrame, predicted: str) -> DataFrame:
    """Share of rows above each error threshold."""
    rows = with_ape(predictions, predicted).agg(
        *[F.expr(f"avg(case when ape > {t} then 1D else 0D end) * 100").alias(f"s{t}") for t in THRESHOLDS]
    )
    pairs = ", ".join(f"{t}, s{t}" for t in THRESHOLDS)
    return rows.selectExpr(f"stack({len(THRESHOLDS)}, {pairs}) as (threshold_pct, share_pct)")


def error_concentration(predictions: DataFrame, predicted: str, share: float = 0.01) -> DataFrame:
    """Part of the total error that the worst share of rows carries, with mean and median error.

    The smallest error among the worst rows is found by selection, not by sorting all rows; rows
    equal to it count only as often as needed.
    """
    rows = with_ape(predictions, predicted).where("ape is not null").select("ape")
    worst = f"cast(floor({share}D * _total) as bigint)"
    marks = grouped_quantiles(rows, [], "ape", {"_edge": f"_total - greatest({worst}, 1)", "_median": 0.5})
    edge = marks.select(F.struct("_edge", "_median")).scalar()
    return (
        rows.withColumn("_m", edge)
        .groupBy(F.col("_m._median").alias("median_ape_pct"), F.col("_m._edge").alias("_edge"))
        .agg(
            F.count(F.lit(1)).alias("_total"),
            F.sum("ape").alias("_sum"),
            F.expr("sum(case when ape > _m._edge then ape else 0D end)").alias("_above"),
            F.expr("count_if(ape > _m._edge)").alias("_n_above"),
        )
        .selectExpr(
            f"case when {worst} = 0 then 0D else (_above + ({worst} - _n_above) * _edge) / _sum * 100 end as worst_share_pct",
            "_sum / _total as mape_pct",
            "median_ape_pct",
        )
    )


def series_tail(fact: DataFrame, ba_code: str, hours: int = 60) -> DataFrame:
    """The last hours of a key with its flags and step changes, oldest first."""
    tail = fact.where(F.col("ba_code") == ba_code).select(
        "period_utc", "demand_mwh", "demand_clean_mwh", "flag_isolated_spike", "flag_extreme_ramp",
        "flag_frozen_reading", "flag_implausible_magnitude",
    ).orderBy(F.desc("period_utc")).limit(hours)
    step = "(demand_mwh - lag(demand_mwh) over (order by period_utc)) / nullif(lag(demand_mwh) over (order by period_utc), 0D) * 100"
    return tail.selectExpr("*", f"{step} as step_pct")


def tail_summary(tail: DataFrame, step_over: float = 20.0) -> DataFrame:
    return tail.agg(
        F.count(F.lit(1)).alias("hours"),
        F.expr("count_if(demand_mwh is null)").alias("demand_nulls"),
        F.expr("count_if(demand_clean_mwh is null)").alias("clean_nulls"),
        F.expr(f"count_if(abs(step_pct) > {step_over})").alias("large_steps"),
    )


def clock_changes(silver: DataFrame) -> DataFrame:
    """Local days on which a key's clock changes: their hours, those told twice, and the offsets before and after."""
    offset = "cast((unix_seconds(cast(period_local as timestamp)) - unix_seconds(period_utc)) / 3600 as int)"
    days = silver.selectExpr("ba_code", "date_local", "hour_local", "period_utc", f"{offset} as _offset").groupBy("ba_code", "date_local")
    return days.agg(
        F.count("*").alias("hours_in_day"),
        (F.count("*") - F.expr("bit_count(coalesce(bit_or(shiftleft(1, hour_local)), 0))")).alias("hours_repeated"),
        F.min_by("_offset", "period_utc").alias("offset_before"),
        F.max_by("_offset", "period_utc").alias("offset_after"),
    ).where("offset_before <> offset_after")
