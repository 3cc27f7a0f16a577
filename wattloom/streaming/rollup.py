"""Hourly refresh of the per-key daily rollup on a stream of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLLUP = {
    "hours_reported": "count(*)",
    "total_demand_mwh": "sum(demand_mwh)",
    "mean_demand_mw": "avg(demand_mwh)",
    "peak_demand_mw": "max(demand_mwh)",
    "trough_demand_mw": "min(demand_mwh)",
    "daily_swing_mw": "max(demand_mwh) - min(demand_mwh)",
    "load_factor": "avg(demand_mwh) / nullif(max(demand_mwh), 0D)",
}


def daily_rollup(readings: DataFrame, lateness: str = "24 hours") -> DataFrame:
    """UTC-day figures per key; readings up to ``lateness`` behind the newest still count.

    On a stream, append mode emits a day once the watermark has passed its end and drops its state,
    so state is one row per open key and day. The same on a batch.
    """
    rows = readings.where("demand_mwh > 0")
    if readings.isStreaming:
        rows = rows.withWatermark("period_utc", lateness)
    grouped = rows.groupBy("ba_code", F.window("period_utc", "1 day")).agg(
        *[F.expr(text).alias(name) for name, text in ROLLUP.items()]
    )
    return grouped.selectExpr("ba_code", "to_date(window.start) as date_utc", *ROLLUP)
