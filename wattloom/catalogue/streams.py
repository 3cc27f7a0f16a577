"""Streaming queries run to completion over the given tables."""

from __future__ import annotations

import uuid

from wattloom.catalogue.base import EVENT_ARRIVAL, r, register
from wattloom.functions.scalars import rounded
from wattloom.operators.series import pivot_latest
from wattloom.schemas import BRONZE_MEASURES
from wattloom.session import shared_folder, written
from wattloom.sources import adapters, lake
from wattloom.streaming import flags, ingest, rollup


def _folder(spark, name):
    return f"{shared_folder(spark)}/wattloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _drain(frame, mode, folder):
    """Run a stream over everything available into Parquet, and read that back."""
    spark = frame.sparkSession
    frame.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{folder}/progress").option(
        "path", f"{folder}/out"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(frame.schema).parquet(f"{folder}/out")


@register("stream_ingest", "SELECT period_utc, ba_code, measure_code, value_mwh, ingested_at_utc FROM event_latest")
def _stream_ingest(spark, sf_dir):
    """Event readings land as files, late corrections included, and are merged batch by batch."""
    folder = _folder(spark, "ingest")
    events = adapters.event_measures(spark, sf_dir).select(*BRONZE_MEASURES.fieldNames())
    events.repartitionByRange("ingested_at_utc").write.parquet(f"{folder}/landing")
    ingest.ingest_stream(spark, f"{folder}/landing", f"{folder}/lake", f"{folder}/state", files_per_trigger=2).awaitTermination()
    return lake.read_measures(spark, f"{folder}/lake")


READINGS = "ba_code string, period_utc timestamp, demand_mwh double"
#: Hours of readings that land together; a reading lands up to 23 hours after its own hour, so that landings overlap.
LANDED_HOURS = 240


def _land(wide, folder):
    """Readings as they would land, one folder after the other and out of order; then two rows a key that end the stream."""
    hour = "cast(floor(unix_seconds(period_utc) / 3600) as long)"
    rows = wide.select("ba_code", "period_utc", "demand_mwh").selectExpr("*", f"cast(floor(({hour} + pmod(xxhash64(ba_code, period_utc), 24)) / {LANDED_HOURS}) as long) as landing")
    rows = written(rows, "readings")
    for row in rows.select("landing").distinct().orderBy("landing").collect():  # a row for every ten days
        rows.where(f"landing = {row['landing']}").drop("landing").write.parquet(f"{folder}/landing={row['landing']:09d}")
    for nth in (1, 2):
        end = rows.select("ba_code").distinct().selectExpr("ba_code", f"timestamp'2100-01-0{nth}' as period_utc", "1D as demand_mwh")
        end.write.parquet(f"{folder}/landing=99999999{nth}")


def _landed(spark, sf_dir, folder):
    _land(pivot_latest(adapters.event_measures(spark, sf_dir), EVENT_ARRIVAL), f"{folder}/in")
    return spark.readStream.schema(READINGS).option("maxFilesPerTrigger", 4).parquet(f"{folder}/in/*")


_FIGURES = ["total_demand_mwh", "mean_demand_mw", "peak_demand_mw", "trough_demand_mw", "daily_swing_mw", "load_factor"]


@register(
    "stream_daily_rollup",
    f"""SELECT ba_code, CAST(period_utc AS DATE) AS date_utc, count(*) AS hours_reported, {r('sum(demand_mwh)', 4)} AS total_demand_mwh,
               {r('avg(demand_mwh)', 4)} AS mean_demand_mw, {r('max(demand_mwh)', 4)} AS peak_demand_mw,
               {r('min(demand_mwh)', 4)} AS trough_demand_mw, {r('max(demand_mwh) - min(demand_mwh)', 4)} AS daily_swing_mw,
               {r('avg(demand_mwh) / nullif(max(demand_mwh), 0)', 4)} AS load_factor
        FROM event_wide WHERE demand_mwh > 0 GROUP BY 1, 2""",
)
def _stream_rollup(spark, sf_dir):
    folder = _folder(spark, "rollup")
    rows = _drain(rollup.daily_rollup(_landed(spark, sf_dir, folder)), "append", folder)
    return rounded(rows.where("date_utc < date'2100-01-01'"), 4, *_FIGURES)


@register(
    "stream_arrival_flags",
    """SELECT ba_code, period_utc, demand_mwh, demand_mwh IS NOT NULL
               AND demand_mwh = lag(demand_mwh) OVER w AND demand_mwh = lag(demand_mwh, 2) OVER w AS flag_frozen_reading,
              abs(demand_mwh - lag(demand_mwh) OVER w) / nullif(lag(demand_mwh) OVER w, 0) * 100 > 40 AS flag_extreme_ramp
       FROM event_wide WINDOW w AS (PARTITION BY ba_code ORDER BY period_utc)""",
)
def _stream_flags(spark, sf_dir):
    folder = _folder(spark, "flags")
    return _drain(flags.flag_on_arrival(_landed(spark, sf_dir, folder)), "append", folder).where("period_utc < timestamp'2100-01-01'")
