"""Landed payloads to bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattloom.functions.scalars import number_or_null, parse_hour_stamp
from wattloom.schemas import LANDING_MEASURES, LANDING_WEATHER, WEATHER


def read_measure_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of nested JSON as they were downloaded, one document per file."""
    return spark.read.schema(LANDING_MEASURES).option("multiLine", True).json(folder)


def read_weather_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Column-oriented JSON documents; the folder names carry ``ba`` and ``source``."""
    return spark.read.schema(LANDING_WEATHER).option("multiLine", True).json(folder)


def normalise_measures(pages: DataFrame, ingested_at: str = "current_timestamp()", carry: list[str] | None = None) -> DataFrame:
    """Page documents to bronze rows.

    Hours that do not parse and rows without a key are dropped; a missing or unreadable value is
    kept as NULL, because the hour was reported.
    """
    carry = carry or []
    rows = pages.selectExpr(*carry, f"{ingested_at} as ingested_at_utc", "explode(response.data) as rec")
    return rows.selectExpr(
        f"{parse_hour_stamp('rec.period')} as period_utc",
        "rec.respondent as ba_code",
        "rec.type as measure_code",
        f"{number_or_null('rec.value')} as value_mwh",
        "ingested_at_utc",
        *carry,
    ).na.drop(subset=["period_utc", "ba_code", "measure_code"])


def flatten_weather(pages: DataFrame, ba_code: str = "ba", source: str = "source", ingested_at: str = "current_timestamp()") -> DataFrame:
    """Parallel arrays to one row per hour; a variable the payload lacks is NULL, an empty payload gives no rows."""
    variables = ", ".join(f"get(hourly.{c}, i) as {c}" for c in WEATHER)
    zipped = pages.selectExpr(
        f"{ba_code} as ba_code",
        f"{source} as source",
        f"{ingested_at} as ingested_at_utc",
        f"explode(transform(hourly.time, (t, i) -> struct(t as time, {variables}))) as rec",
    )
    return zipped.selectExpr(
        "try_to_timestamp(rec.time) as period_utc",
        *[f"{number_or_null(f'rec.{c}')} as {c}" for c in WEATHER],
        "ba_code", "source", "ingested_at_utc",
    ).where("period_utc is not null")
