"""Table, append-log, JSON and CSV sinks, and the windowed export."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.schemas import WEATHER
from wattloom.session import exists, remove, rename

EXPORT_DAYS = 400
EXPORT_FULL = ("dim_ba", "dim_date", "model_scores", "dq_results", "dq_scorecard")
EXPORT_WINDOWED = ("fact_demand_hourly", "fact_forecast_accuracy", "model_predictions", "anomaly_scores")
EXPORT_FACT_COLUMNS = [
    "period_utc", "ba_code", "date_local", "hour_local", "demand_mwh", "demand_forecast_mwh", "net_generation_mwh",
    "total_interchange_mwh", "demand_clean_mwh", "flag_isolated_spike", "flag_implausible_magnitude", *WEATHER,
    "day_of_week", "is_weekend", "is_holiday", "is_business_day", "is_day_before_holiday", "is_day_after_holiday",
    "season", "month", "year",
]


def replace_table(df: DataFrame, path: str, cluster: list[str] | None = None) -> DataFrame:
    """Create or replace a table; rows clustered by key and sorted inside files, never sorted globally.

    The new rows are written beside the table and take its place by two renames, so a failed job
    leaves the old table, and ``df`` may read it.
    """
    if cluster:
        df = df.repartition(cluster[0], F.expr("trunc(period_utc, 'MM')")).sortWithinPartitions(*cluster)
    spark, fresh, old = df.sparkSession, f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    if exists(spark, path):
        rename(spark, path, old)
    rename(spark, fresh, path)
    remove(spark, old)
    return spark.read.schema(df.schema).parquet(path)


def append_log(df: DataFrame, path: str, exists: bool) -> None:
    """Append to a table whose schema was fixed by its first write."""
    if exists:
        stored = df.sparkSession.read.parquet(path)
        if stored.columns != df.columns or [f.dataType for f in stored.schema] != [f.dataType for f in df.schema]:
            raise ValueError(f"{path} holds {stored.schema.simpleString()}, not {df.schema.simpleString()}")
    df.write.mode("append").parquet(path)


def write_json(small: DataFrame, path: str) -> None:
    """A small artifact (leaderboard, headline, importance, summary) as one JSON file."""
    small.coalesce(1).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def recent_window(df: DataFrame, days: int, newest: Column | None = None) -> DataFrame:
    """Rows of the last ``days`` before the newest period, by default the table's own newest."""
    top = newest if newest is not None else df.select(F.max("period_utc")).scalar()
    return df.where(F.col("period_utc") >= top - F.expr(f"interval {days} days"))


def export_tables(tables: dict[str, DataFrame], days: int = EXPORT_DAYS, common_cutoff: bool = False) -> dict[str, DataFrame]:
    """What the export holds: small tables whole, time tables by a rolling window; absent ones are left out."""
    newest = None
    if common_cutoff and "fact_demand_hourly" in tables:
        newest = tables["fact_demand_hourly"].select(F.max("period_utc")).scalar()
    result = {name: tables[name] for name in EXPORT_FULL if name in tables}
    for name in EXPORT_WINDOWED:
        if name in tables:
            df = tables[name]
            result[name] = recent_window(df.select(*EXPORT_FACT_COLUMNS) if name == "fact_demand_hourly" else df, days, newest)
    return result


def manifest(tables: dict[str, DataFrame], name: str, days: int, exported_at: str = "current_timestamp()", size_mb: float | None = None) -> DataFrame:
    """Rows per exported table, with the export's name, window, size and time."""
    frames = [df.agg(F.count(F.lit(1)).alias("rows")).selectExpr(f"'{t}' as table_name", "rows") for t, df in tables.items()]
    counted = frames[0]
    for frame in frames[1:]:
        counted = counted.unionByName(frame)
    size = "cast(null as double)" if size_mb is None else f"{round(size_mb, 2)}D"
    return counted.selectExpr(
        f"'{name}' as database", f"{size} as size_mb", f"{days} as window_days", "table_name", "rows", f"{exported_at} as exported_at_utc"
    )


def folder_megabytes(spark: SparkSession, path: str) -> float:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(target).getLength() / 1e6


def export_app(tables: dict[str, DataFrame], root: str, days: int = EXPORT_DAYS, common_cutoff: bool = False) -> DataFrame:
    """Write the export and its manifest; returns the manifest."""
    spark = next(iter(tables.values())).sparkSession
    written = {
        name: replace_table(df, f"{root}/{name}") for name, df in export_tables(tables, days, common_cutoff).items()
    }
    listing = manifest(written, root.rstrip("/").rsplit("/", 1)[-1], days, size_mb=folder_megabytes(spark, root))
    write_json(listing, f"{root}/_manifest")
    return listing
