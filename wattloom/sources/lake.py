"""Bronze reads, per-key watermarks, pull windows, and partitioned writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.scalars import hour_stamp
from wattloom.schemas import (
    AHEAD_HOURS,
    ARCHIVE_LAG_DAYS,
    ARCHIVE_SOURCE,
    BRONZE_MEASURES,
    BRONZE_WEATHER,
    DEFAULT_START,
    FEED_EPOCH,
    OVERLAP_HOURS,
)


def folder_has_data(spark: SparkSession, root: str) -> bool:
    """Does any Parquet file exist under the folder? Asked of the file system, no job."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return False
    files = fs.listFiles(path, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def scan_lake(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """A partitioned lake table whose files may miss columns or order them differently."""
    return spark.read.schema(schema).option("mergeSchema", "true").parquet(root).select(*schema.fieldNames())


def read_measures(spark: SparkSession, root: str) -> DataFrame:
    """Stored measures, or an empty frame of the same schema."""
    if not folder_has_data(spark, root):
        return spark.createDataFrame([], BRONZE_MEASURES)
    return scan_lake(spark, root, BRONZE_MEASURES)


def read_weather(spark: SparkSession, root: str) -> DataFrame | None:
    """Stored weather, or None: the silver build then carries NULL weather."""
    return scan_lake(spark, root, BRONZE_WEATHER) if folder_has_data(spark, root) else None


def require_measures(spark: SparkSession, root: str) -> DataFrame:
    """Stored measures; without any there is nothing to build a warehouse from."""
    if not folder_has_data(spark, root):
        raise FileNotFoundError(f"no measure data under {root}; ingest before building")
    return scan_lake(spark, root, BRONZE_MEASURES)


def watermarks(bronze: DataFrame) -> DataFrame:
    """Latest stored period of each key, also as the feed's hour text."""
    latest = bronze.groupBy("ba_code").agg(F.max("period_utc").alias("watermark_utc"))
    return latest.selectExpr("ba_code", "watermark_utc", f"{hour_stamp('watermark_utc')} as watermark")


def measure_plan(keys: DataFrame, marks: DataFrame, now: str = "current_timestamp()", start_date: str = DEFAULT_START, full_refresh: bool = False) -> DataFrame:
    """Per key, the hours to pull: from a day before the watermark, or from the start, to two days ahead."""
    beginning = f"cast(greatest(date'{start_date}', date'{FEED_EPOCH}') as timestamp)"
    resume = f"watermark_utc - interval {OVERLAP_HOURS} hours"
    start = beginning if full_refresh else f"coalesce({resume}, {beginning})"
    return keys.select("ba_code").join(marks, "ba_code", "left").selectExpr(
        "ba_code", f"{start} as start_utc", f"date_trunc('hour', {now} + interval {AHEAD_HOURS} hours) as end_utc"
    )


def archive_plan(keys: DataFrame, stored: DataFrame, now: str = "current_timestamp()", start_date: str = DEFAULT_START) -> DataFrame:
    """Per key, the archive days to pull: from the day before the last archived hour to the archive's lag."""
    archived = stored.where(F.col("source") == ARCHIVE_SOURCE).groupBy("ba_code").agg(
        F.expr("date_sub(to_date(max(period_utc)), 1)").alias("resume")
    )
    return keys.select("ba_code").join(archived, "ba_code", "left").selectExpr(
        "ba_code",
        f"coalesce(resume, date'{start_date}') as start_date",
        f"date_sub(to_date({now}), {ARCHIVE_LAG_DAYS}) as end_date",
    ).selectExpr("*", "start_date <= end_date as due")


def within_plan(landed: DataFrame, plan: DataFrame) -> DataFrame:
    """Landed rows inside the pull window of their key."""
    return landed.join(plan, "ba_code").where("period_utc >= start_utc and period_utc <= end_utc").select(*landed.columns)


def write_partitions(bronze: DataFrame, root: str, order: list[str]) -> DataFrame:
    """Replace the ``ba=`` partitions present in ``bronze``, each sorted; returns rows per key.

    Keys are spread over tasks by key and month, so a key with very much history is written by
    many tasks as many files.
    """
    spread = bronze.selectExpr("*", "ba_code as ba").repartition("ba", F.expr("trunc(period_utc, 'MM')"))
    (
        spread.sortWithinPartitions("ba", *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("ba")
        .parquet(root)
    )
    return bronze.groupBy("ba_code").agg(F.count(F.lit(1)).alias("rows"))
