"""Incremental ingest: landed files are merged into the lake, late corrections win."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattloom.operators.series import upsert_measures
from wattloom.schemas import BRONZE_MEASURES
from wattloom.session import remove
from wattloom.sources.lake import folder_has_data

LAKE_KEYS = ["ba", "month"]
#: Folders that a batch names one by one; a batch that touches more is joined to the folders' list.
MOST_FOLDERS = 10_000


def touched_partitions(spark: SparkSession, root: str, touched: DataFrame) -> DataFrame:
    """The stored rows of the (ba, month) folders in ``touched``; no file of another folder is listed for the scan.

    A semi-join would read the whole lake, as nothing makes Spark prune by it; a list of folders is a
    partition filter. The list is a row a folder of one batch.
    """
    stored = spark.read.schema(_lake_schema()).parquet(root)
    named = touched.select(*LAKE_KEYS).distinct().limit(MOST_FOLDERS + 1).collect()
    if len(named) > MOST_FOLDERS:
        return stored.join(touched, LAKE_KEYS, "left_semi")
    return stored.where(F.concat_ws("/", *LAKE_KEYS).isin(["/".join(r[c] or "" for c in LAKE_KEYS) for r in named]))


def merge_batch(fresh: DataFrame, root: str, staging: str, batch_id: int) -> None:
    """Merge one micro-batch into the (ba, month) partitions it touches.

    Only touched partitions are read and replaced. The merged rows are written to a staging
    folder named after the batch first, so a replaced partition is never read and overwritten by
    one job, and a repeated batch gives the same lake.
    """
    spark = fresh.sparkSession
    fresh = fresh.selectExpr("*", "ba_code as ba", "date_format(period_utc, 'yyyy-MM') as month")
    touched = fresh.select(*LAKE_KEYS).distinct()
    existing = None
    if folder_has_data(spark, root):
        existing = touched_partitions(spark, root, touched)
    merged = upsert_measures(existing, fresh).select(*BRONZE_MEASURES.fieldNames(), *LAKE_KEYS)
    merged.write.mode("overwrite").partitionBy(*LAKE_KEYS).parquet(f"{staging}/batch={batch_id}")
    (
        spark.read.schema(_lake_schema())
        .parquet(f"{staging}/batch={batch_id}")
        .repartition(*LAKE_KEYS)
        .sortWithinPartitions(*LAKE_KEYS, "period_utc", "measure_code")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LAKE_KEYS)
        .parquet(root)
    )
    remove(spark, f"{staging}/batch={batch_id}")


def _lake_schema():
    from pyspark.sql import types as T

    return T.StructType([*BRONZE_MEASURES.fields, *[T.StructField(c, T.StringType(), True) for c in LAKE_KEYS]])


def ingest_stream(spark: SparkSession, landing: str, root: str, checkpoint: str, files_per_trigger: int = 1000) -> StreamingQuery:
    """Merge everything that has landed since the last run, then stop."""
    landed = (
        spark.readStream.schema(BRONZE_MEASURES).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
    )
    return (
        landed.writeStream.foreachBatch(lambda df, batch_id: merge_batch(df, root, f"{checkpoint}/staging", batch_id))
        .option("checkpointLocation", f"{checkpoint}/progress")
        .trigger(availableNow=True)
        .start()
    )
