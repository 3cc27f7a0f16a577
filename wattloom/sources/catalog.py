"""Questions about the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.schemas import DATA_TABLES, MODEL_TABLES, QUERY_TABLES


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def register(tables: dict[str, DataFrame]) -> None:
    """Make frames queryable by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def row_count(spark: SparkSession, name: str) -> int:
    return spark.table(name).count() if table_exists(spark, name) else 0


def summarise(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """One row per table with its row count, in one job."""
    names = sorted(names or [t.name for t in spark.catalog.listTables()])
    frames = [spark.table(n).agg(F.count(F.lit(1)).alias("rows")).selectExpr(f"'{n}' as table", "rows") for n in names]
    if not frames:
        return spark.createDataFrame([], "table string, rows long")
    counted = frames[0]
    for frame in frames[1:]:
        counted = counted.unionByName(frame)
    return counted


def describe_schema(spark: SparkSession, allowed: tuple[str, ...] | set[str] = QUERY_TABLES) -> str:
    """Allowed tables that exist, as ``name(column type, ...)`` lines."""
    lines = []
    for name in sorted(allowed):
        if table_exists(spark, name):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.table(name).schema.fields)
            lines.append(f"{name}({columns})")
    return "\n".join(lines) if lines else "(warehouse is empty)"


def drop_for_rebuild(spark: SparkSession) -> list[str]:
    """Drop the data-layer tables; returns the model outputs that are now stale (and kept)."""
    views = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    for name in DATA_TABLES:
        if name in views:
            spark.catalog.dropTempView(name)
        elif table_exists(spark, name):
            spark.sql(f"drop table {name}")
    return [name for name in MODEL_TABLES if table_exists(spark, name)]
