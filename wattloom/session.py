"""Session settings every plan relies on, and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_REMEMBERED: list[dict] = []


def configure(spark: SparkSession) -> SparkSession:
    """Pin the semantics the plans assume. Sizes and parallelism stay the cluster's own."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # A window over (key, chunk) must spread its chunks even when a join left rows hashed by key.
    spark.conf.set("spark.sql.requireAllClusterKeysForDistribution", "true")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    ship_package(spark)
    return spark


def _path(spark: SparkSession, path: str):
    """A Hadoop path and the file system it is on."""
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is."""
    found, system = _path(spark, path)
    system.delete(found, True)


def exists(spark: SparkSession, path: str) -> bool:
    found, system = _path(spark, path)
    return system.exists(found)


def rename(spark: SparkSession, path: str, to: str) -> None:
    found, system = _path(spark, path)
    if not system.rename(found, _path(spark, to)[0]):
        raise OSError(f"{path} could not be renamed to {to}")


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once an application: pandas functions are looked up by module there."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(top)):
            for name in sorted(names):
                if name.endswith(".py"):
                    archive.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(top)))
    path = f"{application_folder(spark)}/package.zip"
    found, system = _path(spark, path)
    out = system.create(found, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def local_session(cores: int | str = 8, name: str = "wattloom", **extra: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The reliable folder of the cluster (``spark.checkpoint.dir``).

    Only where it is unset and the whole cluster is this machine, as in tests, a folder is made up; it
    goes when Python ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="wattloom-checkpoint-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def application_folder(spark: SparkSession) -> str:
    """Where this application keeps what it writes for itself."""
    return f"{shared_folder(spark)}/wattloom/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Remove everything this application has written for itself; frames that read it are void afterwards."""
    remove(spark, application_folder(spark))
    _SHIPPED.discard(spark.sparkContext.applicationId)
    for frames in _REMEMBERED:
        frames.clear()


def remembered() -> dict:
    """A dictionary for frames over written tables; ``release`` empties it."""
    _REMEMBERED.append({})
    return _REMEMBERED[-1]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from the written rows.

    Used where a result feeds several later branches or an iterative fit: the upstream plan runs
    once, a lost executor never re-runs it, later scans read only the columns they need, and
    later joins are planned on the table's real size. ``release`` removes all of them.
    """
    spark = df.sparkSession
    path = f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, *steps: Callable) -> list:
    """The results of steps that do not wait for each other; the jobs of one fill the cores another leaves idle."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [one.result() for one in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]


def dealt_out(df: DataFrame, by: str) -> DataFrame:
    """Spread a table that is stored in fewer pieces than there are cores; otherwise leave it.

    Rows go by the hash of a column, which needs no sort and repeats exactly after a lost task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, by) if df.rdd.getNumPartitions() < cores else df
