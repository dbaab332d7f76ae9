"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def session_builder(
    app: str = "isoloir", scan_block: str = "128MB", hash_join_below: str = "16MB"
) -> SparkSession.Builder:
    """A builder with the wanted settings; master, memory and paths stay open.

    ``scan_block`` is how many bytes of a file one scan task reads.
    ``hash_join_below`` is the measured size (compressed) up to which a shuffled
    build partition is hashed instead of sorted. A hashed partition cannot spill,
    so several times this size, for each core of an executor, must fit its memory.
    """
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.maxPartitionBytes", scan_block)
        # AQE sizes shuffle partitions, splits skewed join partitions and
        # replaces sort-merge by broadcast joins on measured sizes.
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Hash instead of sort once every measured build partition is this small.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", hash_join_below)
        # Do not look up the Python call site of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )


@contextmanager
def scan_block(spark: SparkSession, size: str) -> Iterator[None]:
    """Scans that run in this block read at most so many bytes of a file in a task."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path below a folder that the driver and all executors share.

    That is what ``spark.checkpoint.dir`` names or, where it is unset, the
    warehouse. What one session writes there is removed when it ends in order.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        # The default warehouse is a folder of the driver's own machine.
        if not context.master.startswith("local") and not context.getConf().contains("spark.sql.warehouse.dir"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    root = f"{base.rstrip('/')}/scratch-{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch folder and read back, which cuts its lineage."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
