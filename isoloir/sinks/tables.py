"""Writers. Each is one distributed job; nothing passes through the driver."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloir.functions.columns import col
from isoloir.operators.scales import LayerScales
from isoloir.schema import ELECTION


def _clustered(df: DataFrame, partition: str, cluster_by: Sequence[str]) -> DataFrame:
    """Rows of equal ``cluster_by`` values near each other in the same files.

    ``rebalance`` lets AQE merge small and split oversized groups, so a key
    with a large share of the rows is spread over several tasks and files.
    """
    if not cluster_by:
        return df
    keys = [col(partition), *[col(c) for c in cluster_by]]
    return df.hint("rebalance", *keys).sortWithinPartitions(*keys)


def _folder_of(partition: str, value: object) -> str:
    """The folder of a partition; values that Spark would write escaped are refused."""
    if not re.fullmatch(r"[\w.-]+", str(value), re.ASCII):
        raise ValueError(f"cannot name a folder after {value!r}")
    return f"{partition}={value}"


def replace_stations(
    df: DataFrame,
    path: str,
    partition: str = ELECTION,
    cluster_by: Sequence[str] = (),
    max_records_per_file: int = 0,
    elections: Iterable[object] | None = None,
    bloom_on: Sequence[str] = (),
) -> None:
    """Write ``df`` so that each election in it replaces its stored rows.

    Elections that ``df`` does not hold stay as they are. Readers may see some of several
    elections replaced before the others, and a job that fails leaves those replaced; a table
    that must not be seen so has versions (``versions.publish_stations``). With ``elections``,
    exactly those are replaced, one job each: one that has no rows in ``df`` has
    none afterwards, and rows of others are not written. Without
    ``cluster_by`` there is no shuffle; with it, one shuffle at build time lets
    later reads by those columns skip row groups; columns in ``bloom_on`` get
    filters by which reads skip row groups that have none of the values they
    look for, however the rows are sorted. The replaced files go when
    the job commits. Never pass a ``df`` that reads ``path`` itself.
    """
    if elections is None:
        targets = {path: _clustered(df, partition, cluster_by)}
    else:
        targets = {}
        for value in elections:
            rows = _clustered(df.where(col(partition) == F.lit(value)), partition, cluster_by)
            targets[f"{path}/{_folder_of(partition, value)}"] = rows.drop(partition)
    for target, rows in targets.items():
        writer = rows.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
        for name in bloom_on:
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        if elections is None:
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition)
        writer.parquet(target)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> bool:
    """Create the database if needed; true if it was there (case is ignored)."""
    existed = spark.catalog.databaseExists(name)
    quoted = "`" + name.replace("`", "``") + "`"
    if location is None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted}")
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted} LOCATION :place", {"place": location})
    return existed


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """For ``insertInto``, which ignores the writer option of the same name."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def replace_table(
    df: DataFrame,
    table: str,
    partition: str = ELECTION,
    path: str | None = None,
    elections: Iterable[object] | None = None,
) -> None:
    """As ``replace_stations``, for a catalogue table, made on the first call."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        kept = df if elections is None else df.where(col(partition).isin(list(elections)))
        writer = kept.write.format("parquet").partitionBy(partition)
        if path is not None:
            writer = writer.option("path", path)
        writer.saveAsTable(table)
        return
    names = spark.table(table).columns
    rows = df.select(*[col(n) for n in names])
    if elections is None:
        with _dynamic_overwrite(spark):
            rows.write.insertInto(table, overwrite=True)
        return
    quoted = "`" + partition.replace("`", "``") + "`"
    for value in elections:
        # A named partition is emptied also by a query without rows.
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION ({quoted} = :value) SELECT * FROM {{rows}}",
            args={"value": value},
            rows=rows.where(col(partition) == F.lit(value)).drop(partition),
        )


def save_layer(layer: DataFrame, path: str, scales: LayerScales | None = None) -> None:
    """Store a finished layer, and its scales beside it; serving it is a plain scan."""
    layer.write.mode("overwrite").parquet(f"{path}/points")
    if scales is not None:
        row = layer.sparkSession.range(1).select(*[F.lit(v).cast(t).alias(n) for n, v, t in scales.fields()])
        row.write.mode("overwrite").parquet(f"{path}/scales")


def write_stations_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    connections: int,
    properties: Mapping[str, str] | None = None,
    batch_size: int = 10_000,
) -> None:
    """Replace a relational table; at most ``connections`` tasks write at once.

    How many the database grants is for the caller to say. Spark drops and
    refills the table, so readers see it part-filled meanwhile.
    """
    (
        df.write.mode("overwrite")
        .option("numPartitions", connections)
        .option("batchsize", batch_size)
        .jdbc(url, table, properties=dict(properties or {}))
    )
