"""Stored results: the station table and precomputed layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloir.operators.scales import LayerScales
from isoloir.schema import ELECTION, STORED_SCHEMA
from isoloir.versions import current, read_published


def read_stations(
    spark: SparkSession, path: str, election: int | None = None, version: int | None = None
) -> DataFrame:
    """The stored stations; ``election`` prunes to that election's folder.

    Of a table with versions, the latest or the one that is named.
    """
    if version is not None or current(spark, path) is not None:
        return read_published(spark, path, STORED_SCHEMA, election, version)
    stations = spark.read.schema(STORED_SCHEMA).parquet(path)
    return stations if election is None else stations.where(F.col(ELECTION) == election)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/points")


def read_scales(spark: SparkSession, path: str) -> LayerScales:
    """The scales that were stored with a layer: one row."""
    row = spark.read.parquet(f"{path}/scales").first().asDict()
    return LayerScales(tuple(row.pop("thresholds")), **row)


def jdbc_options(
    url: str,
    table: str,
    election: int | None = None,
    split_by: str | None = None,
    bounds: tuple[int, int] | None = None,
    tasks: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """What Spark's JDBC reader is asked for; see ``read_stations_jdbc``."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if election is not None:
        # A column of the stored table, so the database filters.
        options["dbtable"] = f"(SELECT * FROM {table} WHERE {ELECTION} = {int(election)}) AS chosen"
    if split_by is not None:
        if bounds is None or tasks is None:
            raise ValueError("a split needs the bounds of its column and the number of tasks")
        options |= {
            "partitionColumn": split_by,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(tasks),
        }
    return options


def read_stations_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: list[str] | None = None,
    properties: Mapping[str, str] | None = None,
    election: int | None = None,
    split_by: str | None = None,
    bounds: tuple[int, int] | None = None,
    tasks: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Stations kept in a relational table.

    ``split_by``, a number column, with its ``bounds`` spreads the scan over
    ``tasks``; rows beyond the bounds are read too, by the outer tasks. Instead,
    each of ``predicates`` (for instance one per department) can become one scan
    task; they must cover every row exactly once. Without either one task reads.
    ``fetch_size`` rows at a time reach a task, which some drivers otherwise
    give the whole result at once.
    """
    options = jdbc_options(url, table, election, split_by, bounds, tasks, fetch_size)
    if predicates:
        if split_by is not None:
            raise ValueError("either predicates or a column to split by")
        properties = {"fetchsize": options["fetchsize"], **(properties or {})}
        return spark.read.jdbc(url, options["dbtable"], predicates=predicates, properties=properties)
    return spark.read.format("jdbc").options(**{**options, **(properties or {})}).load()
