"""What readers ask of the station table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isoloir.functions.columns import col
from isoloir.operators.selection import (
    where_any_pair,
    where_equals,
    where_member,
    where_without_prefixes,
)
from isoloir.schema import CODE, COMMUNE, LABEL
from isoloir.session import stored

# Overseas and abroad: letter codes ZA to ZZ, and 97x and 98x.
OUTSIDE_METROPOLE = ("Z", "97", "98")


def departments(
    stations: DataFrame, label: str = LABEL, collation: str | None = None
) -> DataFrame:
    """Distinct labels, by code point, or in a language's order (``"fr"``)."""
    distinct = stations.select(col(label)).distinct()
    order = col(label) if collation is None else F.collate(col(label), collation)
    return distinct.orderBy(order)


def commune_pairs(
    stations: DataFrame,
    chosen: Iterable[str] | DataFrame,
    label: str = LABEL,
    commune: str = COMMUNE,
) -> DataFrame:
    """Distinct (department, commune) rows of the chosen departments.

    The shuffle is on both columns, after duplicates are removed where the
    rows are, so a large department is spread like any other.
    """
    return where_member(stations, label, chosen).select(col(label), col(commune)).distinct()


def communes_in_chunks(
    stations: DataFrame,
    chosen: Iterable[str] | DataFrame,
    size: int = 1_000,
    label: str = LABEL,
    commune: str = COMMUNE,
) -> DataFrame:
    """The sorted communes of each chosen department in rows of at most ``size``.

    ``chunk`` numbers the rows of a department from 0; all but its last are full. Columns of
    any number of values per group can be listed so: distinct pairs are dealt by ranges and
    stored, a range counts what it has of each department, and a commune's place is what the
    ranges before it count and its place within its own. A null commune is listed nowhere.
    """
    pairs = commune_pairs(stations, chosen, label, commune).toDF("label", "commune")
    # Ranges follow each other in the order of both columns, so a large department has several.
    ranged = pairs.where("commune IS NOT NULL").repartitionByRange("label", "commune")
    ranged = stored(ranged.select("*", F.spark_partition_id().alias("range")), "pairs")
    counts = ranged.groupBy("label", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("label").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("label", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    here = Window.partitionBy("label", "range").orderBy("commune")
    numbered = ranged.withColumn("own", F.row_number().over(here) - 1).join(firsts, ["label", "range"])
    chunk = F.floor((F.col("first") + F.col("own")) / size).cast("long")
    listed = numbered.groupBy("label", chunk.alias("chunk")).agg(F.array_sort(F.collect_list("commune")).alias("communes"))
    return listed.withColumnRenamed("label", label)


def communes_by_department(
    stations: DataFrame,
    chosen: Iterable[str] | DataFrame,
    label: str = LABEL,
    commune: str = COMMUNE,
) -> DataFrame:
    """Each chosen department with the sorted list of its communes.

    A list holds a department's different communes, of which there are some
    hundreds. For columns with more values per group use ``communes_in_chunks``
    or ``commune_pairs``.
    """
    pairs = commune_pairs(stations, chosen, label, commune)
    return pairs.groupBy(col(label)).agg(
        F.array_sort(F.collect_list(col(commune))).alias("communes")
    )


def stations_in(
    stations: DataFrame,
    zones: Iterable[str | tuple[str, str]] | DataFrame,
    commune: str = COMMUNE,
    label: str = LABEL,
) -> DataFrame:
    """Stations of the chosen communes, given by name or as (department, commune).

    ``zones`` is a list, or a table of one or two such columns.
    """
    if isinstance(zones, DataFrame):
        if len(zones.columns) == 2:
            return where_any_pair(stations, label, commune, zones)
        return where_member(stations, commune, zones)
    zones = list(zones)
    paired = [isinstance(z, tuple) for z in zones]
    if any(paired):
        if not all(paired):
            raise TypeError("zones are names or (department, commune) pairs, not both")
        return where_any_pair(stations, label, commune, zones)
    return where_member(stations, commune, zones)


def metropolitan(
    stations: DataFrame, code: str = CODE, outside: Iterable[str] = OUTSIDE_METROPOLE
) -> DataFrame:
    return where_without_prefixes(stations, code, outside)


def in_department(stations: DataFrame, wanted: str, code: str = CODE) -> DataFrame:
    return where_equals(stations, code, wanted)
