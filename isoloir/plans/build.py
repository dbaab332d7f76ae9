"""From an election's three sources to its station table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloir.functions import (
    col,
    decimal_comma,
    geo_key,
    int_text,
    joined_text,
    label_with_code,
    latitude_of,
    longitude_of,
    results_key,
)
from isoloir.operators.cleaning import conform, drop_incomplete
from isoloir.operators.enrich import attach_by_key
from isoloir.operators.losses import Losses
from isoloir.operators.selection import where_equals, where_prefix
from isoloir.schema import (
    ABSTENTIONS,
    ADDRESS,
    CODE,
    COMMUNE,
    CONSTITUENCY,
    DEPARTMENT,
    ELECTION,
    LABEL,
    LATITUDE,
    LONGITUDE,
    RATE,
    RAW_RATE,
    REGISTERED,
    STATION,
    ElectionSpec,
)
from isoloir.sources.delimited import read_delimited


def export_stations(
    export: DataFrame,
    spec: ElectionSpec,
    on_bad: str = "raise",
    keep_postal_zero: bool = False,
    losses: Losses | None = None,
) -> DataFrame:
    """Stations of the results export, whose rows carry packed coordinates."""
    complete = drop_incomplete(export, spec.export.columns, losses, "export")
    complete = complete.withColumnsRenamed(dict(spec.renames))
    number_texts = () if keep_postal_zero else spec.integer_text
    address = [int_text(part) if part in number_texts else col(part) for part in spec.address]
    return conform(
        complete.select(
            col(CODE),
            col(DEPARTMENT),
            col(COMMUNE),
            col(REGISTERED),
            col(ABSTENTIONS),
            decimal_comma(RAW_RATE).alias(RATE),
            latitude_of(spec.coordinates, on_bad).alias(LATITUDE),
            longitude_of(spec.coordinates, on_bad).alias(LONGITUDE),
            label_with_code(DEPARTMENT, CODE).alias(LABEL),
            joined_text(*address).alias(ADDRESS),
        )
    )


def rebuilt_stations(
    official: DataFrame, geo: DataFrame, spec: ElectionSpec, losses: Losses | None = None
) -> DataFrame:
    """Stations of the department that gets its coordinates from the geo table."""
    results = where_equals(official, DEPARTMENT, spec.rebuilt_department)
    places = where_prefix(geo, "code_postal", spec.rebuilt_postal_prefix)
    joined = attach_by_key(
        places,
        results,
        geo_key("circonscription_code", "code_postal", "code"),
        results_key(CODE, CONSTITUENCY, STATION),
        (LONGITUDE, LATITUDE, "geo_adresse"),
        (CODE, DEPARTMENT, COMMUNE, RAW_RATE, REGISTERED, ABSTENTIONS),
        losses,
        "geo",
    )
    return conform(
        joined.withColumnRenamed("geo_adresse", ADDRESS).select(
            "*",
            decimal_comma(RAW_RATE).alias(RATE),
            label_with_code(DEPARTMENT, CODE).alias(LABEL),
        )
    )


def build_stations(
    export: DataFrame,
    official: DataFrame,
    geo: DataFrame,
    spec: ElectionSpec,
    on_bad: str = "raise",
    keep_postal_zero: bool = False,
    losses: Losses | None = None,
) -> DataFrame:
    """The election's stations: both branches, every row kept, typed alike.

    With ``losses`` the rows left out are counted once the stations are used: incomplete ones
    of the export (``export_incomplete``), places without a result (``geo_left_alone``) and
    results of the rebuilt department without a place (``geo_right_alone``).
    """
    stations = export_stations(export, spec, on_bad, keep_postal_zero, losses).unionByName(
        rebuilt_stations(official, geo, spec, losses)
    )
    return stations.withColumn(ELECTION, F.lit(spec.year))


def read_election(
    spark: SparkSession,
    spec: ElectionSpec,
    export: str,
    official: str,
    geo: str,
    losses: Losses | None = None,
    **options,
) -> DataFrame:
    """``build_stations`` over the three files at these paths.

    With ``losses`` the readers count as well: ``export_read`` and ``export_ragged`` (rows with
    more or fewer fields than the header), and the same of ``official`` and ``places``.
    """
    return build_stations(
        read_delimited(spark, export, spec.export, losses, "export"),
        read_delimited(spark, official, spec.official, losses, "official"),
        read_delimited(spark, geo, spec.geo, losses, "places"),
        spec,
        losses=losses,
        **options,
    )
