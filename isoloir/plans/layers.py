"""Map-ready layers."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession

from isoloir.functions.columns import col
from isoloir.operators.scales import LayerScales, apply_scales, fit_scales
from isoloir.plans.questions import metropolitan
from isoloir.schema import (
    ABSTENTIONS,
    ADDRESS,
    COMMUNE,
    DEPARTMENT,
    LATITUDE,
    LONGITUDE,
    RATE,
    REGISTERED,
)
from isoloir.sources.tables import read_layer, read_scales, read_stations
from isoloir.versions import current, publish_layer

SHOWN_RATE = "Pourcentage Abstentions"
# The fields of a point's tooltip, in display order.
TOOLTIP = (SHOWN_RATE, ABSTENTIONS, REGISTERED, DEPARTMENT, COMMUNE, ADDRESS)
NATIONAL = "national"
CHANNELS = ("colour_class", "colour", "stroke_colour", "size")


class StaleLayer(RuntimeError):
    """The stations have changed since the layer was made of them."""


def points(stations: DataFrame) -> DataFrame:
    """Position and tooltip fields, the rate under its display name."""
    shown = stations.withColumnRenamed(RATE, SHOWN_RATE)
    return shown.select(*[col(c) for c in (LATITUDE, LONGITUDE, *TOOLTIP)])


def layer_with_scales(
    stations: DataFrame, scales: LayerScales | None = None, accuracy: int | None = None
) -> tuple[DataFrame, LayerScales]:
    """Points with tooltip fields and visual channels, and the scales they were made with.

    The scales hold the thresholds, size domain, bounds and centre that a legend and a
    view need. They belong to the rows shown, so they are fitted on them (a few
    aggregates over two or three columns) unless given. Ask of a stored table:
    an unstored build would be computed again by each of them.
    """
    if scales is None:
        scales = fit_scales(stations, accuracy=accuracy)
    return apply_scales(points(stations), scales, SHOWN_RATE, REGISTERED), scales


def map_layer(
    stations: DataFrame, scales: LayerScales | None = None, accuracy: int | None = None
) -> DataFrame:
    """The layer of ``layer_with_scales`` alone."""
    return layer_with_scales(stations, scales, accuracy)[0]


def publish_national_layer(spark: SparkSession, path: str, **options) -> tuple[DataFrame, LayerScales]:
    """Make the layer of metropolitan France of a table with versions, and publish it there.

    Points, scales and the version of the stations appear together. ``options`` go to
    ``metropolitan``.
    """
    made_of = current(spark, path)
    stations = read_stations(spark, path, version=made_of.number)
    layer, scales = layer_with_scales(metropolitan(stations, **options))
    publish_layer(layer, path, NATIONAL, asdict(scales), made_of.stations)
    return published_national_layer(spark, path)


def published_national_layer(
    spark: SparkSession, path: str, on_stale: str = "recompute", **options
) -> tuple[DataFrame, LayerScales]:
    """The published layer with its scales, if the stations are still those it was made of.

    Otherwise, and where none was published, it is made anew and published, or refused
    (``on_stale="raise"``).
    """
    pointer = current(spark, path)
    layer = None if pointer is None else pointer.layers.get(NATIONAL)
    if layer is None or layer["stations"] != pointer.stations:
        if on_stale == "raise" or pointer is None:
            raise StaleLayer(f"{path} has no layer of its present stations")
        return publish_national_layer(spark, path, **options)
    scales = {**layer["scales"], "thresholds": tuple(layer["scales"]["thresholds"])}
    return spark.read.parquet(f"{path.rstrip('/')}/{layer['folder']}"), LayerScales(**scales)


def national_layer(
    spark: SparkSession, stations: DataFrame | None = None, saved: str | None = None
) -> tuple[DataFrame, LayerScales]:
    """Metropolitan France with its scales: as saved if it was, else computed now.

    A layer saved by itself does not know its stations; one that is to follow them is
    published with them (``published_national_layer``).
    """
    if saved is not None:
        return read_layer(spark, saved), read_scales(spark, saved)
    if stations is None:
        raise ValueError("a national layer needs stations or the path of a saved one")
    return layer_with_scales(metropolitan(stations))
