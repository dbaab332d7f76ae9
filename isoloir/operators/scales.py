"""Scales of a map layer: fitted on the displayed rows, then applied to them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloir.functions.columns import ColumnOrName, column
from isoloir.functions.scales import COLOURS, class_colour, linear_size, quantile_class
from isoloir.operators.quantiles import (
    approximate_thresholds,
    branch,
    histogram_of,
    merged,
    quantile_thresholds,
    sketch_of,
)
from isoloir.schema import LATITUDE, LONGITUDE, RATE, REGISTERED


@dataclass(frozen=True)
class LayerScales:
    """Some fifteen numbers that fix a layer's colours, sizes and view."""

    thresholds: tuple[float, ...]
    size_low: float | None
    size_high: float | None
    south: float | None
    north: float | None
    west: float | None
    east: float | None

    def fields(self) -> list[tuple[str, object, str]]:
        """Name, value and type of every number, for a table of one row."""
        names = ("size_low", "size_high", "south", "north", "west", "east")
        numbers = [(n, getattr(self, n), "double") for n in names]
        return [("thresholds", list(self.thresholds), "array<double>"), *numbers]

    @property
    def centre(self) -> tuple[float, float] | None:
        if self.south is None or self.west is None:
            return None
        return (self.south + self.north) / 2, (self.west + self.east) / 2


def _finite(c: Column) -> Column:
    """Null instead of NaN and infinity, which would make every bound useless."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def size_domain(df: DataFrame, size: ColumnOrName = REGISTERED) -> DataFrame:
    size = _finite(column(size))
    return df.agg(F.min(size).alias("size_min"), F.max(size).alias("size_max"))


def extent(
    df: DataFrame, latitude: ColumnOrName = LATITUDE, longitude: ColumnOrName = LONGITUDE
) -> DataFrame:
    """One row: the bounding box of the points that have a place, and its centre."""
    lat, lon = _finite(column(latitude)), _finite(column(longitude))
    box = df.agg(
        F.min(lat).alias("south"),
        F.max(lat).alias("north"),
        F.min(lon).alias("west"),
        F.max(lon).alias("east"),
    )
    return box.select(
        "*",
        ((F.col("south") + F.col("north")) / 2).alias("centre_latitude"),
        ((F.col("west") + F.col("east")) / 2).alias("centre_longitude"),
    )


def fit_scales(
    df: DataFrame,
    rate: ColumnOrName = RATE,
    size: ColumnOrName = REGISTERED,
    latitude: ColumnOrName = LATITUDE,
    longitude: ColumnOrName = LONGITUDE,
    classes: int = len(COLOURS),
    accuracy: int | None = None,
) -> LayerScales:
    """The scales of exactly these rows.

    One aggregate gives the counts, domains and bounds and a first histogram of
    the rate; the exact quantiles follow in a few narrow passes over the rate
    alone. With ``accuracy`` they are approximate and take one pass. What is null,
    NaN or infinite shapes no scale. Rows that are costly to compute should be
    stored first and read back.
    """
    value = _finite(column(rate).cast("double"))
    size, lat, lon = (_finite(column(c)) for c in (size, latitude, longitude))
    bounds = {"low": value, "size_low": size, "south": lat, "west": lon}
    tops = {"high": value, "size_high": size, "north": lat, "east": lon}
    exact = accuracy is None
    sketch = [sketch_of(value).alias("sketch")] if exact else []
    parts = df.groupBy(branch().alias("branch")).agg(
        F.count(value).alias("n"),
        *[F.min(c).alias(n) for n, c in bounds.items()],
        *[F.max(c).alias(n) for n, c in tops.items()],
        *sketch,
    )
    whole = parts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        *[F.min(n).alias(n) for n in bounds],
        *[F.max(n).alias(n) for n in tops],
        *[merged("sketch").alias("sketch") for _ in sketch],
    )
    if exact:
        row = whole.withColumn("histogram", histogram_of("sketch", "n")).drop("sketch").first()
        start = (row["n"], row["low"], row["high"], row["histogram"])
        cuts = quantile_thresholds(df, rate, classes, start)
    else:
        row = whole.first()
        cuts = approximate_thresholds(df, rate, classes, accuracy)
    return LayerScales(
        cuts,
        row["size_low"],
        row["size_high"],
        row["south"],
        row["north"],
        row["west"],
        row["east"],
    )


def apply_scales(
    df: DataFrame,
    scales: LayerScales,
    rate: ColumnOrName = RATE,
    size: ColumnOrName = REGISTERED,
    colours: Sequence[str] = COLOURS,
) -> DataFrame:
    """Add class, colour, stroke colour and size: one projection, no shuffle."""
    chosen = quantile_class(rate, scales.thresholds)
    return df.select(
        "*",
        chosen.alias("colour_class"),
        class_colour(chosen, colours).alias("colour"),
        class_colour(chosen, colours).alias("stroke_colour"),
        linear_size(size, scales.size_low, scales.size_high).alias("size"),
    )
