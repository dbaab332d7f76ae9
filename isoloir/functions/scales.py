"""Visual channels as expressions over already known scale parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from isoloir.functions.columns import ColumnOrName, column

# Class colours, yellow for low to red for high, and point sizes.
COLOURS = ("#FFFF00", "#FFCC00", "#FF9900", "#FF6600", "#FF3300", "#FF0000")
SIZE_RANGE = (0.0, 50.0)


def quantile_class(value: ColumnOrName, thresholds: Sequence[float]) -> Column:
    """How many thresholds the value reaches: 0 for the lowest class.

    Equal values share a class. Null and NaN have none, and nothing has one
    without thresholds (a scale over no values).
    """
    value = column(value).cast("double")
    if not thresholds:
        return F.lit(None).cast("int")
    reached = sum((value >= t).cast("int") for t in thresholds[1:])
    return F.when(
        value.isNotNull() & ~F.isnan(value), (value >= thresholds[0]).cast("int") + reached
    )


def class_colour(quantile: ColumnOrName, colours: Sequence[str] = COLOURS) -> Column:
    return F.get(F.array(*[F.lit(c) for c in colours]), column(quantile))


def linear_size(
    value: ColumnOrName,
    low: float | None,
    high: float | None,
    size_range: tuple[float, float] = SIZE_RANGE,
) -> Column:
    """The value's place between ``low`` and ``high``, stretched over ``size_range``.

    A domain of one single value gives the middle of the range. Null, NaN and
    infinity have no size.
    """
    smallest, largest = size_range
    value = column(value).cast("double")
    value = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
    if low is None or high is None:
        return F.lit(None).cast("double")
    if low == high:
        return F.when(value.isNotNull(), F.lit((smallest + largest) / 2))
    size = (value - F.lit(float(low))) / F.lit(float(high) - float(low)) * (largest - smallest)
    return size + smallest if smallest else size
