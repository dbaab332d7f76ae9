"""The equi-join on a computed text key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloir.functions.columns import col
from isoloir.operators.losses import Losses

_KEY, _LEFT, _RIGHT = "__station_key", "__left", "__right"


def attach_by_key(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: Column,
    left_columns: Sequence[str],
    right_columns: Sequence[str],
    losses: Losses | None = None,
    name: str = "join",
) -> DataFrame:
    """Inner many-to-many join on two computed keys, unmatched rows left out.

    Both sides are cut to the kept columns and the key before they meet. No
    join hint: Spark broadcasts a side only on its size, else it shuffles both
    on the key and AQE splits partitions that one frequent key makes too large.

    With ``losses`` the same rows come from a full join, and those that either side
    alone has are counted as ``<name>_left_alone`` and ``<name>_right_alone``; both
    sides are then shuffled.
    """
    left = left.select(left_key.alias(_KEY), *[col(c) for c in left_columns])
    right = right.select(right_key.alias(_KEY), *[col(c) for c in right_columns])
    if losses is None:
        joined = left.join(right, _KEY, "inner")
    else:
        left, right = left.withColumn(_LEFT, F.lit(True)), right.withColumn(_RIGHT, F.lit(True))
        counts = {
            f"{name}_left_alone": F.count_if(col(_RIGHT).isNull()),
            f"{name}_right_alone": F.count_if(col(_LEFT).isNull()),
        }
        joined = losses.watch(left.join(right, _KEY, "full"), **counts)
        joined = joined.where(col(_LEFT).isNotNull() & col(_RIGHT).isNotNull())
    return joined.select(*[col(c) for c in (*left_columns, *right_columns)])
