"""Row cleaning and typing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoloir.functions.columns import col
from isoloir.functions.text import strict_cast
from isoloir.operators.losses import Losses
from isoloir.schema import STATION_SCHEMA


def drop_incomplete(
    df: DataFrame,
    required: Sequence[str] | None = None,
    losses: Losses | None = None,
    name: str = "rows",
) -> DataFrame:
    """Rows where every required column (default: all) has a value.

    Written as one conjunction of ``IS NOT NULL`` so that a columnar source
    can skip by it. With ``losses``, which see every row, the others are counted
    as ``<name>_incomplete``.
    """
    names = df.columns if required is None else required
    kept = None
    for wanted in names:
        present = col(wanted).isNotNull()
        kept = present if kept is None else kept & present
    if kept is None:
        return df
    if losses is not None:
        df = losses.watch(df, **{f"{name}_incomplete": F.count_if(~kept)})
    return df.where(kept)


def conform(df: DataFrame, schema: T.StructType = STATION_SCHEMA) -> DataFrame:
    """Exactly the schema's columns, in its order and types, found by name.

    Casts are strict: a value that does not fit its type raises, in any session.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select(*[_typed(f, kinds.get(f.name)).alias(f.name) for f in schema])


def _typed(field: T.StructField, kind: T.DataType | None) -> Column:
    """The column as it is where its type is the wanted one: no cast, no check."""
    return col(field.name) if kind == field.dataType else strict_cast(field.name, field.dataType)
