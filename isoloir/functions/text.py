"""Cleaning of text values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from isoloir.functions.columns import ColumnOrName, column
from isoloir.schema import NA_TOKENS


def null_tokens(c: ColumnOrName, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """Null where the text is one of ``tokens``; case and blanks count."""
    c = column(c)
    return F.when(~c.isin(*tokens), c)


def default_null(c: ColumnOrName, value: str) -> Column:
    return F.coalesce(column(c), F.lit(value))


def strict_cast(c: ColumnOrName, kind: str | DataType) -> Column:
    """The value as another type; one that does not fit raises.

    The expression itself raises, whether or not the session is in ANSI mode.
    """
    return or_raise(column(c), column(c).try_cast(kind))


def or_raise(c: Column, value: Column) -> Column:
    """``value``; where that is null although ``c`` is not, an error that shows ``c``."""
    message = F.concat(F.lit("CAST_INVALID_INPUT: "), F.left(c.cast("string"), F.lit(100)))
    return F.when(c.isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value)


def decimal_comma(c: ColumnOrName) -> Column:
    """``'20,53'`` as the double 20.53; text that is no number raises.

    ``replace`` searches bytes; ``translate`` looks up every character and is
    several times slower.
    """
    return strict_cast(F.replace(column(c).cast("string"), F.lit(","), F.lit(".")), "double")


def _packed_part(c: ColumnOrName, index: int, on_bad: str) -> Column:
    value = F.get(F.split(column(c), ","), F.lit(index)).try_cast("double")
    if on_bad == "raise":
        return or_raise(column(c), value)
    if on_bad == "null":
        return value
    raise ValueError(f"on_bad must be 'raise' or 'null', not {on_bad!r}")


def latitude_of(packed: ColumnOrName, on_bad: str = "raise") -> Column:
    """First part of ``'lat,lon'``."""
    return _packed_part(packed, 0, on_bad)


def longitude_of(packed: ColumnOrName, on_bad: str = "raise") -> Column:
    """Second part of ``'lat,lon'``; without a comma it raises or is null."""
    return _packed_part(packed, 1, on_bad)


def drop_first_char(c: ColumnOrName) -> Column:
    """Text without its first character: the LF that a CR-only split leaves."""
    c = column(c)
    return F.substring(c, F.lit(2), F.length(c))


def pad_once(c: ColumnOrName, length: int) -> Column:
    """One leading ``0`` if the text is shorter than ``length``, never more."""
    c = column(c)
    return F.when(F.length(c) < length, F.concat(F.lit("0"), c)).otherwise(c)


def last_chars(c: ColumnOrName, n: int) -> Column:
    return F.right(column(c), F.lit(n))


def int_text(c: ColumnOrName) -> Column:
    """Number text as integer text: ``'01000'`` and ``'1000.0'`` are ``'1000'``."""
    c = column(c)
    return or_raise(c, c.try_cast("double").try_cast("bigint").cast("string"))


def joined_text(*parts: ColumnOrName) -> Column:
    """Parts separated by one blank; null as soon as one part is null."""
    pieces = [column(parts[0])]
    for part in parts[1:]:
        pieces += [F.lit(" "), column(part)]
    return F.concat(*pieces)


def label_with_code(label: ColumnOrName, code: ColumnOrName) -> Column:
    """``'Ain (01)'``; null when either is null."""
    return F.concat(column(label), F.lit(" ("), column(code), F.lit(")"))
