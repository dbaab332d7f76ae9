"""Row selection. Every predicate is one that a Parquet scan can take over."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloir.functions.columns import ColumnOrName, col, column

# Longer lists are written into the plan as one text, since each value of a list of columns is
# a call to the JVM; still longer ones are joined as a table behind a filter of the ranges they
# lie in. Only the plan differs: rows, columns and their order are the same.
INLINE_VALUES = 1_000
FILTER_VALUES = 20_000
# Ranges that a list too long for a filter is covered by.
RANGES = 200
# What is trimmed from chosen values, in lists and in tables: every white-space character.
BLANKS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


def chosen_values(values: Iterable[str | None]) -> list[str]:
    """Distinct form values, trimmed, blanks left out, first occurrence first."""
    trimmed = ((v or "").strip(BLANKS) for v in values)
    return list(dict.fromkeys(v for v in trimmed if v))


def _trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def _listed(spark: SparkSession, **columns: Sequence[str]) -> DataFrame:
    """Rows that the plan holds: Spark knows their size, so a short list is broadcast
    before the rows it selects from are shuffled."""
    return spark.createDataFrame(pa.table({n: pa.array(v, pa.string()) for n, v in columns.items()}))


def _semi_join(df: DataFrame, wanted: DataFrame, names: Sequence[str]) -> DataFrame:
    kept = df.join(wanted, list(names), "left_semi")
    # A join on names moves them to the front.
    return kept.select(*[col(n) for n in df.columns])


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def covering_ranges(values: Iterable[str], ranges: int = RANGES) -> list[tuple[str, str]]:
    """Ranges, few and disjoint, that hold all values: equally many values in each."""
    # Spark and Parquet compare texts by their bytes.
    ordered = sorted(set(values), key=lambda v: v.encode("utf-8", "surrogatepass"))
    size = max(1, -(-len(ordered) // ranges))
    return [(ordered[k], ordered[min(k + size, len(ordered)) - 1]) for k in range(0, len(ordered), size)]


def _scan_filter(name: str, values: Sequence[str], inline: int, filtered: int) -> tuple[Column, bool]:
    """A filter that a scan takes over, by which row groups are skipped; whether it is exact.

    Equal values are looked for in the bounds, dictionaries and Bloom filters of a row group,
    ranges in its bounds.
    """
    if len(values) <= inline:
        return col(name).isin(list(values)), True
    quoted = "`" + name.replace("`", "``") + "`"
    if len(values) <= filtered:
        return F.expr(f"{quoted} IN ({', '.join(map(_quoted, values))})"), True
    spans = [f"{quoted} BETWEEN {_quoted(a)} AND {_quoted(b)}" for a, b in covering_ranges(values)]
    return F.expr(" OR ".join(spans)), False


def where_equals(df: DataFrame, c: ColumnOrName, value) -> DataFrame:
    return df.where(column(c) == F.lit(value))


def where_prefix(df: DataFrame, c: ColumnOrName, prefix: str, default: str = "00") -> DataFrame:
    """Rows whose text starts with ``prefix``; a null counts as ``default``.

    The default is compared here, once, so that the scan sees a bare prefix
    predicate instead of one hidden behind ``coalesce``.
    """
    c = column(c)
    if default.startswith(prefix):
        return df.where(c.isNull() | c.startswith(prefix))
    return df.where(c.startswith(prefix))


def where_without_prefixes(df: DataFrame, c: ColumnOrName, prefixes: Iterable[str]) -> DataFrame:
    """Rows whose text is present and starts with none of ``prefixes``."""
    c = column(c)
    kept = c.isNotNull()
    for prefix in prefixes:
        kept = kept & ~c.startswith(prefix)
    return df.where(kept)


def where_member(
    df: DataFrame,
    name: str,
    chosen: Iterable[str | None] | DataFrame,
    inline: int = INLINE_VALUES,
    filtered: int = FILTER_VALUES,
) -> DataFrame:
    """Rows whose ``name`` is one of the chosen texts; nothing chosen, no rows.

    ``chosen`` is a list as a form submits it, or a one-column DataFrame.
    Repeats and blanks do no harm. Up to ``filtered`` listed values are a filter
    that a scan takes over; of more, the ranges they lie in are, and the values
    are joined as a table is. Whether that is by broadcast is left to Spark's
    size check.
    """
    if not isinstance(chosen, DataFrame):
        values = chosen_values(chosen)
        found, exact = _scan_filter(name, values, inline, filtered)
        df = df.where(found)
        if exact:
            return df
        chosen = _listed(df.sparkSession, value=values)
    wanted = chosen.select(_trimmed(col(chosen.columns[0])).alias(name))
    return _semi_join(df, wanted.where(col(name) != ""), [name])


def where_any_pair(
    df: DataFrame,
    first: str,
    second: str,
    chosen: Iterable[tuple[str, str]] | DataFrame,
    inline: int = INLINE_VALUES,
    filtered: int = FILTER_VALUES,
) -> DataFrame:
    """Rows whose two columns equal one of the chosen pairs.

    Tells apart communes of the same name in two departments. ``chosen`` is a
    list of pairs or a two-column DataFrame. Of a list, the different values of
    each column, or the ranges they lie in, are a filter that a scan takes over;
    the pairs themselves are joined.
    """
    if not isinstance(chosen, DataFrame):
        trimmed = (((a or "").strip(BLANKS), (b or "").strip(BLANKS)) for a, b in chosen)
        pairs = list(dict.fromkeys((a, b) for a, b in trimmed if a and b))
        firsts, seconds = [p[0] for p in pairs], [p[1] for p in pairs]
        kept = df
        for name, values in ((first, set(firsts)), (second, set(seconds))):
            kept = kept.where(_scan_filter(name, sorted(values), inline, filtered)[0])
        chosen = _listed(df.sparkSession, first=firsts, second=seconds)
        df = kept
    a, b = chosen.columns
    wanted = chosen.select(_trimmed(col(a)).alias(first), _trimmed(col(b)).alias(second))
    return _semi_join(df, wanted.where((col(first) != "") & (col(second) != "")), [first, second])
