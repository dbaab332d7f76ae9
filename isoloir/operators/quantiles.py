"""Exact quantiles of a column, whatever its size and distribution.

``percentile`` keeps every distinct value in one aggregation buffer and merges
all of them in one task. Here the first pass makes a KLL sketch, from which a
histogram of ``STEPS`` about equally full steps tells between which two values
each wanted rank must lie. The next pass counts exactly how many rows are below,
at and between those values. Where only ``FEW_ROWS`` or less can lie between, it
also counts those value by value, which ends it; else it sketches them, and them
alone. So each pass leaves some four thousandths of the rows for each rank,
however the values are spread: two passes for a million rows, four for a
trillion. Equal values are one cut and are never counted again. If a sketch errs,
the exact counts say so and the rank is sought where they put it.

Sketches are merged in two levels: those of the scan tasks in ``BRANCHES`` tasks,
and theirs in one. Only the few numbers that describe the cells hit by a rank,
and their histograms, reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from isoloir.functions.columns import ColumnOrName, column

STEPS = 1000
# Size of a sketch: ranks are off by a seventh of a hundredth at most, as a rule.
SKETCH = 2048
# Sketches that the last merge takes, at most.
BRANCHES = 256
# A span of no more rows than this is counted by value.
FEW_ROWS = 100_000

#: Rows, smallest and largest value, and histogram of a column.
Start = tuple[int, float, float, Sequence[float]]


@dataclass(frozen=True)
class _Span:
    """The rows with values from ``low`` to ``high`` and the ranks wanted there.

    ``below`` rows have smaller values than ``low``. Without a histogram, one has
    to be made before the span can be cut.
    """

    low: float
    high: float
    rows: int
    below: int
    ranks: tuple[int, ...]
    histogram: tuple[float, ...] | None

    def holds(self, v: Column) -> Column:
        return v.between(self.low, self.high)

    def brackets(self) -> list[tuple[float, float]]:
        """Values that each wanted rank lies between, one step further on both sides."""
        steps = len(self.histogram) - 1
        at = [(rank - self.below) * steps // self.rows for rank in self.ranks]
        return [(self.histogram[max(0, k - 1)], self.histogram[min(steps, k + 2)]) for k in at]

    def cuts(self) -> list[float]:
        return sorted({cut for pair in self.brackets() for cut in pair})

    def cell(self, v: Column) -> Column:
        """Even numbers between the cuts, odd ones at them; ascending with the value."""
        return sum((v >= c).cast("int") + (v > c).cast("int") for c in self.cuts())

    def wanted(self) -> list[int]:
        """Cells between the cuts in which the wanted ranks are expected."""
        place = {cut: k for k, cut in enumerate(self.cuts())}
        return sorted({2 * k for low, high in self.brackets() for k in range(place[low] + 1, place[high] + 1)})

    def expected(self) -> float:
        """About how many rows the wanted cells have."""
        steps = len(self.histogram) - 1
        return min(1.0, 3 * len(self.ranks) / steps) * self.rows


def sketch_of(v: Column) -> Column:
    """What ``histogram_of`` makes a histogram of; sketches of parts can be merged."""
    return F.kll_sketch_agg_double(v, SKETCH)


def merged(sketch: str) -> Column:
    return F.kll_merge_agg_double(sketch, SKETCH)


def histogram_of(sketch: str, rows: str, steps: int = STEPS) -> Column:
    """``steps + 1`` values, about equally many rows between each two; null without rows."""
    # One expression: a thousand literals would be as many calls into the JVM.
    shares = F.expr(f"array({', '.join(f'{k / steps!r}D' for k in range(steps + 1))})")
    return F.when(F.col(rows) > 0, F.kll_sketch_get_quantile_double(F.col(sketch), shares))


def branch() -> Column:
    """A number that the rows of a task share, for the first level of a merge."""
    return F.spark_partition_id() % BRANCHES


def numbers_of(df: DataFrame, c: ColumnOrName) -> DataFrame:
    """The column's finite numbers as one double column ``v``."""
    v = F.col("v")
    values = df.select(column(c).cast("double").alias("v"))
    return values.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))


def start_of(values: DataFrame, steps: int = STEPS) -> Start:
    v = F.col("v")
    parts = values.groupBy(branch().alias("branch")).agg(
        F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), sketch_of(v).alias("sketch")
    )
    whole = parts.agg(F.sum("n").alias("n"), F.min("low"), F.max("high"), merged("sketch").alias("sketch"))
    row = whole.withColumn("histogram", histogram_of("sketch", "n", steps)).drop("sketch").first()
    return (row["n"] or 0, *row[1:])


def order_statistics(
    values: DataFrame,
    ranks: Sequence[int],
    start: Start,
    steps: int = STEPS,
    few_rows: int = FEW_ROWS,
) -> dict[int, float]:
    """The values at the given 0-based ranks of column ``v``.

    ``start`` describes the whole column. ``steps`` rows or less are counted by
    value also where ``few_rows`` is smaller.
    """
    count, low, high, histogram = start
    found: dict[int, float] = {}
    spans = [_Span(low, high, count, 0, tuple(sorted(set(ranks))), tuple(histogram))]
    few_rows = max(few_rows, steps)
    while spans:
        for span in spans:
            if span.low == span.high:
                found.update(dict.fromkeys(span.ranks, span.low))
        spans = [s for s in spans if s.low != s.high]
        blank = [s for s in spans if s.histogram is None and s.rows > few_rows]
        known = [s for s in spans if s not in blank]
        last = [s for s in known if s.rows <= few_rows or s.expected() <= few_rows]
        many = [s for s in known if s not in last]
        spans = [replace(s, histogram=tuple(start_of(values.where(s.holds(F.col("v"))), steps)[3])) for s in blank]
        if last:
            spans += _settle(last, _by_value(values, last, few_rows), found)
        if many:
            spans += _settle(many, _by_cell(values, many, steps), found)
    return found


def _numbered(values: DataFrame, spans: list[_Span]) -> tuple[DataFrame, Column]:
    """The rows in the spans, which never overlap, and the number of each row's span."""
    v = F.col("v")
    kept, number = spans[0].holds(v), F.when(spans[0].holds(v), 0)
    for i, span in enumerate(spans[1:], 1):
        kept, number = kept | span.holds(v), number.when(span.holds(v), i)
    return values.where(kept), number.alias("span")


def _by_span(spans: list[_Span], of_span: Callable[[_Span], Column]) -> Column:
    """An expression that differs by the number of a row's span."""
    cases = F.when(F.col("span") == 0, of_span(spans[0]))
    for i, span in enumerate(spans[1:], 1):
        cases = cases.when(F.col("span") == i, of_span(span))
    return cases


def _by_cell(values: DataFrame, spans: list[_Span], steps: int) -> list[Row]:
    """Every cell of the spans, of which there are as many as cuts, twice, and one.

    Only the cells in which ranks are expected are sketched.
    """
    v = F.col("v")
    rows, number = _numbered(values, spans)
    dealt = rows.select("v", number, branch().alias("branch"))
    dealt = dealt.withColumn("cell", _by_span(spans, lambda s: s.cell(v)))
    sought = F.when(_by_span(spans, lambda s: F.col("cell").isin(s.wanted())), v)
    parts = dealt.groupBy("span", "cell", "branch").agg(
        F.count("*").alias("rows"),
        F.count(sought).alias("sought"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        sketch_of(sought).alias("sketch"),
    )
    cells = parts.groupBy("span", "cell").agg(
        F.sum("rows").alias("rows"),
        F.sum("sought").alias("sought"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        merged("sketch").alias("sketch"),
    )
    cells = cells.withColumn("histogram", histogram_of("sketch", "sought", steps)).drop("sketch", "sought")
    return sorted(cells.collect(), key=lambda r: (r["span"], r["cell"]))


def _by_value(values: DataFrame, spans: list[_Span], few_rows: int) -> list[Row]:
    """What a wanted rank falls on, and how many rows come before that and with it.

    That is a value where ranks are expected and anywhere in a span of few rows, and all of
    the cell elsewhere.
    """
    v = F.col("v")
    rows, number = _numbered(values, spans)
    whole = [s.rows <= few_rows for s in spans]
    place = dict(zip(map(id, spans), whole, strict=True))
    dealt = rows.select("v", number)
    cell = _by_span(spans, lambda s: F.lit(0) if place[id(s)] else s.cell(v))
    dealt = dealt.withColumn("cell", cell)
    own = _by_span(spans, lambda s: F.lit(True) if place[id(s)] else F.col("cell").isin(s.wanted()))
    counted = dealt.groupBy("span", "cell", F.when(own, v).alias("own")).agg(
        F.count("*").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    # About few_rows counted rows per span are ordered here.
    upto = F.sum("rows").over(Window.partitionBy("span").orderBy("cell", "low"))
    hit = F.lit(False)
    for i, span in enumerate(spans):
        for rank in span.ranks:
            local = rank - span.below
            passed = (F.col("upto") - F.col("rows") <= local) & (F.col("upto") > local)
            hit = hit | ((F.col("span") == i) & passed)
    return counted.withColumn("upto", upto).where(hit).collect()


def _settle(spans: list[_Span], cells: list[Row], found: dict[int, float]) -> list[_Span]:
    """Takes over the ranks that are known now; returns the cells that hold the others."""
    rest, upto = [], [0] * len(spans)
    for row in cells:
        span, fields = spans[row["span"]], row.asDict()
        upto[row["span"]] += row["rows"]
        last = span.below + fields.get("upto", upto[row["span"]]) - 1
        first = last - row["rows"] + 1
        low, high = row["low"], row["high"]
        here = [r for r in span.ranks if first <= r <= last]
        known = {first: low, last: high}
        found.update({r: known[r] for r in here if r in known})
        found.update({r: low for r in here if low == high})
        pending = tuple(r for r in here if r not in found)
        if pending:
            histogram = fields.get("histogram")
            histogram = None if histogram is None else tuple(histogram)
            rest.append(_Span(low, high, row["rows"], first, pending, histogram))
    return rest


def quantile_thresholds(
    df: DataFrame,
    c: ColumnOrName,
    classes: int = 6,
    start: Start | None = None,
    steps: int = STEPS,
    few_rows: int = FEW_ROWS,
) -> tuple[float, ...]:
    """The ``classes - 1`` cut points, interpolated linearly between neighbours.

    ``start`` is used when the caller has it already. No values give no
    thresholds.
    """
    values = numbers_of(df, c)
    if start is None:
        start = start_of(values, steps)
    count = start[0]
    if not count:
        return ()
    places = [(count - 1) * (k / classes) for k in range(1, classes)]
    ranks = {r for p in places for r in (math.floor(p), math.ceil(p))}
    at = order_statistics(values, sorted(ranks), start, steps, few_rows)
    cuts = []
    for place in places:
        left, right = at[math.floor(place)], at[math.ceil(place)]
        cuts.append(left + (right - left) * (place - math.floor(place)))
    return tuple(cuts)


def approximate_thresholds(
    df: DataFrame, c: ColumnOrName, classes: int = 6, accuracy: int = 10_000
) -> tuple[float, ...]:
    """Cut points from one pass, each off by some 1/accuracy of the ranks.

    The size of a sketch follows from that; below 1/28,000 it grows no further.
    """
    size = min(65_535, max(8, math.ceil((2.3 * accuracy) ** (1 / 0.9723))))
    parts = numbers_of(df, c).groupBy(branch()).agg(F.count("v").alias("n"), F.kll_sketch_agg_double("v", size).alias("s"))
    whole = parts.agg(F.sum("n").alias("n"), F.kll_merge_agg_double("s", size).alias("s"))
    shares = F.array(*[F.lit(k / classes) for k in range(1, classes)])
    cuts = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(F.col("s"), shares))
    return tuple(whole.select(cuts).first()[0] or ())
