"""Records of delimited files whose quoted fields hold line breaks, read by many tasks.

Spark's own reader takes such a file in one task, since no byte range can tell by itself
whether it begins inside a quoted field. Here the lines are read by ranges, as those of any
text file. What a range has to know is only whether the quotes before it are odd in number:
quotes are counted for each run of ``RUN`` lines, and the counts are summed up over the runs
before it, first within a range, then over the ranges of a file. After that

* a run that begins outside quotes and has no line with an odd number of quotes is a record a
  line, which is nearly all of a file, and nothing of it is shuffled;
* in the other runs, a line begins a record if the quotes before it are even in number, and
  what follows up to the next such line is joined to it. A record may go on through any number
  of runs and ranges.

Quotes may stand in quoted fields only, doubled inside them, as the format has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isoloir.functions.columns import col
from isoloir.schema import SourceSpec
from isoloir.session import stored
from isoloir.sources.headers import check_names, files_of, header_fields

#: Lines of a run, as a power of two.
RUN = 12
#: Lines of a record at most: more mean a quote that is never closed.
LONGEST = 10_000
#: Different headers that the files of one source have at most.
HEADERS = 1_000

_PLACE = ("file", "block", "line")
_RUN = ("file", "block", "run")


def lines_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file``, ``block`` (where its byte range begins), ``line``, ``odd`` and ``value``.

    ``line`` ascends within a range; ``odd`` is whether the line has an odd number of quotes.
    They are stored, so that whatever is asked of them has the same numbers.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    numbered = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        (quotes % 2).cast("int").alias("odd"),
        "value",
    )
    return stored(numbered, "lines")


def _odd(total: Column) -> Column:
    return F.coalesce(total, F.lit(0)) % 2


def _before(keys: tuple[str, ...], *order: str):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def open_runs(lines: DataFrame) -> DataFrame:
    """The runs that a record may cross: ``file``, ``block``, ``run`` and ``open``.

    ``open`` is 1 where the run begins inside a quoted field.
    """
    runs = lines.groupBy("file", "block", F.shiftright("line", RUN).alias("run"))
    runs = stored(runs.agg((F.sum("odd") % 2).alias("odd"), F.max("odd").alias("some")), "runs")
    # A row for each byte range of a file, then one for each run of a range.
    ranges = runs.groupBy("file", "block").agg(F.sum("odd").alias("odd"))
    ranges = ranges.select("file", "block", _odd(F.sum("odd").over(_before(("file",), "block"))).alias("outer"))
    inner = _odd(F.sum("odd").over(_before(("file", "block"), "run"))).alias("inner")
    known = runs.select(*_RUN, "some", inner).join(ranges, ["file", "block"])
    opened = known.select(*_RUN, "some", ((F.col("inner") + F.col("outer")) % 2).cast("int").alias("open"))
    return stored(opened.where("some = 1 OR open = 1").drop("some"), "open_runs")


def records_of(lines: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``file``, ``block``, ``line`` and ``value`` of every record, at its first line's place.

    Line breaks within a record are kept. A record of more than ``longest`` lines raises.
    """
    runs = open_runs(lines)
    marked = lines.withColumn("run", F.shiftright("line", RUN)).join(runs, list(_RUN), "left")
    plain = marked.where("open IS NULL").select(*_PLACE, "value")

    here = Window.partitionBy(*_RUN).orderBy("line")
    inside = _odd(F.col("open") + F.coalesce(F.sum("odd").over(_before(_RUN, "line")), F.lit(0)))
    place = F.struct("block", "line")
    broken = marked.where("open IS NOT NULL").withColumn("inside", inside.cast("int"))
    began = F.last(F.when(F.col("inside") == 0, place), ignorenulls=True).over(here)
    broken = stored(broken.withColumn("began", began), "broken")
    alone = broken.where("inside = 0 AND odd = 0").select(*_PLACE, "value")

    # What a run goes on with began in a run before it.
    ends = broken.groupBy(*_RUN).agg(F.max("began").alias("began"))
    carried = F.last("began", ignorenulls=True).over(_before(("file",), "block", "run"))
    carried = stored(ends.select(*_RUN, carried.alias("carried")), "carried")
    several = broken.where("inside = 1 OR odd = 1").join(carried, list(_RUN))
    several = several.withColumn("first", F.coalesce("began", "carried"))
    most = several.groupBy("file", "first").count().agg(F.max("count")).first()[0] or 0
    if most > longest:
        raise ValueError(f"a record has {most} lines, {longest} are allowed: is a quote never closed?")
    pieces = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    joined = several.groupBy("file", "first").agg(pieces.alias("pieces")).select(
        "file",
        F.col("first.block").alias("block"),
        F.col("first.line").alias("line"),
        F.array_join(F.transform("pieces", lambda p: p["value"]), "\n").alias("value"),
    )
    return plain.unionByName(alone).unionByName(joined)


def read_records(spark: SparkSession, path: str | list[str], spec: SourceSpec, longest: int = LONGEST) -> DataFrame:
    """The columns of a source whose records may hold line breaks, as text, untouched.

    Every file has a header, and columns are found by its names, wherever they stand. Blank
    lines between records are skipped; fields beyond the header are ignored, missing ones null.
    """
    records = records_of(lines_of(spark, path), longest)
    value = F.col("value")
    if spec.encoding.upper().replace("-", "") != "UTF8":
        value = F.decode(value.cast("binary"), spec.encoding)
    # A record's own line end, not one in a field.
    records = records.withColumn("value", F.regexp_replace(value, "\r$", "")).where("value <> ''")
    records = stored(records, "records")
    first = F.min_by(F.struct("block", "line", "value"), F.struct("block", "line"))
    heads = records.groupBy("file").agg(first.alias("head")).select("file", "head.*")
    heads = stored(heads.withColumnRenamed("value", "header"), "heads")
    different = [r.header for r in heads.select("header").distinct().limit(HEADERS + 1).collect()]
    if len(different) > HEADERS:
        raise ValueError(f"the files have more than {HEADERS} different headers")
    if not different:
        files = files_of(spark, path) if isinstance(path, str) else path
        raise ValueError(f"no header in {files[:1]}")
    lead = F.struct("file", "block", "line")
    rows = records.join(heads.select("file", F.struct("file", "block", "line").alias("head"), "header"), "file")
    rows = rows.where(lead != F.col("head")).select("header", "value")
    parts = []
    for header in sorted(different):
        names = header_fields(header.removeprefix("﻿"), spec.separator)
        if spec.columns is not None:
            check_names({names: [f"a file with header {header!r}"]}, spec.columns)
        fields = ", ".join(f"c{k} string" for k in range(len(names)))
        options = {"sep": spec.separator, "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
        parsed = F.from_csv("value", fields, options).alias("r")
        wanted = names if spec.columns is None else spec.columns
        picked = [F.col(f"r.c{names.index(n)}").alias(n) for n in wanted]
        parts.append(rows.where(F.col("header") == header).select(parsed).select(*picked))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*[col(n) for n in out.columns])
