"""Delimited text sources: every value arrives as text, types come later."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoloir.functions.columns import col
from isoloir.functions.text import null_tokens
from isoloir.operators.cleaning import drop_incomplete
from isoloir.operators.losses import Losses
from isoloir.schema import SourceSpec
from isoloir.sources.headers import (
    bytes_of,
    check_names,
    files_by_encoding,
    files_by_header,
    files_of,
)
from isoloir.sources.records import read_records

_RAGGED = "__ragged"


def read_delimited(
    spark: SparkSession, path: str, spec: SourceSpec, losses: Losses | None = None, name: str = "rows"
) -> DataFrame:
    """The spec's columns as text, found by header name, null tokens as null.

    The files of a folder may have their columns in different orders: each file's header is
    read, and files that share one are read together. With ``spec.otherwise`` they may also
    be in two encodings. A missing column fails when the plan is made. Fields beyond the
    header are ignored (``PERMISSIVE``), doubled quotes inside a quoted field are one quote,
    and ``.gz`` files are unpacked while reading. A compressed file is one task;
    ``spec.partitions`` spreads its rows when later work is heavy.

    With ``losses``, rows are counted as ``<name>_read``, and those that have more or fewer
    fields than the header as ``<name>_ragged``, unless records are cut by many tasks.
    """
    files = files_of(spark, path)
    if spec.otherwise is None:
        parts = [_read_alike(spark, path, files, spec, losses)]
    else:
        parts = [
            _read_alike(spark, some, some, replace(spec, encoding=encoding), losses)
            for encoding, some in files_by_encoding(spark, path, files, spec.otherwise).items()
        ]
    rows = reduce(DataFrame.unionByName, parts)
    if losses is not None:
        ragged = {}
        if _RAGGED in rows.columns:
            # A scan must be asked for a column of its own besides, whatever is used of it.
            ragged = {f"{name}_ragged": F.count(col(_RAGGED)), "_": F.max(col(rows.columns[0]))}
        rows = losses.watch(rows, **{f"{name}_read": F.count("*")}, **ragged).drop(_RAGGED)
    names = rows.columns if spec.columns is None else spec.columns
    rows = rows.select(*[null_tokens(col(n), spec.na_tokens).alias(n) for n in names])
    return rows if spec.partitions is None else rows.repartition(spec.partitions)


def _read_alike(
    spark: SparkSession, path: str | list[str], files: list[str], spec: SourceSpec, losses: Losses | None
) -> DataFrame:
    """Files of one encoding, each by its own header."""
    if spec.multiline and bytes_of(spark, files) > spec.split_above:
        return read_records(spark, path, spec)
    if losses is None and (spec.columns is None or len(files) < 2):
        return _read(spark, path, spec)
    headers = files_by_header(spark, files, spec.separator, spec.encoding, spec.line_sep)
    check_names(headers, spec.columns or ())
    # Files of one header are one scan, of the folder itself if they all are.
    groups = [path] if len(headers) < 2 else list(headers.values())
    picked = spec.columns or next(iter(headers), ())
    if losses is not None:
        parts = [_read(spark, g, spec, names) for g, names in zip(groups, headers, strict=False)]
        picked = (*picked, _RAGGED)
    else:
        parts = [_read(spark, g, spec) for g in groups]
    return reduce(DataFrame.unionByName, [part.select(*[col(n) for n in picked]) for part in parts])


def _read(
    spark: SparkSession, path: str | list[str], spec: SourceSpec, watched: Sequence[str] | None = None
) -> DataFrame:
    """Files of one header, by Spark's reader.

    ``watched`` are the header's names if rows with another number of fields are to be told,
    which takes every column of a row.
    """
    reader = spark.read.options(
        header=True,
        sep=spec.separator,
        encoding=spec.encoding,
        mode="PERMISSIVE",
        escape='"',
        multiLine=spec.multiline,
        inferSchema=False,
        # Should a file have wanted columns elsewhere all the same, it fails instead of being
        # misread.
        enforceSchema=spec.columns is None,
    )
    if spec.line_sep is not None:
        reader = reader.option("lineSep", spec.line_sep)
    if watched is not None:
        fields = [T.StructField(n, T.StringType()) for n in (*watched, _RAGGED)]
        options = {"columnNameOfCorruptRecord": _RAGGED, "columnPruning": False}
        reader = reader.schema(T.StructType(fields)).options(**options)
    return reader.csv(path)


def clean_copy(spark: SparkSession, source: str, spec: SourceSpec, target: str) -> None:
    """Copy a delimited source without its incomplete rows, as comma CSV."""
    rows = drop_incomplete(read_delimited(spark, source, spec))
    rows.write.mode("overwrite").options(header=True, escape='"').csv(target)
