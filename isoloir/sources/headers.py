"""What files look like before they are read: where they are, how large, their headers."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Headers that are read at the same time.
READERS = 16


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The files that Spark would read below ``path``, listed once."""
    jvm = spark._jvm
    found = spark.read.format("text").load(path).inputFiles()
    # Spark lists files as encoded addresses, but takes plain paths.
    return sorted(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString() for f in found)


def _hadoop_path(spark: SparkSession, file: str):
    return spark._jvm.org.apache.hadoop.fs.Path(file)


def bytes_of(spark: SparkSession, files: Sequence[str]) -> int:
    """Bytes of the files as they are stored, packed or not."""
    conf, total = spark._jsc.hadoopConfiguration(), 0
    for file in files:
        path = _hadoop_path(spark, file)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


def first_line(spark: SparkSession, file: str, encoding: str = "UTF-8") -> str:
    """The first line of a file on any file system Spark can read, unpacked if need be."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = _hadoop_path(spark, file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        raw = stream if codec is None else codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(raw, encoding))
        return (reader.readLine() or "").removeprefix("﻿")
    finally:
        stream.close()


def header_fields(line: str, separator: str, line_sep: str | None = None) -> tuple[str, ...]:
    """The names of a header, of which a quoted one may hold separators and doubled quotes."""
    line = line.split(line_sep)[0] if line_sep else line
    return tuple(next(csv.reader([line.rstrip("\r\n")], delimiter=separator, doublequote=True), ()))


def files_by_header(
    spark: SparkSession, files: Sequence[str], separator: str, encoding: str = "UTF-8", line_sep: str | None = None
) -> dict[tuple[str, ...], list[str]]:
    """The files that share a header, for each header: one line of each file is read.

    Files without a line are left out: they have no rows either.
    """
    with ThreadPoolExecutor(READERS) as pool:
        lines = list(pool.map(lambda f: first_line(spark, f, encoding), files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        if line:
            found.setdefault(header_fields(line, separator, line_sep), []).append(file)
    return found


def files_by_encoding(
    spark: SparkSession, path: str | list[str], files: Sequence[str], otherwise: str
) -> dict[str, list[str]]:
    """The files that are valid UTF-8, and those that are not under the encoding ``otherwise``.

    One scan tests the bytes of every line where they are; one value for each file comes back.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    valid = F.bool_and(F.is_valid_utf8("value")).alias("valid")
    tested = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(valid).where("NOT valid").collect()
    jvm = spark._jvm
    others = {jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r.file)).toString() for r in tested}
    dealt = {"UTF-8": [f for f in files if f not in others], otherwise: [f for f in files if f in others]}
    return {encoding: some for encoding, some in dealt.items() if some}


def check_names(headers: dict[tuple[str, ...], list[str]], wanted: Sequence[str]) -> None:
    """Every header must have every wanted name, and must have it once."""
    for names, files in headers.items():
        for name in wanted:
            if names.count(name) != 1:
                found = "no column" if name not in names else "several columns"
                raise ValueError(f"{files[0]} has {found} called {name!r}; its header is {list(names)}")
