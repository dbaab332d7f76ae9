"""The byte ranges that the tasks of a scan read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_splits(df: DataFrame) -> DataFrame:
    """A scan's rows with the file and the byte range that each came from."""
    return df.select(
        "*",
        F.input_file_name().alias("split_file"),
        F.input_file_block_start().alias("split_start"),
        F.input_file_block_length().alias("split_length"),
    )


def splits_of(df: DataFrame) -> DataFrame:
    """One row for each byte range that gave rows: file, start, length, and how many.

    Ask it of a scan itself: behind a shuffle a row no longer has a range.
    """
    return with_splits(df).groupBy("split_file", "split_start", "split_length").agg(F.count("*").alias("rows"))
