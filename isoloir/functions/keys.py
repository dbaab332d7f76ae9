"""The join key of a polling station, built from either side's columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isoloir.functions.columns import ColumnOrName, column
from isoloir.functions.text import last_chars, pad_once


def results_key(
    department: ColumnOrName, constituency: ColumnOrName, station: ColumnOrName
) -> Column:
    """``75-01_0101`` from the official results' three codes."""
    return F.concat(
        column(department).cast("string"),
        F.lit("-"),
        pad_once(column(constituency).cast("string"), 2),
        F.lit("_"),
        pad_once(column(station).cast("string"), 4),
    )


def geo_key(constituency: ColumnOrName, postal: ColumnOrName, code: ColumnOrName) -> Column:
    """``75-01_0101`` from the geo table's constituency, postal and station codes."""
    return F.concat(column(constituency), F.lit("_"), last_chars(postal, 2), last_chars(code, 2))
