"""Column references that are safe for names with dots and spaces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(name: str) -> Column:
    """The column called exactly ``name``, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def column(c: ColumnOrName) -> Column:
    return col(c) if isinstance(c, str) else c
