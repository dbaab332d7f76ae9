"""Delimited files and stored station tables."""

from isoloir.sources.delimited import clean_copy, read_delimited
from isoloir.sources.splits import splits_of, with_splits
from isoloir.sources.tables import read_layer, read_scales, read_stations, read_stations_jdbc

__all__ = [
    "clean_copy",
    "read_delimited",
    "read_layer",
    "read_scales",
    "read_stations",
    "read_stations_jdbc",
    "splits_of",
    "with_splits",
]
