"""Column functions: plain Catalyst expressions, no Python runs per row."""

from isoloir.functions.columns import col, column
from isoloir.functions.keys import geo_key, results_key
from isoloir.functions.scales import class_colour, linear_size, quantile_class
from isoloir.functions.text import (
    decimal_comma,
    default_null,
    drop_first_char,
    int_text,
    joined_text,
    label_with_code,
    last_chars,
    latitude_of,
    longitude_of,
    null_tokens,
    pad_once,
    strict_cast,
)

__all__ = [
    "class_colour",
    "col",
    "column",
    "decimal_comma",
    "default_null",
    "drop_first_char",
    "geo_key",
    "int_text",
    "joined_text",
    "label_with_code",
    "last_chars",
    "latitude_of",
    "linear_size",
    "longitude_of",
    "null_tokens",
    "pad_once",
    "quantile_class",
    "results_key",
    "strict_cast",
]
