"""Writers of the station table and of layers."""

from isoloir.sinks.tables import (
    ensure_database,
    replace_stations,
    replace_table,
    save_layer,
    write_stations_jdbc,
)

__all__ = [
    "ensure_database",
    "replace_stations",
    "replace_table",
    "save_layer",
    "write_stations_jdbc",
]
