"""Sinks and materialisation on Parquet directories."""

from tessera.sinks.tables import (
    append_table,
    clustered_write,
    compact,
    foreach_batch,
    foreach_row,
    full_refresh,
    refresh_view,
    start_stream,
    write_once,
    write_partitioned,
    write_table,
)

__all__ = [
    "append_table", "clustered_write", "compact", "foreach_batch", "foreach_row", "full_refresh",
    "refresh_view", "start_stream", "write_once", "write_partitioned", "write_table",
]
