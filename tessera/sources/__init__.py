"""File sources: scans, streams, rescue, inference and evolution."""

from tessera.sources.files import csv_stream, file_scan, file_stream, read_current, stream_table
from tessera.sources.rescue import (
    infer_schema,
    read_csv_evolving,
    read_csv_rescued,
    rescue_csv_stream,
    with_rescued_json,
)

__all__ = [
    "csv_stream", "file_scan", "file_stream", "read_current", "stream_table",
    "infer_schema", "read_csv_evolving", "read_csv_rescued", "rescue_csv_stream", "with_rescued_json",
]
