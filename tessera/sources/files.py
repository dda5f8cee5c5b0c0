"""File sources, batch and streaming (SRC-1..7, SRC-11..13, SRC-17).

One option vocabulary for both forms.  Where Spark's streaming file source
refuses an option (``modifiedAfter``/``modifiedBefore``), the same bound is
applied as a filter on ``_metadata.file_modification_time`` — the file
listing still happens, but rows of out-of-window files never leave the scan.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FORMATS = ("csv", "json", "parquet", "orc", "text", "binaryFile", "avro")
MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")

# Fixed value of the reference: "reprocess last 0 days" means this lower bound.
DEFAULT_REPROCESS_FROM = "2024-01-01T00:00:00"

# CSV dialect keywords and the Spark option each one maps to.
_DIALECT = {
    "header": "header",
    "delimiter": "sep",
    "sep": "sep",
    "quote": "quote",
    "escape": "escape",
    "encoding": "encoding",
    "multiline": "multiLine",
    "multiLine": "multiLine",
    "date_format": "dateFormat",
    "dateFormat": "dateFormat",
    "timestamp_format": "timestampFormat",
    "timestampFormat": "timestampFormat",
    "null_value": "nullValue",
    "nullValue": "nullValue",
}


def parse_bytes(size: str | int) -> int:
    """``10g`` / ``512m`` / ``1k`` / plain integer -> bytes (Spark wants a plain integer)."""
    if isinstance(size, int):
        return size
    m = re.fullmatch(r"\s*(\d+)\s*([kmgt]?)b?\s*", str(size).lower())
    if not m:
        raise ValueError(f"bad byte size: {size!r}")
    return int(m.group(1)) * 1024 ** " kmgt".index(m.group(2) or " ")


def reprocess_lower_bound(days: int, now: dt.datetime | None = None) -> str:
    """Lower modification-time bound for "reprocess the last N days" (0 → fixed date)."""
    if int(days) > 0:
        start = (now or dt.datetime.now()) - dt.timedelta(days=int(days))
        return start.strftime("%Y-%m-%dT00:00:00")
    return DEFAULT_REPROCESS_FROM


def _options(
    fmt: str,
    glob: str | None,
    recursive: bool,
    mode: str | None,
    corrupt_col: str | None,
    dialect: Mapping[str, object],
) -> dict[str, str]:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt}")
    opts: dict[str, str] = {}
    if glob:
        opts["pathGlobFilter"] = glob
    if recursive:
        opts["recursiveFileLookup"] = "true"
    if mode:
        if mode.upper() not in MODES:
            raise ValueError(f"unknown mode {mode}")
        opts["mode"] = mode.upper()
    if corrupt_col:
        opts["columnNameOfCorruptRecord"] = corrupt_col
    if fmt == "csv" and (mode or corrupt_col):
        # Which rows are malformed must not depend on the projected columns.
        opts["columnPruning"] = "false"
    for k, v in dialect.items():
        key = _DIALECT.get(k, k)
        opts[key] = str(v).lower() if isinstance(v, bool) else str(v)
    return opts


def file_scan(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    schema: StructType | str | None = None,
    *,
    glob: str | None = None,
    recursive: bool = False,
    modified_after: str | None = None,
    modified_before: str | None = None,
    mode: str | None = None,
    corrupt_col: str | None = None,
    **dialect,
) -> DataFrame:
    """Batch read of files in any supported format with the shared option set."""
    opts = _options(fmt, glob, recursive, mode, corrupt_col, dialect)
    if modified_after:
        opts["modifiedAfter"] = modified_after
    if modified_before:
        opts["modifiedBefore"] = modified_before
    reader = spark.read.format(fmt).options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: StructType | str | None = None,
    *,
    glob: str | None = None,
    recursive: bool = False,
    include_existing: bool = True,
    start_time: dt.datetime | None = None,
    state_dir: str | None = None,
    modified_after: str | None = None,
    modified_before: str | None = None,
    reprocess_days: int | None = None,
    max_files: int | None = None,
    max_bytes: str | int | None = None,
    mode: str | None = None,
    corrupt_col: str | None = None,
    **dialect,
) -> DataFrame:
    """Incremental file stream on Spark's built-in file source.

    * ``include_existing=False`` keeps only files modified at/after
      ``start_time`` (default: the first start) — "new files only".  With
      ``state_dir`` (e.g. next to the checkpoint) the first start time is
      kept, so a restarted stream still takes files added in between.
    * ``modified_after`` / ``modified_before`` / ``reprocess_days`` bound the
      file modification time (as a metadata filter; the stream source refuses
      the batch options).
    * ``max_files`` **or** ``max_bytes`` (e.g. ``"10g"``) caps a micro-batch;
      Spark accepts only one of them.
    """
    if schema is None and fmt not in ("text", "binaryFile"):
        raise ValueError("a file stream needs a declared schema")
    if max_files is not None and max_bytes is not None:
        raise ValueError("set max_files or max_bytes, not both")
    opts = _options(fmt, glob, recursive, mode, corrupt_col, dialect)
    if max_files is not None:
        opts["maxFilesPerTrigger"] = str(int(max_files))
    if max_bytes is not None:
        opts["maxBytesPerTrigger"] = str(parse_bytes(max_bytes))
    reader = spark.readStream.format(fmt).options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)

    lower = modified_after
    if reprocess_days is not None:
        lower = reprocess_lower_bound(reprocess_days)
    if not include_existing:
        start = _first_start(spark, state_dir, start_time)
        lower = max(lower.replace("T", " "), start) if lower else start
    return modification_window(df, lower, modified_before)


def _first_start(spark: SparkSession, state_dir: str | None, start_time: dt.datetime | None) -> str:
    from tessera.session import fs_read_text, fs_write_text

    if state_dir:
        kept = fs_read_text(spark, f"{state_dir}/start_time")
        if kept:
            return kept.strip()
    if start_time is not None:
        start = start_time.isoformat(sep=" ")
    else:
        # "now" as wall-clock time of the session time zone, the zone in which
        # the bound is parsed again (as Spark's own modifiedAfter does).
        start = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    if state_dir:
        fs_write_text(spark, f"{state_dir}/start_time", start)
    return start


def modification_window(df: DataFrame, after: str | None = None, before: str | None = None) -> DataFrame:
    """Keep rows of files whose modification time is in [after, before)."""
    if not after and not before:
        return df
    cols = df.columns
    mt = F.col("_metadata.file_modification_time")
    cond = F.lit(True)
    if after:
        cond = cond & (mt >= F.to_timestamp(F.lit(after.replace("T", " "))))
    if before:
        cond = cond & (mt < F.to_timestamp(F.lit(before.replace("T", " "))))
    return df.filter(cond).select(*cols)


def csv_stream(spark: SparkSession, path: str, schema: StructType, **opts) -> DataFrame:
    """CSV file stream with a header and a declared schema (SRC-1)."""
    opts.setdefault("header", True)
    return file_stream(spark, path, "csv", schema, **opts)


def read_current(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """Batch scan of a stored table: catalog name or path (SRC-13)."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.read.table(name_or_path)


def stream_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **opts) -> DataFrame:
    """Stream scan of a stored table directory (append-only; SRC-14)."""
    return spark.readStream.format(fmt).schema(schema).options(**{k: str(v) for k, v in opts.items()}).load(path)
