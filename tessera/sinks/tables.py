"""Sinks and materialisation (SNK-1..13) on plain Parquet directories.

Versioned outputs (materialized views, full refreshes) are written to a new
``v=<n>`` directory and only then published by a small pointer file, so a
reader never sees a half-written version and a failed refresh leaves the
previous one in place.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.session import fs_exists, fs_list, fs_read_text, fs_tree_size, fs_write_text

CURRENT = "_CURRENT"


# ------------------------------------------------------------------ streams
def start_stream(
    df: DataFrame,
    path: str | None,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    mode: str = "append",
    trigger: str = "availableNow",
    interval: str | None = None,
    name: str | None = None,
    table: str | None = None,
    partition_by: Sequence[str] = (),
    options: dict | None = None,
) -> StreamingQuery:
    """The streaming writer surface (SNK-8): output mode, trigger, name, sink.

    ``trigger``: ``availableNow`` (drain the backlog and stop; also what the
    deprecated ``once`` maps to) or ``processingTime`` with ``interval``.
    Sinks: parquet / json / csv / orc paths, a catalog ``table``, or console.
    """
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, str(v))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    if trigger in ("availableNow", "once"):
        w = w.trigger(availableNow=True)
    elif trigger == "processingTime":
        w = w.trigger(processingTime=interval or "10 seconds")
    else:
        raise ValueError(f"unsupported trigger {trigger}")
    if table:
        return w.toTable(table)
    return w.start(path) if path else w.start()


def append_table(
    stream_df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    trigger: str = "availableNow",
) -> StreamingQuery:
    """Streaming append into a Parquet table with checkpointed progress (SNK-1)."""
    return start_stream(stream_df, path, checkpoint, partition_by=partition_by, trigger=trigger)


def run_to_completion(q: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to drain; re-raise its failure."""
    q.awaitTermination(timeout_s)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def foreach_batch(
    stream_df: DataFrame,
    fn: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str = "availableNow",
    mode: str = "append",
) -> StreamingQuery:
    """Custom per-batch sink (SNK-9); ``fn`` must be idempotent per batch id."""
    w = stream_df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    w = w.trigger(availableNow=True) if trigger in ("availableNow", "once") else w.trigger(processingTime=trigger)
    return w.start()


def foreach_row(stream_df: DataFrame, writer, checkpoint: str, trigger: str = "availableNow") -> StreamingQuery:
    """Per-row sink (SNK-9): ``writer`` is a function of a row, or an object with
    ``open(partition_id, epoch_id) -> bool``, ``process(row)`` and ``close(error)``.

    It runs on the executors, one task per partition; use it for side effects
    (notifications, external calls), not for bulk writes — those belong in a
    file sink or ``foreach_batch``.
    """
    w = stream_df.writeStream.option("checkpointLocation", checkpoint).foreach(writer)
    w = w.trigger(availableNow=True) if trigger in ("availableNow", "once") else w.trigger(processingTime=trigger)
    return w.start()


# ------------------------------------------------------------------ batch
# Target file sizes of the layers (fixed values of the reference's tables).
TARGET_FILE_BYTES = {"raw": 1 << 30, "silver": 1 << 30, "curated": 1 << 30, "gold": 256 << 20}
# Shuffled bytes that one task sorts for a clustered file; in memory the rows take about four times as many.
SORT_BYTES = 128 << 20


def _common_prefix(a: str, b: str) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def curve_key(df: DataFrame, cols: Sequence[str], bits: int = 5) -> Column:
    """Place of a row on a space-filling (Z-order) curve through the ranks of ``cols``.

    Each column is cut into ``2 ** bits`` ranges of about equally many rows, and the
    bits of the ranges' numbers are dealt in turn, so neighbours on the curve are
    near in every column.  The cuts come from quantile sketches of all rows, of
    bounded size and merged on the map side, so a frequent value gathers nowhere.
    Text is ranked by the seven bytes behind the prefix that all of it shares; null
    counts as the smallest value.  ``df`` is read once more (twice with text columns).
    """
    text = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    ends = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(text) for n, f in (("lo", F.min), ("hi", F.max))]).first() if text else None

    def image(c: str) -> Column:
        if c in text:
            i = text.index(c)
            skip = _common_prefix(ends[f"lo{i}"] or "", ends[f"hi{i}"] or "")
            tail = F.hex(F.encode(F.substring(c, skip + 1, 7), "UTF-8"))
            return F.conv(F.rpad(F.substring(tail, 1, 14), 14, "0"), 16, 10).cast("long")
        kind = df.schema[c].dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return F.unix_micros(F.col(c).cast("timestamp"))
        return F.unix_date(c) if isinstance(kind, T.DateType) else F.col(c).cast("double")

    images = {c: image(c) for c in cols}

    def dealt(number: int, i: int) -> int:
        """The bits of column ``i``'s range number at their places on the curve."""
        return sum(((number >> bit) & 1) << (bit * len(cols) + (len(cols) - 1 - i)) for bit in range(bits))

    at = [k / 2**bits for k in range(1, 2**bits)]
    cuts = df.agg(*[F.percentile_approx(images[c], at, 10_000).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    key = F.lit(0).cast("long")
    for i, c in enumerate(cols):
        bounds = sorted(set(cuts[f"c{i}"] or []))
        # each bound that the value has reached adds its step; no lambda, so the steps are compiled
        for n, bound in enumerate(bounds, 1):
            key = key + F.when(images[c] >= F.lit(bound), F.lit(dealt(n, i) - dealt(n - 1, i)).cast("long")).otherwise(F.lit(0).cast("long"))
    return key


def clustered_write(
    df: DataFrame,
    cols: Sequence[str],
    path: str,
    mode: str = "overwrite",
    max_records_per_file: int | None = None,
    target_file_bytes: int | None = TARGET_FILE_BYTES["silver"],
    curve: bool = False,
) -> None:
    """Clustered layout (SNK-5): range-partition and sort by ``cols`` so each
    file covers a narrow key range and Parquet min/max statistics skip files
    and row groups for filters on those columns.  The session's shuffle
    partitions give the ranges; AQE joins neighbours by the bytes it measured
    up to ``target_file_bytes`` (one file per range), but no further than
    ``SORT_BYTES``: a range is sorted in one task's memory.

    In the order of ``cols`` only filters on the first column skip much; with
    ``curve`` the files follow :func:`curve_key` and those on each column do."""
    order = [F.col(c) for c in cols]
    out = df
    if curve and len(cols) > 1:
        out = df.withColumn("__curve", curve_key(df, cols))
        order = [F.col("__curve"), *order]
    out = out.repartitionByRange(*order).sortWithinPartitions(*order).select(*df.columns)
    w = out.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    with advisory_size(df.sparkSession, min(target_file_bytes, SORT_BYTES) if target_file_bytes else None):
        w.parquet(path)


@contextmanager
def advisory_size(spark: SparkSession, size: int | None):
    """Within the block, AQE makes shuffle partitions of ``size`` bytes (None: the session's settings)."""
    wanted = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(int(size)),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    } if size else {}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "overwrite") -> None:
    """Partitioned write (SNK-4); filters on the partition columns prune directories."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a partitioned table with its written schema, so partition values keep
    their type (inference would turn a boolean partition into a string)."""
    return spark.read.schema(schema).parquet(path)


def write_table(
    df: DataFrame,
    name: str,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Batch write to an external-path catalog table (SNK-6)."""
    w = df.write.mode(mode).format(fmt).option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def create_table_sql(spark: SparkSession, name: str, ddl_columns: str, location: str, fmt: str = "parquet") -> None:
    """``CREATE TABLE ... USING <fmt> LOCATION`` (SNK-7); rows then go in with INSERT."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl_columns}) USING {fmt} LOCATION '{location}'")


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows that may carry new columns (SNK-10, mergeSchema).

    Parquet files of one directory may differ in columns; reading with
    ``mergeSchema`` unions them by name, missing columns as NULL.
    """
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def replace_schema(df: DataFrame, path: str) -> None:
    """Overwrite rows and schema together (``overwriteSchema``)."""
    df.write.mode("overwrite").parquet(path)


def write_once(df: DataFrame, path: str, app_id: str, version: int, partition_by: Sequence[str] = ()) -> None:
    """Idempotent write keyed by (app id, version) (SNK-11).

    Each (app, version) owns one partition directory; a repeated write of the
    same pair replaces that partition only (dynamic partition overwrite), so
    writing twice equals writing once.
    """
    out = df.withColumn("txn_app", F.lit(app_id)).withColumn("txn_version", F.lit(int(version)))
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("txn_app", "txn_version", *partition_by)
        .parquet(path)
    )


def compact(
    spark: SparkSession, path: str, target_bytes: int = 1 << 30, out_path: str | None = None, partition_by: Sequence[str] = ()
) -> str:
    """Rewrite a directory of small files into files of about ``target_bytes`` (SNK-12).

    The listed size of the whole tree says how many tasks write.  A partitioned
    table keeps its layout: name its columns in ``partition_by``; its rows are
    rebalanced by them, and AQE splits a large partition over several tasks.
    The rewrite goes to a new directory which is then returned (readers switch
    over; the old files can be removed once nobody reads them).
    """
    n = max(1, -(-fs_tree_size(spark, path) // int(target_bytes)))
    dest = out_path or f"{path.rstrip('/')}__compacted_{int(time.time() * 1000)}"
    rows = spark.read.parquet(path)
    if partition_by:
        with advisory_size(spark, target_bytes):
            rows.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(dest)
    else:
        rows.repartition(n).write.mode("overwrite").parquet(dest)
    return dest


# ------------------------------------------------------------------ versions
def _versions(spark: SparkSession, path: str) -> list[int]:
    out = []
    for name, is_dir, _, _ in fs_list(spark, path):
        if is_dir and name.startswith("v="):
            if fs_exists(spark, f"{path}/{name}/_SUCCESS"):
                out.append(int(name[2:]))
    return sorted(out)


def current_version(spark: SparkSession, path: str) -> int | None:
    text = fs_read_text(spark, f"{path}/{CURRENT}")
    if text:
        return int(text.strip())
    vs = _versions(spark, path)
    return vs[-1] if vs else None


def publish_version(spark: SparkSession, df: DataFrame, path: str, cluster_by: Sequence[str] = ()) -> int:
    """Write ``df`` as the next version directory, then point readers at it.

    With ``cluster_by`` the version is written once as it comes and then laid
    out along the columns' curve, from what was written."""
    cur = current_version(spark, path)
    nxt = 0 if cur is None else cur + 1
    if cluster_by:
        df.write.mode("overwrite").parquet(f"{path}/_plain")
        plain = spark.read.schema(df.schema).parquet(f"{path}/_plain")
        clustered_write(plain, cluster_by, f"{path}/v={nxt}", target_file_bytes=TARGET_FILE_BYTES["gold"], curve=True)
    else:
        df.write.mode("overwrite").parquet(f"{path}/v={nxt}")
    fs_write_text(spark, f"{path}/{CURRENT}", str(nxt))
    return nxt


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    v = current_version(spark, path) if version is None else version
    if v is None:
        raise FileNotFoundError(f"no published version under {path}")
    return spark.read.parquet(f"{path}/v={v}")


def refresh_view(spark: SparkSession, fn: Callable[[], DataFrame], path: str, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Materialized view (SNK-2): recompute from the source and replace on refresh."""
    publish_version(spark, fn(), path, cluster_by)
    return read_version(spark, path)


def full_refresh(
    spark: SparkSession,
    build_stream: Callable[[], DataFrame],
    path: str,
    checkpoint_root: str,
) -> DataFrame:
    """Rebuild a streaming table from its whole source (SNK-13).

    A new version directory and a fresh checkpoint: the stream re-reads all
    input, and readers switch only when it has finished.
    """
    cur = current_version(spark, path)
    nxt = 0 if cur is None else cur + 1
    q = append_table(build_stream(), f"{path}/v={nxt}", f"{checkpoint_root}/v={nxt}")
    run_to_completion(q)
    fs_write_text(spark, f"{path}/{CURRENT}", str(nxt))
    return read_version(spark, path)
