"""Stage derived copies of the driver tables as files for source/sink/stream queries.

Everything is written under the shared scratch folder (``spark.checkpoint.dir``),
each run in a fresh directory.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans import fixtures as X
from tessera.session import fs_list, fs_set_mtime

STAFF_CSV_SCHEMA = T.StructType([T.StructField("row_id", T.LongType()), *X.RAW_SCHEMA.fields])
STAFF_COLUMNS = ["row_id", *[f.name for f in X.RAW_SCHEMA.fields if f.name != "_corrupt_record"]]
STAFF_FILE_SCHEMA = T.StructType([f for f in STAFF_CSV_SCHEMA.fields if f.name != "_corrupt_record"])
SPLIT_DATE = "1998-01-01"
ROWS_PER_FILE = 4_000_000
LOG_BLOCK_BYTES = 4 << 20  # row groups of a change log: a micro-batch of one file is read by many tasks


def joined_before(cutoff: str = SPLIT_DATE) -> Column:
    """Rows of the historical files: joining date before ``cutoff``."""
    return F.try_to_date("joining_date", "M/d/yyyy") < F.lit(cutoff).cast("date")


def write_csv(df: DataFrame, path: str, files: int = 4, header: bool = True, mode: str = "overwrite", **opts) -> None:
    """Write ``files`` CSV files; more of them where one would get over ``ROWS_PER_FILE`` rows, as a file is one task's."""
    n = max(files, -(-df.count() // ROWS_PER_FILE))
    w = df.repartition(n).write.mode(mode).option("header", str(header).lower())
    for k, v in opts.items():
        w = w.option(k, str(v))
    w.csv(path)


def set_mtime(spark: SparkSession, path: str, when: dt.datetime) -> None:
    """Set the modification time of every data file directly under ``path``."""
    ms = int(when.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    for name, is_dir, _, _ in fs_list(spark, path):
        if not is_dir and not name.startswith(("_", ".")):
            fs_set_mtime(spark, f"{path}/{name}", ms)


def raw_line(df: DataFrame) -> Column:
    """The CSV text of a staff_raw row (NULL as empty), built field by field."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in STAFF_COLUMNS])


def sql_raw_line() -> str:
    return "concat_ws(',', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in STAFF_COLUMNS) + ")"


def write_change_log(
    spark: SparkSession,
    changes: DataFrame,
    path: str,
    files: int = 6,
    arrival: str = "in_order",
    parts: int = 1,
) -> T.StructType:
    """Write a change log as ``files`` groups of contiguous commits, ``parts`` files each.

    With ``parts`` above 1 a commit's rows are spread over the files of its
    group, as those of a real commit are, so ``maxFilesPerTrigger=1`` cuts
    through commits.  ``arrival`` sets file modification times, which is the
    order the stream picks files up: ``in_order``, ``reversed`` (newest commits
    first) or ``interleaved`` (even groups, then odd ones).  Files sit in
    ``__bucket=<n>/__part=<n>`` subdirectories: stream the directory with
    ``recursiveFileLookup`` and the returned schema.
    """
    # Equal-width commit buckets, one bucket per file position: the grouping
    # is a pure function of the commit number, so reruns batch identically.
    lo, hi = changes.agg(F.min("_commit_version"), F.max("_commit_version")).first()
    width = (hi - lo + 1) if lo is not None else 1
    bucket = F.floor((F.col("_commit_version") - F.lit(lo or 0)) * F.lit(files) / F.lit(width)).cast("int")
    # maps cannot be hashed
    plain = [c for c in changes.columns if not isinstance(changes.schema[c].dataType, T.MapType)]
    part = F.pmod(F.xxhash64(*[F.col(c) for c in plain]), F.lit(parts)).cast("int")
    (
        changes.withColumn("__bucket", bucket)
        .withColumn("__part", part)
        .repartitionById(files * parts, F.coalesce(F.col("__bucket") * parts + F.col("__part"), F.lit(0)))
        .sortWithinPartitions("_commit_version")
        .write.mode("overwrite")
        .option("parquet.block.size", str(LOG_BLOCK_BYTES))
        .partitionBy("__bucket", "__part")
        .parquet(path)
    )

    def subdirs(at: str, key: str) -> list[str]:
        found = [(int(n.split("=", 1)[1]), n) for n, d, _, _ in fs_list(spark, at) if d and n.startswith(f"{key}=")]
        return [f"{at}/{n}" for _, n in sorted(found)]

    groups = [
        [
            f"{sub}/{f}"
            for sub in subdirs(b, "__part")
            for f in sorted(n for n, d, _, _ in fs_list(spark, sub) if not d and n.endswith(".parquet"))
        ]
        for b in subdirs(path, "__bucket")
    ]
    if arrival == "reversed":
        groups.reverse()
    elif arrival == "interleaved":
        groups = groups[0::2] + groups[1::2]
    t0 = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    for i, name in enumerate(n for g in groups for n in g):
        fs_set_mtime(spark, name, t0 + i * 60_000)
    return changes.schema
