"""The three medallion tracks as chains of streaming hops (CDC-7, CDC-8, STR-6).

Each hop is one ``availableNow`` query that streams the previous layer, so a
rerun picks up only what is new.  Nothing is collected: every hop is a
Spark job from files to files.

* :func:`run_primary`   — append track: CSV -> raw -> silver good/bad ->
  curated (expectations and their counts) -> gold materialized view and gold
  SCD2, and the quarantine branch silver -> tagged staging -> manual curated / bad.
* :func:`run_ignore`    — the same layers on a change log whose update/delete
  commits are skipped (``skipChangeCommits``): they keep old rows.
* :func:`run_propagate` — change propagation: raw change log -> silver SCD1
  (+ bad) -> curated SCD1 gate (+ labelled bad) -> gold SCD2 and view, and the
  quarantine branch silver -> tagged staging SCD1 -> manual curated / bad
  SCD1; every hop reads the previous table's change feed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import quality as Q
from tessera.operators.changes import CDF_COLUMNS, read_changes, skip_change_commits, whole_commits
from tessera.operators.derive import add_derived, employee_derivations, gold_summary
from tessera.sinks.tables import append_table, foreach_batch, refresh_view, run_to_completion
from tessera.sources.files import csv_stream, stream_table
from tessera.sources.rescue import CORRUPT_COL, RESCUE_COL, rescue_csv_stream
from tessera.session import fs_exists
from tessera.streaming.history import HistoryTable
from tessera.streaming.state import StateTable

SILVER_SEQUENCE = ["upd_tmst", "create_tmst"]
CURATED_SEQUENCE = ["_commit_version", "_commit_timestamp"]
GOLD_SEQUENCE = ["upd_tmst", "create_tmst", "_commit_version"]
QUARANTINE_COLUMNS = ["quarantine_reason", "is_quarantined"]
GOLD_CLUSTER = ["empid", "dept_id", "joining_date"]  # fixed values: the gold tables' clustering columns


def _enforce(df: DataFrame, schema: T.StructType, keep) -> DataFrame:
    return Q.enforce_schema(df, schema, Q.EMPLOYEE_DATE_FORMATS, keep=keep)


def _stream_dir(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream a directory of Parquet files written per batch (schema from the files)."""
    schema = spark.read.option("recursiveFileLookup", "true").parquet(path).schema
    opts = {"recursiveFileLookup": "true"}
    if max_files:
        opts["maxFilesPerTrigger"] = max_files
    return stream_table(spark, path, schema, **opts)


# ------------------------------------------------------------------ primary
def run_primary(
    spark: SparkSession,
    raw_dir: str,
    raw_schema: T.StructType,
    silver_schema: T.StructType,
    base: str,
    as_of=None,
    keys=("empid",),
    order_desc=("upd_tmst", "create_tmst"),
    max_files: int = 2,
    rescue_col: str | None = RESCUE_COL,
    glob: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Append track end to end; returns the gold materialized view.

    The raw table keeps every value the schema has no place for in ``rescue_col``
    and every malformed line in ``_corrupt_record``; columns are found by header
    name.  ``rescue_col=None`` reads by position, without rescued values.
    """
    ck = f"{base}/_checkpoints"
    # hop 1: files -> raw
    if rescue_col:
        declared = T.StructType([f for f in raw_schema if f.name != CORRUPT_COL])
        raw = rescue_csv_stream(
            spark, raw_dir, declared, f"{base}/raw", f"{ck}/raw", rescue_col, CORRUPT_COL, glob, recursive, max_files
        )
    else:
        rows = csv_stream(
            spark, raw_dir, raw_schema, max_files=max_files, mode="PERMISSIVE", corrupt_col=CORRUPT_COL, glob=glob, recursive=recursive
        )
        raw = append_table(rows, f"{base}/raw", f"{ck}/raw")
    run_to_completion(raw)

    # hop 2: raw -> silver good and bad, both from one read of each batch
    keep = [c for c in raw_schema.fieldNames() if c not in silver_schema.fieldNames() and c != CORRUPT_COL]

    def silver(batch: DataFrame, batch_id: int) -> None:
        enforced = _enforce(batch, silver_schema, keep).persist()
        try:
            Q.good_rows(enforced).write.mode("overwrite").parquet(f"{base}/silver/batch_id={batch_id}")
            Q.bad_rows(enforced).write.mode("overwrite").parquet(f"{base}/silver_bad/batch_id={batch_id}")
        finally:
            enforced.unpersist()

    if not fs_exists(spark, f"{base}/raw"):
        raise FileNotFoundError(f"no input files under {raw_dir}")
    run_to_completion(foreach_batch(_stream_dir(spark, f"{base}/raw"), silver, f"{ck}/silver"))

    # hop 3: silver -> curated (drop rules), what they drop, the rules' counts; and the quarantine
    # branch (tagged staging, manual curated and bad), all from one read of each batch
    _curated_hop(spark, base, ck, quarantine=True)
    return _gold_hop(spark, base, ck, as_of, keys, order_desc)


def _curated_hop(spark: SparkSession, base: str, ck: str, quarantine: bool = False) -> None:
    """silver -> curated, curated_bad and curated_counts (rule, passed, failed of each batch).

    With ``quarantine`` also silver_quarantine, partitioned by its flag, and the
    two tables that it splits into."""
    rules = Q.CURATED_DROP_RULES

    def curated(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            Q.expect_or_drop(batch, rules).write.mode("overwrite").parquet(f"{base}/curated/batch_id={batch_id}")
            Q.quarantine_complement(batch, rules).write.mode("overwrite").parquet(f"{base}/curated_bad/batch_id={batch_id}")
            counts = Q.expectation_counts(batch, {**rules, **Q.CURATED_WARN_RULES})
            counts.write.mode("overwrite").parquet(f"{base}/curated_counts/batch_id={batch_id}")
            if quarantine:
                tagged = Q.tag_violations(batch)
                tagged.write.mode("overwrite").partitionBy("is_quarantined").parquet(f"{base}/silver_quarantine/batch_id={batch_id}")
                ok, bad = Q.split_quarantine(tagged)
                ok.write.mode("overwrite").parquet(f"{base}/curated_manual/batch_id={batch_id}")
                bad.write.mode("overwrite").parquet(f"{base}/curated_manual_bad/batch_id={batch_id}")
        finally:
            batch.unpersist()

    run_to_completion(foreach_batch(_stream_dir(spark, f"{base}/silver"), curated, f"{ck}/curated"))


def gold_history(spark: SparkSession, base: str, keys=("empid",)) -> HistoryTable:
    """The SCD2 gold table of the primary and the ignore track (no deletes reach it)."""
    return HistoryTable(spark, f"{base}/gold_cdc", list(keys), SILVER_SEQUENCE, apply_as_deletes=None)


def _gold_hop(spark: SparkSession, base: str, ck: str, as_of, keys, order_desc) -> DataFrame:
    """curated -> gold SCD2 and the gold materialized view (returned)."""
    history = gold_history(spark, base, keys)

    def versions(batch: DataFrame, batch_id: int) -> None:
        history.apply(add_derived(batch, employee_derivations(as_of)), batch_id)

    run_to_completion(foreach_batch(_stream_dir(spark, f"{base}/curated"), versions, f"{ck}/gold_cdc"))

    def gold() -> DataFrame:
        cur = spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/curated")
        return gold_summary(cur, as_of=as_of, keys=keys, order_desc=order_desc)

    return refresh_view(spark, gold, f"{base}/gold", GOLD_CLUSTER)


def _read_log(spark: SparkSession, log_dir: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(log_dir)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over as many tasks as the session shuffles to."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# ------------------------------------------------------------------ ignore
def run_ignore(
    spark: SparkSession,
    log_dir: str,
    log_schema: T.StructType,
    silver_schema: T.StructType,
    base: str,
    as_of=None,
    keys=("empid",),
    order_desc=("upd_tmst", "create_tmst"),
    keep=("row_id",),
    max_files: int = 1,
) -> DataFrame:
    """Change log with update/delete commits skipped: layers only ever append."""
    ck = f"{base}/_checkpoints"
    log = stream_table(spark, log_dir, log_schema, maxFilesPerTrigger=max_files, recursiveFileLookup="true")

    def silver(batch: DataFrame, batch_id: int) -> None:
        # a batch may end within a commit: commits are judged by all their files
        clean = skip_change_commits(batch, _read_log(spark, log_dir, log_schema)).drop(*CDF_COLUMNS)
        enforced = _enforce(clean, silver_schema, list(keep)).persist()
        try:
            Q.good_rows(enforced).write.mode("overwrite").parquet(f"{base}/silver/batch_id={batch_id}")
            Q.bad_rows(enforced).write.mode("overwrite").parquet(f"{base}/silver_bad/batch_id={batch_id}")
        finally:
            enforced.unpersist()

    run_to_completion(foreach_batch(log, silver, f"{ck}/silver"))
    if not fs_exists(spark, f"{base}/silver"):
        raise FileNotFoundError(f"no change log files under {log_dir}")
    _curated_hop(spark, base, ck)
    return _gold_hop(spark, base, ck, as_of, keys, order_desc)


# ------------------------------------------------------------------ propagate
@dataclass
class PropagateTables:
    silver: StateTable
    silver_bad: StateTable
    curated: StateTable
    curated_bad: StateTable
    gold: HistoryTable
    staging: StateTable  # quarantine staging: tagged silver rows (DQ-8)
    manual_curated: StateTable
    manual_bad: StateTable
    gold_view: DataFrame | None = None  # recomputed from the curated table by each run


def _changes_stream(spark: SparkSession, table: StateTable, max_files: int | None) -> DataFrame:
    return _stream_dir(spark, table.changes_path, max_files)


def run_propagate(
    spark: SparkSession,
    log_dir: str,
    log_schema: T.StructType,
    silver_schema: T.StructType,
    base: str,
    as_of=None,
    keys=("empid",),
    keep=("row_id",),
    max_files: int = 1,
    hop_max_files: int | None = None,
    quarantine: bool = True,
    silver_sequence=tuple(SILVER_SEQUENCE),
) -> PropagateTables:
    """Deletes and updates flow from a raw change log to gold SCD2 (CDC-7).

    Call it again as new raw commits arrive: each hop resumes from its
    checkpoint.  ``max_files`` caps raw files per micro-batch; commits that a
    batch holds in part are read whole from the log, and every hop's feed
    carries the raw commits' versions, so the tables do not depend on where
    batches are cut.  Raw commits must arrive in order, and each downstream hop
    takes all new feed files of a run in one batch (``hop_max_files`` caps them;
    use it only if each feed file holds whole commits).
    """
    ck = f"{base}/_checkpoints"
    keys = list(keys)
    t = PropagateTables(
        silver=StateTable(spark, f"{base}/silver", keys, list(silver_sequence), except_columns=CDF_COLUMNS),
        silver_bad=StateTable(spark, f"{base}/silver_bad", keys, list(silver_sequence), except_columns=CDF_COLUMNS),
        curated=StateTable(spark, f"{base}/curated", keys, CURATED_SEQUENCE, except_columns=CDF_COLUMNS),
        curated_bad=StateTable(spark, f"{base}/curated_bad", keys, CURATED_SEQUENCE, except_columns=CDF_COLUMNS),
        gold=HistoryTable(spark, f"{base}/gold", keys, GOLD_SEQUENCE, except_columns=CDF_COLUMNS),
        staging=StateTable(spark, f"{base}/staging", keys, CURATED_SEQUENCE, except_columns=CDF_COLUMNS),
        manual_curated=StateTable(
            spark, f"{base}/manual_curated", keys, CURATED_SEQUENCE, except_columns=[*CDF_COLUMNS, *QUARANTINE_COLUMNS]
        ),
        manual_bad=StateTable(
            spark, f"{base}/manual_bad", keys, CURATED_SEQUENCE, except_columns=[*CDF_COLUMNS, *QUARANTINE_COLUMNS]
        ),
    )

    # hop 1: raw change feed -> enforce -> silver SCD1 and silver-bad SCD1 (deletes reach both)
    def hop1(batch: DataFrame, batch_id: int) -> None:
        # the log's splits are cut for the whole log: a batch's rows may all be in a few of them
        commits = spread(whole_commits(batch, _read_log(spark, log_dir, log_schema)))
        enforced = _enforce(read_changes(commits), silver_schema, [*keep, *CDF_COLUMNS]).persist()
        try:
            good, bad = Q.split_enforced_changes(enforced)
            t.silver.apply(good, batch_id, emit_changes=True)
            t.silver_bad.apply(bad, batch_id, emit_changes=True)
        finally:
            enforced.unpersist()

    log = stream_table(spark, log_dir, log_schema, maxFilesPerTrigger=max_files, recursiveFileLookup="true")
    run_to_completion(foreach_batch(log, hop1, f"{ck}/silver"))

    # hop 2: silver change feed -> curated gate SCD1; silver-bad feed -> labelled SCD1
    def hop2(batch: DataFrame, batch_id: int) -> None:
        t.curated.apply(Q.gate_changes(read_changes(batch)), batch_id, emit_changes=True)

    def hop2_bad(batch: DataFrame, batch_id: int) -> None:
        t.curated_bad.apply(Q.label_changes(read_changes(batch)), batch_id)

    if t.silver.has_changes():
        run_to_completion(foreach_batch(_changes_stream(spark, t.silver, hop_max_files), hop2, f"{ck}/curated"))
    if t.silver_bad.has_changes():
        run_to_completion(
            foreach_batch(_changes_stream(spark, t.silver_bad, hop_max_files), hop2_bad, f"{ck}/curated_bad")
        )

    # hop 2b (DQ-8): silver change feed -> tagged staging SCD1 -> its change feed
    # split with delete pass-through -> manual curated / manual bad SCD1
    def hop2_staging(batch: DataFrame, batch_id: int) -> None:
        t.staging.apply(Q.tag_violations(read_changes(batch)), batch_id, emit_changes=True)

    def hop2_split(batch: DataFrame, batch_id: int) -> None:
        ch = read_changes(batch).persist()
        try:
            reason_len = F.length("quarantine_reason")
            t.manual_curated.apply(ch.filter(Q.pass_deletes(reason_len == 0)), batch_id)
            t.manual_bad.apply(ch.filter(Q.pass_deletes(reason_len > 0)), batch_id)
        finally:
            ch.unpersist()

    if quarantine and t.silver.has_changes():
        run_to_completion(foreach_batch(_changes_stream(spark, t.silver, hop_max_files), hop2_staging, f"{ck}/staging"))
        if t.staging.has_changes():
            run_to_completion(
                foreach_batch(_changes_stream(spark, t.staging, hop_max_files), hop2_split, f"{ck}/manual")
            )

    # hop 3: curated change feed -> derived columns -> gold SCD2 (deletes close versions)
    def hop3(batch: DataFrame, batch_id: int) -> None:
        t.gold.apply(add_derived(read_changes(batch), employee_derivations(as_of)), batch_id)

    if t.curated.has_changes():
        run_to_completion(foreach_batch(_changes_stream(spark, t.curated, hop_max_files), hop3, f"{ck}/gold"))
        # the recomputed gold view: one row per key of the curated table as it is now
        t.gold_view = refresh_view(
            spark,
            lambda: gold_summary(t.curated.scd1(), as_of=as_of, keys=keys, order_desc=SILVER_SEQUENCE),
            f"{base}/gold_view",
            GOLD_CLUSTER,
        )
    return t
