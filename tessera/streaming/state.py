"""SCD1 tables kept in Spark's own streaming state (CDC-1/2, STR-4).

The upsert is a streaming aggregation, ``groupBy(keys).agg(max_by(row, order))``
in update mode: Spark's state store holds one row for each key, commits it with
the batch and replays it after a failure.  ``max_by`` combines on the map side,
so a hot key is reduced before the shuffle, and does not mind in which order
changes arrive.  The table *is* that state, read back through Spark's state
data source; there are no files of its own to fold or compact.

* :func:`scd1_stream` aggregates a change stream directly.
* :class:`StateTable` is for hops that also publish what a batch changed.
  ``apply`` compares the batch, commit by commit, with the state of its keys,
  writes that feed to ``changes/batch_id=<id>`` and then the batch's staged rows
  to ``log/batch_id=<id>``; the aggregation streams that log (``settle``).  A
  replayed batch whose log is complete has been published and is left alone;
  otherwise the state cannot hold it yet, and it is done again.

The state's partitions are the session's shuffle partitions when the query
first starts.  Large states belong into the RocksDB state store provider.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.changes import COMMIT_TIMESTAMP, COMMIT_VERSION
from tessera.operators.scd import HELPERS, IS_DELETE, SEQ, TIE, scd1_view, with_change_helpers
from tessera.session import fs_exists, fs_list, fs_read_text, fs_write_text
from tessera.sinks.tables import foreach_batch, run_to_completion, start_stream
from tessera.sources.files import stream_table

COMMIT = "__commit"
COMMIT_TIME = "__commit_time"


def same_keys(keys: Sequence[str], left: str = "", right: str = "__r_") -> Column:
    """Null-safe equality of the key columns of two frames, told apart by prefixes."""
    cond = F.lit(True)
    for k in keys:
        cond &= F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}"))
    return cond


def latest_rows(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The upsert: the row of the highest (sequence, is_delete, tie) of each key, as one struct."""
    order = F.struct(SEQ, IS_DELETE, TIE)
    return staged.groupBy(*keys).agg(F.max_by(F.struct(*staged.columns), order).alias("__row"))


def state_rows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame | None:
    """``key`` and ``value`` of a query's state (after ``batch_id``, else its last batch); None before the first."""
    if not any(name.isdigit() for name, *_ in fs_list(spark, f"{checkpoint}/commits")):
        return None
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def committed_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame | None:
    """Staged rows that a ``latest_rows`` query holds; None before its first batch."""
    state = state_rows(spark, checkpoint, batch_id)
    if state is None:
        return None
    buffer = state.schema["value"].dataType.names[0]  # max_by keeps (row, order)
    return state.select(f"value.{buffer}.*")


class Scd1State:
    """An SCD1 table that is the state of a streaming query with this checkpoint."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.checkpoint = spark, checkpoint

    def state(self, batch_id: int | None = None) -> DataFrame | None:
        return committed_state(self.spark, self.checkpoint, batch_id)

    def scd1(self) -> DataFrame:
        rows = self.state()
        if rows is None:
            raise FileNotFoundError(f"no committed batch in {self.checkpoint}")
        return scd1_view(rows)


def scd1_stream(
    stream: DataFrame,
    checkpoint: str,
    keys: Sequence[str],
    sequence_by,
    apply_as_deletes: str | Column | None = "_change_type = 'delete'",
    except_columns: Sequence[str] = (),
    transform: Callable[[DataFrame], DataFrame] | None = None,
    trigger: str = "availableNow",
):
    """Stream form of ``scd1``: returns (query, table); read the result with ``table.scd1()``.

    ``transform`` must be a stateless plan (a filter, a projection).
    """
    changes = transform(stream) if transform else stream
    staged = with_change_helpers(changes, sequence_by, apply_as_deletes, except_columns)
    query = start_stream(latest_rows(staged, keys), None, checkpoint, fmt="noop", mode="update", trigger=trigger)
    return query, Scd1State(stream.sparkSession, checkpoint)


class StateTable:
    """An SCD1 table applied batch by batch, with a change feed for the next hop."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        sequence_by,
        apply_as_deletes: str | Column | None = "_change_type = 'delete'",
        except_columns: Sequence[str] = (),
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.sequence_by = sequence_by
        self.apply_as_deletes = apply_as_deletes
        self.except_columns = list(except_columns)
        self.log_path, self.changes_path = f"{self.path}/log", f"{self.path}/changes"
        self._settled: set[str] | None = None

    # -------------------------------------------------------------- reads
    def _schema(self) -> T.StructType | None:
        text = fs_read_text(self.spark, f"{self.path}/_SCHEMA.json")
        return None if text is None else T.StructType.fromJson(json.loads(text))

    def settle(self) -> str | None:
        """Let the aggregation take the log's new batches; returns its checkpoint (None: no batch yet).

        Spark cannot change the columns of a state, so a table with new columns
        starts another aggregation, which reads the log from its beginning.
        """
        schema = self._schema()
        if schema is None:
            return None
        checkpoint = f"{self.path}/state/{hashlib.md5(schema.json().encode()).hexdigest()[:12]}"
        batches = {checkpoint, *(name for name, *_ in fs_list(self.spark, self.log_path))}
        if batches != self._settled:
            log = stream_table(self.spark, self.log_path, schema, recursiveFileLookup="true")
            run_to_completion(start_stream(latest_rows(log, self.keys), None, checkpoint, fmt="noop", mode="update"))
            self._settled = batches
        return checkpoint

    def state(self, only_keys: DataFrame | None = None) -> DataFrame | None:
        """Rows of all applied batches, one a key, tombstones kept; only those of ``only_keys`` if given."""
        checkpoint = self.settle()
        rows = None if checkpoint is None else committed_state(self.spark, checkpoint)
        if rows is None or only_keys is None:
            return rows
        side = only_keys.select(*[F.col(k).alias(f"__r_{k}") for k in self.keys])
        return rows.join(side, same_keys(self.keys), "left_semi")

    def scd1(self) -> DataFrame:
        rows = self.state()
        if rows is None:
            raise FileNotFoundError(f"no committed batch in {self.path}")
        return scd1_view(rows)

    def has_changes(self) -> bool:
        return fs_exists(self.spark, self.changes_path)

    def change_feed(self) -> DataFrame:
        return self.spark.read.option("recursiveFileLookup", "true").parquet(self.changes_path)

    # -------------------------------------------------------------- writes
    def apply(self, changes: DataFrame, batch_id: int, emit_changes: bool = False) -> None:
        """Take one micro-batch of change rows; a batch id that was applied before is skipped.

        With ``emit_changes``, rows with ``_commit_version`` (and
        ``_commit_timestamp``) are followed commit by commit; commits must
        arrive whole and in order.  Without these columns the batch is one
        commit and its id the version.
        """
        if fs_exists(self.spark, f"{self.log_path}/batch_id={batch_id}/_SUCCESS"):
            return
        versioned = COMMIT_VERSION in changes.columns and COMMIT_VERSION in self.except_columns
        if emit_changes:
            version = F.col(COMMIT_VERSION) if versioned else F.lit(int(batch_id))
            time = F.col(COMMIT_TIMESTAMP) if versioned and COMMIT_TIMESTAMP in changes.columns else F.current_timestamp()
            changes = changes.withColumns({COMMIT: version.cast("bigint"), COMMIT_TIME: time})
        carry = [COMMIT, COMMIT_TIME] if emit_changes else []
        staged = with_change_helpers(changes, self.sequence_by, self.apply_as_deletes, [*self.except_columns, *carry], carry)
        staged = staged.persist()
        try:
            if emit_changes:
                old = self.state(only_keys=staged.select(*self.keys).distinct())
                feed = batch_change_feed(old, staged, self.keys)
                feed.write.mode("overwrite").parquet(f"{self.changes_path}/batch_id={batch_id}")
            rows = staged.drop(*carry)
            self._widen(rows.schema)
            rows.write.mode("overwrite").parquet(f"{self.log_path}/batch_id={batch_id}")
        finally:
            staged.unpersist()

    def _widen(self, schema: T.StructType) -> None:
        """Keep the union of all batches' columns."""
        known = self._schema() or T.StructType([])
        new = [f for f in schema.fields if f.name not in known.names]
        if new:
            merged = T.StructType([*known.fields, *new])
            fs_write_text(self.spark, f"{self.path}/_SCHEMA.json", merged.json())


def apply_stream(
    stream: DataFrame,
    table,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    trigger: str = "availableNow",
    **how,
):
    """Run a change stream into a ``StateTable`` or ``HistoryTable`` through ``foreachBatch``."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        table.apply(transform(batch) if transform else batch, batch_id, **how)

    return foreach_batch(stream, fn, checkpoint, trigger=trigger)


def batch_change_feed(old: DataFrame | None, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows of a batch, commit by commit.

    ``old`` holds the earlier staged rows of the batch's keys, ``staged`` the
    batch with ``__commit`` and ``__commit_time``.  A partial aggregate first
    leaves one row for each key and commit (and one for the older state); the
    running ``max_by`` over a key's commits is the state after each, the one
    before it the state before.  A window group has at most as many rows as
    the batch has commits, whatever a hot key's share of the rows.
    """
    cols = [c for c in staged.columns if c not in (COMMIT, COMMIT_TIME)]
    values = [c for c in cols if c not in HELPERS]
    tagged = staged
    if old is not None:
        # no commit: before all of the batch
        tagged = old.select(*[c for c in cols if c in old.columns]).unionByName(staged, allowMissingColumns=True).select(*staged.columns)
    packed = F.struct(*[F.col(c) for c in cols])
    order = F.struct(F.col(SEQ), F.col(IS_DELETE), F.col(TIE))
    per_commit = tagged.groupBy(*[F.col(k) for k in keys], COMMIT).agg(
        F.max_by(packed, order).alias("__row"), F.max(order).alias("__order"), F.max(COMMIT_TIME).alias(COMMIT_TIME)
    )
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(F.col(COMMIT).asc_nulls_first())
    latest = F.max_by("__row", "__order")
    per_key = per_commit.select(
        COMMIT,
        COMMIT_TIME,
        latest.over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("__b"),
        latest.over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("__a"),
    ).filter(F.col(COMMIT).isNotNull())
    b_live = F.col("__b").isNotNull() & ~F.col(f"__b.{IS_DELETE}")
    a_live = F.col("__a").isNotNull() & ~F.col(f"__a.{IS_DELETE}")

    def vals(side: str, comparable: bool = False) -> Column:
        fields = []
        for c in values:
            v = F.col(f"{side}.{c}")
            if comparable and isinstance(staged.schema[c].dataType, T.MapType):
                v = F.to_json(v)
            fields.append(v.alias(c))
        return F.struct(*fields)

    changed = b_live & a_live & ~vals("__b", True).eqNullSafe(vals("__a", True))

    def image(kind: str, cond: Column, side: str) -> Column:
        return F.when(cond, F.struct(F.lit(kind).alias("_change_type"), vals(side).alias("__r")))

    images = F.array(
        image("insert", ~b_live & a_live, "__a"),
        image("delete", b_live & ~a_live, "__b"),
        image("update_preimage", changed, "__b"),
        image("update_postimage", changed, "__a"),
    )
    out = per_key.select(COMMIT, COMMIT_TIME, F.explode(F.filter(images, lambda x: x.isNotNull())).alias("__c"))
    return out.select(
        *[F.col(f"__c.__r.{c}").alias(c) for c in values],
        F.col("__c._change_type").alias("_change_type"),
        F.col(COMMIT_TIME).alias(COMMIT_TIMESTAMP),
        F.col(COMMIT).alias(COMMIT_VERSION),
    )
