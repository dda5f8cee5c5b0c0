"""Latest-state (SCD 1) and full-history (SCD 2) tables from a change stream.

Both are pure DataFrame plans, out-of-order safe (the ``sequence_by`` value
decides, never arrival order) and deterministic on ties:

* **SCD1** is one ``max_by`` aggregate per key.  It is associative and
  idempotent, so ``state ∪ batch`` folded again gives the same answer as the
  whole history at once — which is how the streaming form works — and a
  retried batch is harmless.  The aggregate runs partial-then-final, so a hot
  key is reduced map-side before the shuffle.
* **SCD2** orders each key's changes and closes every version with the
  sequence of the next change (``operators.ordered``: hot keys are split
  into value-range blocks, one shuffle serves dedup and window).

A delete wins a sequence tie (at silver a delete carries the same sequence
as the row it removes).  Tombstones stay in SCD1 *state* so that a late,
older upsert cannot resurrect a deleted key; the public view filters them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.rules import as_column
from tessera.operators.ordered import lag_in_blocks, lead_in_blocks, ranges, with_block_ids

SEQ = "__seq"
IS_DELETE = "__is_delete"
TIE = "__tie"
HELPERS = [SEQ, IS_DELETE, TIE]


def _seq_struct(sequence_by: Sequence[str | Column] | str | Column) -> Column:
    if isinstance(sequence_by, (str, Column)):
        sequence_by = [sequence_by]
    cols = [F.col(c) if isinstance(c, str) else c for c in sequence_by]
    return F.struct(*cols)


def _values(df: DataFrame, except_columns: Sequence[str]) -> list[str]:
    skip = set(except_columns) | set(HELPERS)
    return [c for c in df.columns if c not in skip]


def with_change_helpers(
    changes: DataFrame,
    sequence_by,
    apply_as_deletes: str | Column | None = "_change_type = 'delete'",
    except_columns: Sequence[str] = (),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Stage rows for merging: value columns + ``__seq``, ``__is_delete``, ``__tie``.

    ``carry``: excepted columns to keep beside them (no part of the tie hash).

    ``__tie`` is a hash of the value columns; it makes the choice between two
    upserts with one sequence deterministic (and the same in batch and stream).
    """
    is_delete = F.coalesce(as_column(apply_as_deletes), F.lit(False)) if apply_as_deletes is not None else F.lit(False)
    staged = changes.withColumn(SEQ, _seq_struct(sequence_by)).withColumn(IS_DELETE, is_delete)
    values = _values(staged, except_columns)
    # maps cannot be hashed; their JSON text stands in for the tie hash only
    hashed = [F.to_json(c) if isinstance(staged.schema[c].dataType, T.MapType) else F.col(c) for c in values]
    return staged.select(*values, *carry, SEQ, IS_DELETE, F.xxhash64(*hashed).alias(TIE))


def scd1_state(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fold staged rows (or an older state ∪ new staged rows) to one row per key.

    Winner = max of (sequence, is_delete, tie-hash): latest sequence, delete
    first on a tie.  Output keeps the helper columns, tombstones included.
    """
    cols = [c for c in staged.columns]
    packed = F.struct(*[F.col(c) for c in cols])
    order = F.struct(F.col(SEQ), F.col(IS_DELETE), F.col(TIE))
    return staged.groupBy(*[F.col(k) for k in keys]).agg(F.max_by(packed, order).alias("__row")).select(
        *[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in cols]
    )


def scd1_view(state: DataFrame, keep_tombstones: bool = False) -> DataFrame:
    """Public SCD1 table: live rows, helper columns removed."""
    live = state if keep_tombstones else state.filter(~F.col(IS_DELETE))
    return live.drop(*HELPERS) if not keep_tombstones else live.drop(TIE)


def scd1(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by,
    apply_as_deletes: str | Column | None = "_change_type = 'delete'",
    except_columns: Sequence[str] = (),
) -> DataFrame:
    """Upsert a change stream to one row per key; the latest sequence wins (CDC-1/2)."""
    staged = with_change_helpers(changes, sequence_by, apply_as_deletes, except_columns)
    return scd1_view(scd1_state(staged, keys))


def gc_tombstones(state: DataFrame, ts_field: str, ttl_seconds: int, now: Column | None = None) -> DataFrame:
    """Drop tombstones whose sequence timestamp is older than ``now - ttl`` (CDC-9).

    ``ts_field`` names a timestamp field of the sequence struct.  ``now``
    defaults to the newest sequence timestamp in the state (one scalar); pass
    it where it is known, which saves a fold of the state.  Live rows are never
    dropped, and without a cutoff (no timestamp at all) no tombstone is either.
    """
    ts = F.col(f"{SEQ}.{ts_field}")
    if now is None:
        now = F.lit(state.agg(F.max(ts)).first()[0])
    now = now.cast(state.select(ts.alias("t")).schema["t"].dataType)  # a typed NULL when there is none
    cutoff = now - F.make_dt_interval(secs=F.lit(ttl_seconds))
    return state.filter(~F.col(IS_DELETE) | F.coalesce(ts >= cutoff, F.lit(True)))


def scd2_versions(
    staged: DataFrame, keys: Sequence[str], blocks: int | None = None, collapse_on: Sequence[str] | None = None
) -> DataFrame:
    """History from staged rows: ``__START_AT`` / ``__END_AT`` (sequence structs).

    Every distinct sequence of a key opens a version (an unchanged row still
    makes one); a delete closes the open version and opens none.  Duplicate
    (key, sequence, kind) rows collapse to one, chosen by the tie hash; they
    are reduced on the map side, so a third of all rows may be such.

    With ``collapse_on`` a version opens only where one of these columns differs
    from the version before (null equals null) or where none is open: a run of
    equal versions is one, with the values of its first row.
    """
    cols = list(staged.columns)
    order = [*keys, SEQ, IS_DELETE]
    deduped = (
        staged.groupBy(*[F.col(c) for c in order])
        .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(TIE)).alias("__row"))
        .select(*[F.col(c) if c in order else F.col(f"__row.{c}").alias(c) for c in cols])
    )
    blocked = with_block_ids(ranges(deduped, order, blocks))
    if collapse_on is not None:
        blocked = _run_starts(blocked, keys, list(collapse_on))
    ordered = lead_in_blocks(blocked, keys, [SEQ, IS_DELETE])
    return (
        ordered.filter(~F.col(IS_DELETE))
        .withColumn("__START_AT", F.col(SEQ))
        .withColumn("__END_AT", F.col(f"__next.{SEQ}"))
        .drop("__next", *HELPERS)
    )


def _run_starts(blocked: DataFrame, keys: Sequence[str], compared: list[str]) -> DataFrame:
    """The changes that begin a run of equal ones: the row before is another, of another kind, or not there.

    Block by block, with the last row of the block before carried over, so runs
    and keys of any length are never gathered.
    """
    text = {c: F.to_json(c) for c in compared if isinstance(blocked.schema[c].dataType, T.MapType)}
    values = F.struct(F.lit(0).alias("__none"), *[text.get(c, F.col(c)).alias(c) for c in compared])
    told = lag_in_blocks(blocked.withColumn("__values", values), keys, [SEQ, IS_DELETE], [IS_DELETE, "__values"])
    before = F.col(f"__prev.{IS_DELETE}")
    # equal kinds, and of versions equal values; a delete where nothing is open tells nothing either
    same = (F.col(IS_DELETE) & before) | (~F.col(IS_DELETE) & ~before & F.col("__prev.__values").eqNullSafe(F.col("__values")))
    return told.filter(~F.coalesce(same, F.lit(False))).drop("__prev", "__values")


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by,
    apply_as_deletes: str | Column | None = None,
    except_columns: Sequence[str] = (),
    blocks: int | None = None,
    collapse_unchanged: bool | Sequence[str] = False,
) -> DataFrame:
    """Version history per key (CDC-3; with ``apply_as_deletes`` CDC-4).

    ``blocks``: contiguous ranges of (key, sequence) that the history is cut
    into, each at most one task (default: the session's shuffle partitions).
    ``collapse_unchanged`` merges neighbouring versions that are equal in the
    columns named, or (True) in all but the keys and the sequence's columns.
    """
    staged = with_change_helpers(changes, sequence_by, apply_as_deletes, except_columns)
    compared = None
    if collapse_unchanged:
        moving = {*keys, *HELPERS, *staged.schema[SEQ].dataType.fieldNames()}
        compared = [c for c in staged.columns if c not in moving] if collapse_unchanged is True else list(collapse_unchanged)
    return scd2_versions(staged, keys, blocks, compared)


def scd2_current(history: DataFrame) -> DataFrame:
    """Open versions only (CDC-5): a deleted key disappears from the current view."""
    return history.filter(F.col("__END_AT").isNull())


def flatten_sequence(df: DataFrame, cols: Sequence[str] = ("__START_AT", "__END_AT")) -> DataFrame:
    """Expand sequence structs into ``<col>_<field>`` columns (for SQL consumers)."""
    out = df
    for c in cols:
        fields = df.schema[c].dataType.fieldNames()
        out = out.select("*", *[F.col(f"{c}.{f}").alias(f"{c}_{f}") for f in fields]).drop(c)
    return out
