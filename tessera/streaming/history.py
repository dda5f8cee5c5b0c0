"""SCD2 history kept by splicing each batch into what is there (CDC-3/4, STR-4/5).

A change closes the version before it and ends where the next one begins.  A
batch therefore touches its own rows and their neighbours, however late it is:

1. one partial aggregate finds, for each of the batch's keys, the last known
   position before the batch's first change and the first after its last;
2. only the positions between these two, with the batch's own, are put in order
   (``operators.ordered``: range blocks, so a hot key is spread) and told their
   successors;
3. ``versions/batch_id=<id>`` gets the batch's changes with their ends, and for
   each neighbour that now ends earlier a row with nothing but the new end.

An end can only move earlier, so the table is a fold that needs no order of
batches and no window: for each (key, sequence) the values and the smallest end.
A replayed batch looks at the batches before it and rewrites its own folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ordered import next_in_key
from tessera.operators.scd import HELPERS, IS_DELETE, SEQ, TIE, with_change_helpers
from tessera.session import fs_exists, fs_list
from tessera.streaming.state import apply_stream, same_keys

END = "__end"
NEW = "__new"


class HistoryTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        sequence_by,
        apply_as_deletes: str | Column | None = "_change_type = 'delete'",
        except_columns: Sequence[str] = (),
        blocks: int | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.sequence_by = sequence_by
        self.apply_as_deletes = apply_as_deletes
        self.except_columns = list(except_columns)
        self.blocks = blocks
        self.versions_path = f"{self.path}/versions"

    # -------------------------------------------------------------- reads
    def _written(self, before: int | None = None) -> DataFrame | None:
        """Rows of the complete batches (those before ``before``)."""
        ids = sorted(int(n.split("=", 1)[1]) for n, is_dir, *_ in fs_list(self.spark, self.versions_path) if is_dir and n.startswith("batch_id="))
        paths = [
            f"{self.versions_path}/batch_id={b}"
            for b in ids
            if (before is None or b < before) and fs_exists(self.spark, f"{self.versions_path}/batch_id={b}/_SUCCESS")
        ]
        if not paths:
            return None
        return self.spark.read.option("mergeSchema", "true").parquet(*paths)

    def scd2(self) -> DataFrame:
        """The history: value columns, ``__START_AT`` and ``__END_AT`` (sequence structs)."""
        rows = self._written()
        if rows is None:
            raise FileNotFoundError(f"no committed batch in {self.path}")
        values = [c for c in rows.columns if c not in (*self.keys, *HELPERS, END, NEW)]
        packed = F.max_by(F.struct(F.lit(1).alias("__one"), *values), TIE).alias("__row")
        folded = rows.groupBy(*self.keys, SEQ, IS_DELETE).agg(packed, F.min(END).alias("__END_AT"))
        names = [c for c in rows.columns if c in (*self.keys, *values)]
        return folded.filter(~F.col(IS_DELETE)).select(
            *[F.col(c) if c in self.keys else F.col(f"__row.{c}").alias(c) for c in names], F.col(SEQ).alias("__START_AT"), "__END_AT"
        )

    # -------------------------------------------------------------- writes
    def neighbourhood(self, changes: DataFrame, before: int | None = None) -> DataFrame:
        """What a batch has to be ordered with: its (staged, deduplicated) rows and, with
        ``__new`` false, the known positions from the one before its keys' first change to the
        one after their last."""
        own = changes.withColumn(NEW, F.lit(True))
        known = self._written(before)
        if known is None:
            return own
        position = F.struct(SEQ, IS_DELETE)
        span = changes.groupBy(*self.keys).agg(F.min(position).alias("__lo"), F.max(position).alias("__hi"))
        first = self.keys[0]
        lo, hi = changes.agg(F.min(first), F.max(first)).first()
        near = known.select(*self.keys, position.alias("__at"))
        if lo is not None:  # two scalars that reach the scan
            near = near.filter(F.col(first).between(F.lit(lo), F.lit(hi)) | F.col(first).isNull())
        side = span.select(*[F.col(k).alias(f"__r_{k}") for k in self.keys], "__lo", "__hi")
        near = near.join(side, same_keys(self.keys)).select(*self.keys, "__at", "__lo", "__hi")
        at = F.col("__at")
        edges = near.groupBy(*self.keys).agg(
            F.max(F.when(at < F.col("__lo"), at)).alias("__before"), F.min(F.when(at > F.col("__hi"), at)).alias("__after")
        )
        sides = edges.select(*self.keys, F.explode(F.array("__before", "__after")).alias("__at")).filter("__at IS NOT NULL")
        inside = near.filter((at >= F.col("__lo")) & (at <= F.col("__hi"))).select(*self.keys, "__at").distinct()
        there = sides.unionByName(inside).select(*self.keys, f"__at.{SEQ}", f"__at.{IS_DELETE}")
        again = changes.select(*[F.col(k).alias(f"__r_{k}") for k in [*self.keys, SEQ, IS_DELETE]])
        there = there.join(again, same_keys([*self.keys, SEQ, IS_DELETE]), "left_anti")  # a change that is sent again is the batch's
        return own.unionByName(there.withColumn(NEW, F.lit(False)), allowMissingColumns=True)

    def apply(self, changes: DataFrame, batch_id: int) -> None:
        """Splice one micro-batch of change rows in; idempotent for each ``batch_id``."""
        staged = with_change_helpers(changes, self.sequence_by, self.apply_as_deletes, self.except_columns)
        order = [*self.keys, SEQ, IS_DELETE]
        # partial aggregate first: equal rows of a hot position never travel
        packed = F.max_by(F.struct(*staged.columns), TIE).alias("__row")
        once = staged.groupBy(*order).agg(packed).select(*[F.col(c) if c in order else F.col(f"__row.{c}").alias(c) for c in staged.columns])
        once = once.persist()
        try:
            # __new orders nothing (positions are unique); it tells what the successor is
            led = next_in_key(self.neighbourhood(once, batch_id), self.keys, [SEQ, IS_DELETE, NEW], "__next", self.blocks)
            touched = led.filter(F.col(NEW) | F.coalesce(F.col(f"__next.{NEW}"), F.lit(False)))
            out = touched.withColumn(END, F.col(f"__next.{SEQ}")).drop("__next")
            out.write.mode("overwrite").parquet(f"{self.versions_path}/batch_id={batch_id}")
        finally:
            once.unpersist()


def scd2_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    sequence_by,
    apply_as_deletes: str | Column | None = None,
    except_columns: Sequence[str] = (),
    transform: Callable[[DataFrame], DataFrame] | None = None,
    trigger: str = "availableNow",
    blocks: int | None = None,
):
    """Stream form of ``scd2``: returns (query, table); read the history with ``table.scd2()``."""
    table = HistoryTable(stream.sparkSession, path, keys, sequence_by, apply_as_deletes, except_columns, blocks)
    return apply_stream(stream, table, checkpoint, transform, trigger), table
