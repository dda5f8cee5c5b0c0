"""The next row of a key without putting a whole key into one task.

``lead(order) OVER (PARTITION BY keys ORDER BY order)`` sends every row of a
hot key (say a third of the table) to a single task.  Here instead:

1. Spark's range partitioner cuts the global (keys, order) sequence into
   ``blocks`` contiguous ranges; a reliable ``checkpoint()`` in the shared
   folder makes their partition ids stable block ids for every reader and any
   retry;
2. the first row of each block is copied to the end of the block before it, so
   that a block's last row of a key finds its successor;
3. the lead is taken inside each (block, key) group, at most one block long.

The number of blocks is a parameter (default: the shuffle partitions of the
session); nothing depends on size estimates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "__blk"


def ranges(df: DataFrame, cols: Sequence[str], blocks: int | None = None) -> DataFrame:
    """``df`` in ``blocks`` contiguous ranges of (cols), NULL first; equal rows share a range."""
    n = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in cols])


def with_block_ids(ranged: DataFrame) -> DataFrame:
    """Checkpoint a range-partitioned frame and add ``__blk``, its partition id."""
    from tessera.session import shared_dir

    shared_dir(ranged.sparkSession)  # make sure the checkpoint folder is set
    return ranged.checkpoint(eager=True).withColumn(BLOCK, F.spark_partition_id())


def lead_in_blocks(blocked: DataFrame, keys: Sequence[str], order: Sequence[str], out_col: str = "__next") -> DataFrame:
    """Steps 2 and 3 on a frame with ``__blk`` that is unique on (keys, order)."""
    cols = [c for c in blocked.columns if c != BLOCK]
    whole = F.struct(*[F.col(c) for c in [*keys, *order]])
    heads = blocked.groupBy(BLOCK).agg(F.min(whole).alias("__head"))
    # one row for each block, so a single task sees `blocks` rows at most
    before = heads.select(F.lag(BLOCK).over(Window.orderBy(BLOCK)).alias(BLOCK), "__head").filter(F.col(BLOCK).isNotNull())
    known = {c: F.col(f"__head.{c}") for c in [*keys, *order]}
    copies = before.select(
        *[known.get(c, F.lit(None).cast(blocked.schema[c].dataType)).alias(c) for c in cols],
        BLOCK,
        F.lit(True).alias("__copy"),
    )
    rows = blocked.select(*cols, BLOCK, F.lit(False).alias("__copy")).unionByName(copies)
    w = Window.partitionBy(BLOCK, *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    led = rows.withColumn(out_col, F.lead(F.struct(*[F.col(c) for c in order])).over(w))
    return led.filter(~F.col("__copy")).drop(BLOCK, "__copy")


def next_in_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out_col: str = "__next", blocks: int | None = None
) -> DataFrame:
    """Add ``out_col`` = struct(order...) of the following row within the same key.

    ``order`` columns are compared ascending, NULL first (Spark's struct order).
    Rows should be unique on (keys, order).
    """
    return lead_in_blocks(with_block_ids(ranges(df, [*keys, *order], blocks)), keys, order, out_col)


def lag_in_blocks(blocked: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str], out_col: str = "__prev") -> DataFrame:
    """``blocked`` with ``out_col`` = struct(carry...) of the row before within the same key, null for the first.

    The mirror image of :func:`lead_in_blocks`: the last row of each block is
    copied to the start of the block after it.  ``__blk`` stays.
    """
    cols = [c for c in blocked.columns if c != BLOCK]
    place = F.struct(*[F.col(c) for c in [*keys, *order]])
    known = [*keys, *order, *[c for c in carry if c not in (*keys, *order)]]
    tails = blocked.groupBy(BLOCK).agg(F.max_by(F.struct(*known), place).alias("__tail"))
    after = tails.select(F.lead(BLOCK).over(Window.orderBy(BLOCK)).alias(BLOCK), "__tail").filter(F.col(BLOCK).isNotNull())
    copies = after.select(
        *[F.col(f"__tail.{c}").alias(c) if c in known else F.lit(None).cast(blocked.schema[c].dataType).alias(c) for c in cols],
        BLOCK,
        F.lit(True).alias("__copy"),
    )
    rows = blocked.select(*cols, BLOCK, F.lit(False).alias("__copy")).unionByName(copies)
    w = Window.partitionBy(BLOCK, *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    lagged = rows.withColumn(out_col, F.lag(F.struct(*[F.col(c) for c in carry])).over(w))
    return lagged.filter(~F.col("__copy")).drop("__copy")
