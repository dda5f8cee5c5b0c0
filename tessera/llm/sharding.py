"""Sharding: a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring of 2^60 positions; a document
belongs to the first point clockwise of its hash.  Shards hold at most their
capacity: documents for which a full shard has no room continue clockwise to
the next point whose shard has.  With the exact capacities used here (counts at
most one apart) every shard ends full, so balance holds for any data.

Spark counts the documents of each arc; these ``shards * vnodes`` numbers, and
nothing that grows with the data, decide on the driver how many of each arc's
documents go where.  Ranks within arcs are distributed prefix sums, and a
bounded join of (arc, rank range) gives each document its shard and slot.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hash_key, materialize, prefix_sums, require_columns

VNODES = 64
OVERHEAD = 16


def ring(shards: int, vnodes: int = VNODES) -> tuple[list[int], list[int]]:
    """(positions in order, owning shards); a shard's points do not depend on the other shards."""
    points = sorted(
        (int(hashlib.md5(f"shard-{s}:{v}".encode()).hexdigest()[:15], 16), s) for s in range(shards) for v in range(vnodes)
    )
    return [p for p, _ in points], [s for _, s in points]


def plan_arcs(counts: dict[int, int], owners: list[int], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, slot of the first) pieces that place every document.

    Each round offers what is left of each arc to its next point clockwise;
    a shard takes from the arcs in ring order until it is full.
    """
    room, used = list(capacity), [0] * len(capacity)
    left = [(a, 0, counts[a], a) for a in sorted(counts) if counts[a]]
    out = []
    while left:
        again = []
        for arc, lo, hi, at in left:
            shard = owners[at % len(owners)]
            take = min(room[shard], hi - lo)
            if take:
                out.append((arc, lo, lo + take, shard, used[shard]))
                used[shard] += take
                room[shard] -= take
            if lo + take < hi:
                nxt = at + 1
                while not room[owners[nxt % len(owners)]]:
                    nxt += 1
                    if nxt > at + 2 * len(owners):
                        raise ValueError("capacities do not hold the documents")
                again.append((arc, lo + take, hi, nxt))
        left = again
    return out


def shard(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", vnodes: int = VNODES, seed: str = "ring"
) -> DataFrame:
    """Shard and slot of every row; counts of shards are at most one apart.

    Returns ``id_col``, ``size`` (UTF-8 bytes of the text plus 16),
    ``text_crc32`` (of the UTF-8 bytes), ``shard`` from 0 and ``slot``, gapless
    from 0 within the shard.  A row's ring position is a hash of its id and
    text.

    A null text counts as empty; null ids are placed by their text; repeated
    rows are placed one by one (which of two equal rows gets which place is not
    defined).  An empty table gives no rows; other columns are ignored.
    """
    require_columns(docs, id_col, text_col)
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    positions, owners = ring(shards, vnodes)
    table = np.array(positions, np.int64)

    @F.pandas_udf("int")
    def arc_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(table, key.to_numpy(np.int64), "left") % len(table)).astype("int32")

    rows = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(data) + OVERHEAD).cast("long").alias("size"),
            F.crc32(data).alias("crc"),
            hash_key(F.lit(seed), F.col(id_col), F.md5(F.col(text_col))).alias("key"),
            F.lit(1).cast("long").alias("one"),
        ).withColumn("arc", arc_of("key")),
        "shard-rows",
    )
    counts = {r["arc"]: r["count"] for r in rows.groupBy("arc").count().collect()}  # at most shards * vnodes rows
    n = sum(counts.values())
    capacity = [n // shards + (s < n % shards) for s in range(shards)]
    plan = docs.sparkSession.createDataFrame(
        plan_arcs(counts, owners, capacity), "arc_p int, lo long, hi long, shard int, base long"
    )
    ranked = prefix_sums(rows, ["arc"], "key", ["id", "crc", "size"], "one", "rank")
    # pieces: one for each arc and shard it spills to, bounded by the ring, not by the data
    hit = (F.col("arc") == F.col("arc_p")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    return ranked.join(F.broadcast(plan), hit).select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"),
    )
