"""SimHash near-duplicates through a Gray-ordered hierarchical index.

Fingerprints that differ in at most ``k`` of 64 bits are linked.  Cut the 64
bits into ``k + 1`` segments: two linked fingerprints agree in one segment at
least.  So there are ``k + 1`` Gray orders, each with another segment leading:

1. every order is range-partitioned and sorted by (segment, Gray rank), and
   each partition cuts its runs of one segment value into leaf blocks of at
   most ``BLOCK`` fingerprints; neighbours in Gray order differ in few bits, so
   a block has many bits in common: its *mask* and *pattern*;
2. a block is searched top-down: groups of ``FAN`` neighbours carry their own
   mask and pattern, and a pair of groups is dropped as a whole when the bits
   that both have fixed differ in more than ``k`` places;
3. blocks of one segment value meet in a join of their (mask, pattern) rows,
   pruned by the same count, so a value that a third of all rows share is
   spread over many tasks;
4. a task gives a spanning forest of the links it found, never all pairs;
5. components come from alternating large-star and small-star rounds over the
   links, each written to the shared folder.

Python works on bounded Arrow batches; no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import free_names, materialize, require_columns

BLOCK = 1024
FAN = 32
SEED = 42


# ------------------------------------------------------------------ fingerprints
def fingerprint(data: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash of the text's UTF-8 bytes as an unsigned integer.

    Words are runs of other than blanks after A-Z are lower-cased; a shorter
    text is one shingle, a text without words gives zero.
    """
    import xxhash

    words = (data or b"").lower().split()
    if not words:
        return 0
    s = b" ".join(words)
    ends = np.flatnonzero(np.frombuffer(s, np.uint8) == 32).tolist()
    starts = [0, *[e + 1 for e in ends]]
    ends.append(len(s))
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    last = min(shingle, len(words)) - 1
    h = np.fromiter((digest(s[a:b], SEED) for a, b in zip(starts[:n], ends[last:], strict=True)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 16384):
        bits = np.unpackbits(h[i : i + 16384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * ones > n))


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """(id, text_hash, fp) for every row; ``fp`` is the signed view of the 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(x.as_py(), shingle) for x in b.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())], names=["id", "text_hash", "fp"])

    narrow = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.lit(2), F.col(text_col).isNull(), F.col(text_col)).alias("text_hash"),
        F.col(text_col).cast("binary").alias("data"),
    )
    return narrow.mapInArrow(run, "id long, text_hash long, fp long")


# ------------------------------------------------------------------ index
def _segments(k: int) -> list[tuple[int, int]]:
    """(shift, width) of the k + 1 segments, from the highest bit on."""
    n, out, top = k + 1, [], 64
    for i in range(n):
        width = 64 // n + (i < 64 % n)
        out.append((top - width, width))
        top -= width
    return out


def gray_rank(x: Column) -> Column:
    """Rank of the 64-bit word in reflected Gray order, as an unsigned word in a long."""
    for step in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, step))
    return x


def _orders(fps: DataFrame, k: int) -> DataFrame:
    """One row for each fingerprint and order: (ord, seg, rank, fp); rank sorts as unsigned."""
    fp = F.col("fp")
    rows = []
    for i, (shift, width) in enumerate(_segments(k)):
        seg = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))
        left = 64 - shift - width  # rotate so that this segment leads
        turned = fp if left == 0 else F.shiftleft(fp, left).bitwiseOR(F.shiftrightunsigned(fp, 64 - left))
        # flip the sign bit: signed order of the long is then the unsigned order
        rank = gray_rank(turned).bitwiseXOR(F.lit(-(1 << 63)))
        rows.append(F.struct(F.lit(i).alias("ord"), seg.alias("seg"), rank.alias("rank"), fp.alias("fp")))
    return fps.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _common(a: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """(mask of the bits on which all agree, their pattern)."""
    low, high = np.bitwise_and.reduce(a), np.bitwise_or.reduce(a)
    mask = ~(low ^ high)
    return mask, low & mask


def _groups(a: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    parts = [a[i : i + FAN] for i in range(0, len(a), FAN)]
    both = [_common(p) for p in parts]
    return parts, np.array([m for m, _ in both], np.uint64), np.array([p for _, p in both], np.uint64)


class _Forest:
    """Union-find over the fingerprints of one task's block pair; keeps the links that joined two trees."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    def add(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.links.append((a, b))


def block_links(a: np.ndarray, b: np.ndarray | None, k: int) -> list[tuple[int, int]]:
    """Spanning forest of the links within block ``a``, or between ``a`` and ``b``; both sorted by Gray rank."""
    forest = _Forest()
    parts_a, mask_a, pat_a = _groups(a)
    parts_b, mask_b, pat_b = (parts_a, mask_a, pat_a) if b is None else _groups(b)
    for i, part in enumerate(parts_a):
        apart = np.bitwise_count((pat_b ^ pat_a[i]) & mask_b & mask_a[i])
        for j in np.flatnonzero(apart <= k):
            if b is None and j < i:
                continue
            near = np.bitwise_count(part[:, None] ^ parts_b[j][None, :]) <= k
            for x, y in zip(*np.nonzero(near), strict=True):
                if b is not None or i != j or x < y:
                    forest.add(int(part[x]), int(parts_b[j][y]))
    return forest.links


_BLOCKS = "ord int, seg long, block string, mask long, pattern long, n int, fps array<long>"


def _blocks(orders: DataFrame) -> DataFrame:
    """Leaf blocks of each order; ``orders`` is range-partitioned and sorted."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        key: tuple | None = None
        held: list[int] = []
        state = {"n": 0, "first": True, "cut": False}
        out: list[tuple] = []

        def flush(ends_run: bool, last: bool = False) -> None:
            # A lone fingerprint inside a partition has no partner under this segment value;
            # at a partition's edge, or after a cut, its run may go on elsewhere.
            if held and (len(held) > 1 or state["cut"] or state["first"] or last):
                a = np.array(held, np.int64).view(np.uint64)
                mask, pattern = (int(np.uint64(x).view(np.int64)) for x in _common(a))
                out.append((key[0], key[1], f"{part}-{state['n']}", mask, pattern, len(held), list(held)))
                state["n"] += 1
            held.clear()
            state["cut"] = not ends_run
            if ends_run:
                state["first"] = False

        for b in batches:
            for o, s, f in zip(b["ord"].tolist(), b["seg"].tolist(), b["fp"].tolist(), strict=True):
                if (o, s) != key:
                    if key is not None:
                        flush(True)
                    key = (o, s)
                elif len(held) >= BLOCK:
                    flush(False)
                held.append(f)
            if out:
                yield pd.DataFrame(out, columns=["ord", "seg", "block", "mask", "pattern", "n", "fps"])
                out.clear()
        if key is not None:
            flush(True, last=True)
        if out:
            yield pd.DataFrame(out, columns=["ord", "seg", "block", "mask", "pattern", "n", "fps"])

    return orders.mapInPandas(run, _BLOCKS)


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """Links (a, b) of rows with ``left`` and maybe ``right`` (null: within ``left``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_words = lambda x: np.asarray(x.values, np.int64).view(np.uint64)
        for b in batches:
            found = []
            for left, right in zip(b.column(0), b.column(1), strict=True):
                found += block_links(as_words(left), as_words(right) if right.is_valid else None, k)
            ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def links(fps: DataFrame, k: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that keep every component of "differ in <= k bits".

    ``fps`` has one row for each distinct fingerprint, materialised.  k is 0 or more.
    """
    spark = fps.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = _orders(fps, k).repartitionByRange(n, "ord", "seg", "rank").sortWithinPartitions("ord", "seg", "rank")
    blocks = materialize(_blocks(ordered), "simhash-blocks")
    none = F.lit(None).cast("array<long>")
    within = blocks.filter("n > 1").select(F.col("fps").alias("left"), none.alias("right"))
    heads = blocks.drop("fps", "n")
    x, y = heads.alias("x"), heads.alias("y")
    apart = F.bit_count(
        F.col("x.pattern").bitwiseXOR(F.col("y.pattern")).bitwiseAND(F.col("x.mask")).bitwiseAND(F.col("y.mask"))
    )
    same = (F.col("x.ord") == F.col("y.ord")) & (F.col("x.seg") == F.col("y.seg")) & (F.col("x.block") < F.col("y.block"))
    pairs = x.join(y, same & (apart <= k)).select(F.col("x.block").alias("xb"), F.col("y.block").alias("yb"))
    load = blocks.select("block", "fps")
    across = (
        pairs.join(load.toDF("xb", "left"), "xb").join(load.toDF("yb", "right"), "yb").select("left", "right")
    )
    return _search(within, k).unionByName(_search(across, k)).distinct()


# ------------------------------------------------------------------ components
def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): every node of ``edges`` (a, b) with the smallest node it can reach.

    Large-star and small-star rounds until nothing changes; each round is
    written to the shared folder.  Only two numbers a round reach the driver.
    """

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = mark(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_low, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("r")
        )
        e = materialize(small.select("r.*").filter("a <> b").distinct(), "links")
        after = mark(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


# ------------------------------------------------------------------ operator
def simhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """Near-duplicate components by SimHash; one output row for each input row.

    Returns ``id_col`` (long), ``text_hash`` (a hash of the text as it stands),
    ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable
    over links of ``max_bits`` or fewer differing bits, the own id included)
    and ``keep`` (true for one (id, text) of each component, that with the
    smallest id; repeated rows of it are all true).

    Null or empty texts, or texts of blanks only, have fingerprint zero and
    link like any other.  Rows without an id take part: their component's
    smallest id counts, which is null if no member has one; then the smallest
    fingerprint and text hash decide ``keep``.  Repeated rows and ids get equal
    answers.  An empty table gives no rows.  Other columns are ignored.
    """
    require_columns(docs, id_col, text_col)
    rows = materialize(with_fingerprints(docs, id_col, text_col, shingle), "simhash-docs")
    distinct = materialize(rows.groupBy("fp").agg(F.min(_first("id", "fp", "text_hash")).alias("first")), "simhash-fps")
    root = components(links(distinct.select("fp"), max_bits))
    linked = distinct.join(root.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    firsts = linked.groupBy("root").agg(F.min("first").alias("first"))
    class_of = linked.select("fp", "root").join(firsts, "root").select("fp", "first")
    joined = rows.join(class_of, "fp", "left")
    return joined.select(
        F.col("id").alias(id_col),
        "text_hash",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first.id").alias("component_id"),
        (
            F.col("id").eqNullSafe(F.col("first.id"))
            & (F.col("fp") == F.col("first.fp"))
            & (F.col("text_hash") == F.col("first.text_hash"))
        ).alias("keep"),
    )


def _first(i: str, fp: str, text_hash: str) -> Column:
    return F.struct(F.col(i).isNull().alias("none"), F.col(i).alias("id"), F.col(fp).alias("fp"), F.col(text_hash).alias("text_hash"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each component of :func:`simhash_dedup` (all its columns, of whatever name)."""
    k1, k2 = free_names(docs, "__k1", "__k2")
    kept = simhash_dedup(docs, id_col, text_col, **how).filter("keep").select(
        F.xxhash64(F.lit(1), F.col(id_col).isNull(), F.col(id_col)).alias(k1), F.col("text_hash").alias(k2)
    )
    t = F.col(text_col)
    own = docs.withColumns(
        {
            k1: F.xxhash64(F.lit(1), F.col(id_col).cast("long").isNull(), F.col(id_col).cast("long")),
            k2: F.xxhash64(F.lit(2), t.isNull(), t),
        }
    )
    return own.join(kept.distinct(), [k1, k2], "left_semi").dropDuplicates([k1, k2]).drop(k1, k2)
