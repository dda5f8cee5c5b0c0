"""Benchmark decontamination: SimHash windows, Hamming blocks, exact check.

A document is contaminated by a benchmark item when one of its windows, as many
words long as the item, shares shingles of ``shingle`` words with it to a
weighted Jaccard similarity (shingles weigh as often as they occur) of at least
``similarity``.

1. Texts become arrays of shingle hashes.  A window without any of the item's
   shingles has similarity 0, so only windows around a shared shingle are kept.
2. Each such window gets a SimHash of its shingles, and so does each item.  A
   shingle's second and later occurrences are features of their own, so every
   feature weighs 1 and the shared features are the weighted intersection.
3. Multi-index: the 64 bits are cut into ``max_bits + 1`` blocks; a window and
   its item within ``max_bits`` bits agree in one block at least, so an
   equi-join on (item, block number, block bits) loses no pair in the radius.
4. Pairs within the radius are verified by their exact similarity.

DataFrame operations only.  With features of weight 1, a similarity of 0.8 means
a cosine of 0.889 or more: 9.7 of 64 bits differ on average with a standard
deviation of 2.9, and 24 is five deviations away.  Counted out with ties for up to
129 shingles, a pair at the bound is missed with a chance of at most 9 in a million.
Only 4 shingles against 5 would be worse (123 in a million), so items of up to
``EXACT_SHINGLES`` go to the exact check without the radius.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import NOT_WORD, free_names, listed, materialize, require_columns, word_array

SHINGLE = 5
SIMILARITY = 0.8
MAX_BITS = 24
#: Items of so few shingles skip the radius: ties of their bit counts widen the distance.
EXACT_SHINGLES = 5
#: Distinct benchmark shingles up to which they are broadcast, packed; beyond it, a shuffle join.
BROADCAST_SHINGLES = 2_000_000
#: The same for the 8-byte keys of texts that share a shingle with the benchmark.
BROADCAST_TEXTS = 2_000_000


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """Hashes of the text's word shingles in order; a shorter text is one shingle, one without words none."""
    words = word_array(F.lower(text), NOT_WORD)
    n = F.size(words)

    def at(w: Column) -> Column:
        long = F.transform(
            F.sequence(F.lit(0), F.size(w) - shingle), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(shingle)])
        )
        return F.when(F.size(w) >= shingle, long).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(
            F.array().cast("array<bigint>")
        )

    return F.when(n >= 0, F.get(F.transform(F.array(words), at), F.lit(0)))


def occurrences(hs: Column) -> Column:
    """The hashes with the second and later occurrences of each hashed with their number: no two alike; order is not kept."""

    def numbered(s: Column) -> Column:
        def spread(firsts: Column) -> Column:
            def run(at: Column, j: Column) -> Column:
                last = F.coalesce(F.get(firsts, j + 1), F.size(s)) - at - 1
                h = F.get(s, at)
                return F.transform(F.sequence(F.lit(0), last), lambda o: F.when(o == 0, h).otherwise(F.xxhash64(h, o)))

            return F.flatten(F.transform(firsts, run))

        firsts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return F.get(F.transform(F.array(firsts), spread), F.lit(0))

    repeats = F.size(F.array_distinct(hs)) < F.size(hs)
    return F.when(repeats, F.get(F.transform(F.array(F.sort_array(hs)), numbered), F.lit(0))).otherwise(hs)


#: Three counters of 21 bits in a long: bits b, b + 21 and b + 42 of a hash are counted at once.
_THREE = 1 | 1 << 21 | 1 << 42


def simhash(df: DataFrame, keys: list[str], h: str) -> DataFrame:
    """(keys, fp): bit b of ``fp`` is set when more than half of the group's hashes ``h`` have it.

    Groups are windows, so their
    counts stay far below 2^21; rows of a window come from one row, so partial
    sums leave a single row of each to shuffle.
    """
    sums = [F.sum(F.shiftrightunsigned(F.col(h), j).bitwiseAND(F.lit(_THREE))).alias(f"c{j}") for j in range(21)]
    last = F.sum(F.shiftrightunsigned(F.col(h), 63)).alias("c63")
    counted = df.groupBy(*keys).agg(*sums, last, F.count(F.lit(1)).alias("all"))
    word = F.lit(0).cast("long")
    for b in range(64):
        count = F.col("c63") if b == 63 else F.shiftright(F.col(f"c{b % 21}"), 21 * (b // 21)).bitwiseAND(F.lit((1 << 21) - 1))
        word = word.bitwiseOR(F.when(2 * count > F.col("all"), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, word.alias("fp"))


def hamming_blocks(fp: Column, max_bits: int) -> Column:
    """Array of (block number, block bits): max_bits + 1 blocks that cover the 64 bits."""
    n, out, at = max_bits + 1, [], 0
    for i in range(n):
        width = 64 // n + (i < 64 % n)
        out.append(F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1)).alias("bits")))
        at += width
    return F.array(*out)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(__k, item_id, similarity, start): the best window of each contaminated text and item.

    ``__k`` is the text's 64-bit hash; ``start`` counts shingles from 0.
    """
    spark = docs.sparkSession
    items = materialize(
        benchmark.filter(F.col(item_id).isNotNull())
        .select(F.col(item_id).alias("item"), shingle_hashes(F.col(item_text), shingle).alias("hs"))
        .filter(F.size("hs") > 0)
        .groupBy("item", "hs")
        .agg(F.lit(1).alias("one"))
        .select("item", F.xxhash64("item", "hs").alias("version"), "hs", F.size("hs").alias("n")),
        "leak-items",
    )
    index = materialize(
        items.select("version", "n", F.explode("hs").alias("h")).groupBy("version", "n", "h").agg(F.count(F.lit(1)).alias("c")),
        "leak-index",
    )
    known = index.select("h").distinct()
    key = F.xxhash64(F.lit(2), F.col(text_col).isNull(), F.col(text_col))
    shingled = docs.select(key.alias("k"), shingle_hashes(F.col(text_col), shingle).alias("hs"))
    # shared shingles; rows of equal texts answer for each other
    at = shingled.select("k", F.posexplode("hs").alias("pos", "h"))
    hits = materialize(listed(at, "h", known, BROADCAST_SHINGLES).distinct(), "leak-hits")
    near = materialize(hits.select("k").distinct(), "leak-near")
    # beyond the limit whole texts are shuffled to find the few with shared shingles
    texts = materialize(
        listed(docs.select(key.alias("k"), F.col(text_col).alias("t")), "k", near, BROADCAST_TEXTS)
        .groupBy("k")
        .agg(F.first("t").alias("t"))
        .select("k", shingle_hashes(F.col("t"), shingle).alias("hs")),
        "leak-texts",
    )
    sized = texts.select("k", F.size("hs").alias("len"))
    # windows of the item's size that hold the shared shingle; a shorter text is one window
    reach = (
        hits.join(index.select("version", "n", "h"), "h")
        .join(sized, "k")
        .select(
            "k",
            "version",
            "n",
            F.explode(
                F.sequence(
                    F.greatest(F.lit(0), F.least(F.col("pos") - F.col("n") + 1, F.col("len") - F.col("n"))),
                    F.greatest(F.lit(0), F.least(F.col("pos"), F.col("len") - F.col("n"))),
                )
            ).alias("start"),
        )
        .distinct()
    )
    spans = materialize(reach, "leak-windows")
    windows = spans.select("k", "n", "start").distinct()
    # the windows' file is far smaller than their rows: by its size the driver would get them all as a broadcast
    held = windows.join(texts.hint("merge"), "k").select("k", "n", "start", F.slice("hs", F.col("start") + 1, F.col("n")).alias("w"))
    content = held.select("k", "n", "start", F.explode(occurrences(F.col("w"))).alias("h"))
    window_fp = simhash(content, ["k", "n", "start"], "h")
    whole = items.select("version", F.explode(occurrences(F.col("hs"))).alias("h"))
    item_fp = simhash(whole, ["version"], "h").withColumnRenamed("fp", "item_fp")
    blocks = lambda c: F.explode(hamming_blocks(F.col(c), max_bits)).alias("b")
    mine = spans.join(window_fp.hint("merge"), ["k", "n", "start"]).select("k", "n", "start", "version", "fp", blocks("fp")).select("*", "b.*")
    theirs = item_fp.select("version", "item_fp", blocks("item_fp")).select("version", "item_fp", "b.*")
    close = (
        mine.join(theirs, ["version", "block", "bits"])
        .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= max_bits)
        .select("k", "n", "start", "version")
        .unionByName(spans.filter(F.col("n") <= EXACT_SHINGLES).select("k", "n", "start", "version"))
        .distinct()
    )
    # exact: the item's shingles within each window; stretches of n places keep a long text's windows and places apart
    stretch = lambda c: F.floor(c / F.col("n"))
    places = hits.join(index, "h").select("k", "version", "h", "c", "pos", stretch(F.col("pos")).alias("b"))
    ends = F.array_distinct(F.array(stretch(F.col("start")), stretch(F.col("start") + F.col("n") - 1)))
    inside = (F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("start") + F.col("n"))
    shared = (
        close.select("*", F.explode(ends).alias("b"))
        .join(places, ["k", "version", "b"])
        .filter(inside)
        .groupBy("k", "n", "start", "version", "h")
        .agg(F.least(F.count(F.lit(1)), F.max("c")).alias("both"))
        .groupBy("k", "n", "start", "version")
        .agg(F.sum("both").alias("both"))
    )
    # |window| + |item| - shared; a window at a short text's end has less than n shingles
    mass = shared.join(sized, "k").select(
        "k", "version", "start", (F.col("both") / (F.least("n", "len") + F.col("n") - F.col("both"))).alias("similarity")
    )
    best = (
        mass.filter(F.col("similarity") >= similarity)
        .groupBy("k", "version")
        .agg(F.max("similarity").alias("similarity"), F.min_by("start", F.struct(-F.col("similarity"), "start")).alias("start"))
    )
    return best.join(items.select("version", "item"), "version").select(
        F.col("k").alias("__k"), F.col("item").alias(item_id), "similarity", "start"
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row for each input row: ``id_col``, ``contaminated``, ``n_items``, ``items``, ``similarity``.

    ``items`` is the sorted list of benchmark ids found in the text, joined by
    commas; ``similarity`` the best one (null: none).  Null or empty texts are
    clean; items without id or words are left out, items with several texts
    match by any; null ids stay null; equal rows get equal answers; an empty
    benchmark contaminates nothing.  Other columns are ignored.
    """
    require_columns(docs, id_col, text_col)
    item_id = how.get("item_id", "item_id")
    found = materialize(
        leaks(docs, benchmark, text_col, **how)
        .groupBy("__k")
        .agg(F.sort_array(F.collect_set(item_id)).alias("__items"), F.max("similarity").alias("__s")),
        "leak-found",
    )
    t = F.col(text_col)
    own = docs.select(F.col(id_col).alias("__id"), F.xxhash64(F.lit(2), t.isNull(), t).alias("__k"))
    n = F.coalesce(F.size("__items"), F.lit(0))
    n = F.when(F.col("__items").isNull(), F.lit(0)).otherwise(n)
    return own.join(found, "__k", "left").select(
        F.col("__id").alias(id_col),
        (n > 0).alias("contaminated"),
        n.cast("long").alias("n_items"),
        F.coalesce(F.array_join(F.col("__items").cast("array<string>"), ","), F.lit("")).alias("items"),
        F.col("__s").alias("similarity"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` (all columns, of whatever name) whose text holds no benchmark item.

    Null and empty texts are clean; see :func:`contaminated` for the other cases.
    """
    t = F.col(text_col)
    (k,) = free_names(docs, "__k")
    bad = materialize(leaks(docs, benchmark, text_col, **how).select(F.col("__k").alias(k)).distinct(), "leak-found")
    own = docs.withColumn(k, F.xxhash64(F.lit(2), t.isNull(), t))
    return listed(own, k, bad, BROADCAST_TEXTS, "left_anti").drop(k)
