"""Source divergence audit: what the documents of a language's sources differ in, term by term.

A group is a (language, source); its count tree is a segment tree over the
language's term ids whose leaves are the group's counts.  Subtrees are
hash-consed: equal counts over equally long id ranges are one node, wherever they
stand and whichever group they belong to.  Two trees are compared by walking both
at once; a pair of nodes that comes up again, as do most in the long tail of rare
terms, is priced once.

1. Each task counts the terms of its documents; Spark sums up by (language,
   source, term) and keeps the terms that enough documents of the language hold.
2. Ids are ranks of the terms within their language, found range by range.
3. The trees are cut below nodes of ``SEGMENT`` ids: one task builds and compares
   the subtrees of up to ``2 * BLOCK`` groups over one segment.  Prices are sums, so
   Spark adds up the segments, which are the trees' upper levels.
4. The language's own tree is walked with each group's for the terms that the
   group over-uses.

All arithmetic is on integers; shares are in billionths.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, ranked, require_columns

#: Ids of a segment (a power of two) and groups of a block; bounds of one task's arrays.
SEGMENT, BLOCK = 4096, 64
SCALE = 10**9
#: Letters of ASCII in lower case and all bytes of other characters; blanks for the rest.
LETTERS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Entries that a task's table of counts holds before it is passed on.
FLUSH = 400_000
#: Marks the whole language among its groups, and ids beyond the last.
WHOLE, NO_ID = -1, -1


def term_counts(frames):
    """(lang, source, text) -> (lang, source, term, n, docs), summed over the documents seen since the last row went out."""
    seen: dict[tuple, dict] = defaultdict(dict)
    held = 0

    def flush():
        keys = [(g, t, *c) for g, terms in seen.items() for t, c in terms.items()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0][0] for k in keys], pa.string()), pa.array([k[0][1] for k in keys], pa.string()),
                pa.array([k[1].decode() for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.int64()),
                pa.array([k[3] for k in keys], pa.int64()),
            ],
            ["lang", "source", "term", "n", "docs"],
        )

    for batch in frames:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            own: dict[bytes, int] = {}
            for w in text.encode().translate(LETTERS).split():
                own[w] = own.get(w, 0) + 1
            group = seen[lang, source]
            before = len(group)
            for w, n in own.items():
                c = group.get(w)
                if c is None:
                    group[w] = [n, 1]
                else:
                    c[0] += n
                    c[1] += 1
            held += len(group) - before
            if held > FLUSH:
                yield from flush()
                seen.clear()
                held = 0
    if seen:
        yield from flush()


class Trees:
    """Hash-consed segment trees over the rows of a count matrix, whose width is a power of two.

    ``left[l]`` and ``right[l]`` are the children of the distinct nodes of level l
    (level 0: the counts themselves), ``root`` each row's topmost node.
    """

    def __init__(self, counts: np.ndarray):
        self.counts, ids = np.unique(counts, return_inverse=True)
        self.leaves = ids = ids.reshape(counts.shape)
        self.left, self.right = [None], [None]
        below = len(self.counts)
        self.size = [below]
        while ids.shape[1] > 1:
            nodes, at = np.unique(ids[:, ::2] * below + ids[:, 1::2], return_inverse=True)
            self.left.append(nodes // below)
            self.right.append(nodes % below)
            ids, below = at.reshape(ids.shape[0], -1), len(nodes)
            self.size.append(below)
        self.root = ids[:, 0]

    def price(self, a: int, b: int, leaf) -> int:
        """Sum of ``leaf`` over the leaves below nodes ``a`` and ``b``, each distinct pair of nodes priced once."""
        x, y, came = np.array([a]), np.array([b]), []
        for l, r, width in zip(self.left[:0:-1], self.right[:0:-1], self.size[-2::-1], strict=True):
            # the children of all pairs at this level, without repetitions
            pairs, at = np.unique(
                np.concatenate([l[x], r[x]]) * width + np.concatenate([l[y], r[y]]), return_inverse=True
            )
            came.append(at)
            x, y = pairs // width, pairs % width
        worth = leaf(x, y)
        for at in reversed(came):
            half = len(at) // 2
            worth = worth[at[:half]] + worth[at[half:]]
        return int(worth[0])


def shares(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (n + 2 v)) of each count; of the mark of a missing id 0."""
    return np.array([1 + SCALE * (c + 2) // (n + 2 * v) if c >= 0 else 0 for c in counts.tolist()], np.int64)


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are below 2^30, so the square fits."""
    return (p - q) ** 2 // np.maximum(p + q, 1)


def compare(top: int):
    """One segment of a language for two blocks of groups -> summed prices of pairs, and each group's terms of most excess."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.iloc[0]
        lang, segment, v = first["lang"], int(first["segment"]), int(first["v"])
        ids = min(SEGMENT, v - segment * SEGMENT)
        names = ["lang", "part", "a", "b", "id", "value"]
        rows = rows.sort_values("group").reset_index(drop=True)
        matrix = np.full((len(rows), SEGMENT), NO_ID, np.int64)
        matrix[:, : max(ids, 0)] = 0
        for i, (at, n) in enumerate(zip(rows["at"], rows["n"], strict=True)):
            if at is not None and len(at):
                matrix[i, np.asarray(at, np.int64)] = np.asarray(n, np.int64)
        trees = Trees(matrix)
        size = rows["size"].to_numpy()
        p = [shares(trees.counts, int(s), v) if v else np.zeros(len(trees.counts), np.int64) for s in size]
        group, block = rows["group"].to_numpy(), rows["group"].to_numpy() // BLOCK
        out = []
        own = first["bi"] == first["bj"]
        for i in range(len(rows)):
            for j in range(i + 1, len(rows)):
                if group[i] == WHOLE or (not own and block[i] == block[j]):
                    continue
                value = trees.price(trees.root[i], trees.root[j], lambda x, y, i=i, j=j: gaps(p[i][x], p[j][y]))
                out.append((lang, "pair", group[i], group[j], None, value))
        if own:
            whole = int(np.flatnonzero(group == WHOLE)[0])
            for i in np.flatnonzero(group != WHOLE).tolist():
                x, y = trees.leaves[i], trees.leaves[whole]
                value, more = gaps(p[i][x], p[whole][y]), p[i][x] > p[whole][y]
                at = np.flatnonzero((matrix[i] > 0) & more)
                for k in at[np.lexsort((at, -value[at]))][:top].tolist():
                    out.append((lang, "term", group[i], None, segment * SEGMENT + k, int(value[k])))
        return pd.DataFrame(out, columns=names).astype({"a": "Int64", "b": "Int64", "id": "Int64", "value": "Int64"})

    return run


def divergence(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): how far sources of a language are apart, and their own terms.

    ``pair``: every other source of the language with the summed gap of all kept
    terms.  ``term``: the ``top`` kept terms that the source uses more than the
    language, by their gap.  Null language, source and text are empty text; a group
    without terms still has shares, a language without kept terms has gaps of 0.
    Repeated rows are documents of their own; other columns are not read.
    """
    require_columns(docs, "text", "lang", "source")
    clean = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = clean.mapInArrow(term_counts, "lang string, source string, term string, n long, docs long")
    sums = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # as many rows a window as the language has sources
    told = sums.withColumn("all", F.sum("docs").over(Window.partitionBy("lang", "term")))
    kept = materialize(told.filter(F.col("all") >= min_docs).select("lang", "source", "term", "n"), "kept-terms")

    vocabulary = materialize(ranked(kept.select("lang", "term").distinct(), ["lang"], ["term"], "id", "v"), "vocabulary")
    named = kept.join(vocabulary.select("lang", "term", "id"), ["lang", "term"]).select("lang", "source", "id", "n")
    named = materialize(named, "term-ids")
    by_group = named.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    occurring = clean.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows"))
    sources = ranked(occurring, ["lang"], ["source"], "group", "groups").join(by_group, ["lang", "source"], "left")
    sizes = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = sources.join(sizes, "lang", "left").select(
        "lang", "source", "group", "groups", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("size", "v")]
    )
    groups = materialize(groups, "groups")
    # the language as a group of its own
    langs = groups.groupBy("lang").agg(F.lit(None).cast("string").alias("source"), F.lit(WHOLE).cast("long").alias("group"), F.max("groups").alias("groups"), F.sum("size").alias("size"), F.max("v").alias("v"))
    everyone = groups.unionByName(langs)

    at = (F.expr(f"id div {SEGMENT}").alias("segment"), F.struct((F.col("id") % SEGMENT).cast("int").alias("at"), "n").alias("e"))
    whole = named.groupBy("lang", "id").agg(F.sum("n").alias("n"))
    ids = named.join(groups.select("lang", "source", "group"), ["lang", "source"]).select("lang", "group", *at)
    ids = ids.unionByName(whole.select("lang", F.lit(WHOLE).cast("long").alias("group"), *at))
    lists = ids.groupBy("lang", "group", "segment").agg(F.collect_list("e").alias("e"))

    last = F.greatest(F.lit(0).cast("long"), F.expr(f"(v - 1) div {SEGMENT}"))
    cells = everyone.withColumn("segment", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    cells = cells.join(lists, ["lang", "group", "segment"], "left")
    blocks = F.expr(f"sequence(0L, (groups - 1) div {BLOCK})")
    mine = F.expr(f"`group` div {BLOCK}")
    dealt = cells.withColumn("other", F.explode(blocks)).select(
        "lang", "segment", "group", "size", "v", F.col("e.at").alias("at"), F.col("e.n").alias("n"),
        *[F.when(F.col("group") == WHOLE, F.col("other")).otherwise(f(mine, F.col("other"))).alias(c) for c, f in (("bi", F.least), ("bj", F.greatest))],
    )
    shape = "lang string, part string, a long, b long, id long, value long"
    cell = ["lang", "segment", "bi", "bj"]
    # few bytes but much work a cell: a number of partitions of its own keeps them from being joined by size
    spread = dealt.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cell)
    priced = materialize(spread.groupBy(*cell).applyInPandas(compare(top), shape), "prices")

    name = groups.select("lang", F.col("group").alias("g"), "source")
    pairs = priced.filter("part = 'pair'").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = pairs.select("lang", "value", F.explode(F.array(F.struct(F.col("a").alias("g"), F.col("b").alias("o")), F.struct(F.col("b").alias("g"), F.col("a").alias("o")))).alias("x"))
    both = both.select("lang", "value", "x.g", "x.o").join(name, ["lang", "g"])
    other = name.select("lang", F.col("g").alias("o"), F.col("source").alias("item"))
    both = both.join(other, ["lang", "o"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = priced.filter("part = 'term'").select("lang", F.col("a").alias("g"), "id", "value").join(name, ["lang", "g"])
    terms = terms.join(vocabulary.select("lang", "id", F.col("term").alias("item")), ["lang", "id"])
    terms = terms.select("lang", "source", F.lit("term").alias("part"), "item", "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item"))
    ranks = both.unionByName(terms).withColumn("rank", F.row_number().over(order))
    return ranks.filter((F.col("part") == "pair") | (F.col("rank") <= top))
