"""Merkle manifest of a dataset: trees over nested leaf intervals, proofs and their verification.

Rows are leaves of one tree for each value of a column; the trees' roots are the
leaves of the tree above.  Every node carries the interval [lo, hi) of the leaf
ranks that it covers, so ancestry is containment and needs no pointers:

1. ``ranked``: ranges of (tree, key) are numbered block by block, so that a tree
   with a third of all rows is still spread over all tasks.
2. ``fold``: bands of ``BAND`` levels.  One row holds the ``ARITY ** BAND`` nodes
   at most below one node of the band's top, and folds them level by level; the
   tops are the nodes that the next band folds.  A few bands reach any root.
3. ``with_paths``: top down, the rows of a band meet the nodes of the band above
   by a containment join, bucketed by level: a row's bucket there is its interval's
   start divided by the level's width.  What the parent's interval holds before and
   after a node's own interval are its siblings; they make a step of the path.

A path is an array of (left, right): the digests, as one string, of the
siblings on either side, from the leaf upwards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, ranked, require_columns

ARITY, BAND = 3, 6
WIDTH = ARITY**BAND
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def part(value: Column) -> Column:
    """A value's text as length in UTF-8 bytes, colon, text; ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return digest(*[part(v) for v in values])


def fold(nodes: DataFrame, band: int, carry: list[str]) -> DataFrame:
    """(tree, bucket, total, rows, lev0 .. lev``BAND``, steps0 ..) from nodes (tree, total, lo, hi, digest, carried columns).

    ``lev``j holds the nodes of level j of the band, in order, ``steps``j their
    siblings; ``more``j says whether that level was folded (a tree's only node
    stays as it is).
    """
    below = ARITY ** (BAND * band)
    row = F.struct("lo", "hi", "digest", *carry)
    at = F.expr(f"lo div {below * WIDTH}")
    out = nodes.groupBy("tree", at.alias("bucket")).agg(F.max("total").alias("total"), F.sort_array(F.collect_list(row)).alias("rows"))
    out = out.withColumn("lev0", F.transform("rows", lambda x: F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"), x["digest"].alias("digest"))))
    spread = F.col("total") > F.lit(below * WIDTH)  # the tree goes on above this band
    for j in range(BAND):
        out = out.withColumn(f"more{j}", spread | (F.size(f"lev{j}") > 1))
        up = F.expr(
            f"transform(sequence(0, (size(lev{j}) - 1) div {ARITY}), i -> struct("
            f"lev{j}[i * {ARITY}].lo AS lo, element_at(slice(lev{j}, i * {ARITY} + 1, {ARITY}), -1).hi AS hi, "
            f"sha2(array_join(slice(lev{j}, i * {ARITY} + 1, {ARITY}).digest, ''), 256) AS digest))"
        )
        out = out.withColumn(f"lev{j + 1}", F.when(F.col(f"more{j}"), up).otherwise(F.col(f"lev{j}")))
    # written with the band: inside a lambda an expression would be evaluated again for every leaf
    return out.withColumns({f"steps{j}": steps(j) for j in range(BAND)})


def steps(j: int) -> Column:
    """For each node of level j: the digests in its parent's interval before and after its own; null where not folded."""
    rest = (
        f"array_join(filter(slice(lev{j}, (i div {ARITY}) * {ARITY} + 1, {ARITY}), y -> y.lo >= {{0}} AND y.hi <= {{1}}).digest, '')"
    )
    parent = f"lev{j + 1}[i div {ARITY}]"
    left, right = rest.format(f"{parent}.lo", "x.lo"), rest.format("x.hi", f"{parent}.hi")
    return F.expr(f"CASE WHEN more{j} THEN transform(lev{j}, (x, i) -> struct({left} AS left, {right} AS right)) END")


def with_paths(bands: list[DataFrame], carry: list[str]) -> DataFrame:
    """(tree, lo, digest, carried columns, path) of every leaf; ``path`` ends below the tree's root."""
    above = None
    for b in range(len(bands) - 1, -1, -1):
        rows = bands[b]
        inside = ", ".join(f"steps{j}[i div {ARITY**j}]" for j in range(BAND))
        rows = rows.select(
            "tree", "bucket", F.expr(f"lev{BAND}[0].lo").alias("lo"), F.expr(f"lev{BAND}[0].hi").alias("hi"),
            F.expr(f"transform(rows, (x, i) -> struct(x AS row, filter(array({inside}), s -> s IS NOT NULL) AS path))").alias("rows"),
        )
        if above is None:
            rows = rows.withColumn("upper", F.array().cast(PATH))
        else:
            # a band's rows lie in the interval of one node of the level above, its bucket there is theirs
            up = above.select(
                F.col("tree").alias("__tree"), F.expr(f"lo div {ARITY ** (BAND * (b + 1))}").alias("__bucket"),
                F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), F.col("path").alias("upper"),
            )
            inside_of = (F.col("__lo") <= F.col("lo")) & (F.col("hi") <= F.col("__hi"))
            rows = rows.join(up, F.col("tree").eqNullSafe(F.col("__tree")) & (F.col("bucket") == F.col("__bucket")) & inside_of)
        each = rows.select("tree", "upper", F.explode("rows").alias("x"))
        extra = carry if b == 0 else []
        above = each.select(
            "tree", *[F.col(f"x.row.{c}").alias(c) for c in ("lo", "hi", "digest", *extra)], F.concat("x.path", "upper").alias("path")
        )
    return above


@dataclass
class Tree:
    """The folded bands of one or many trees, and their roots (tree, total, digest)."""

    bands: list[DataFrame]
    carry: list[str]

    @property
    def roots(self) -> DataFrame:
        return self.bands[-1].select("tree", "total", F.expr(f"lev{BAND}[0].digest").alias("digest"))

    def nodes(self) -> DataFrame:
        """(tree, level, lo, hi, digest) of every node, leaves at level 0."""
        out = None
        for b, rows in enumerate(self.bands):
            for j in range(BAND + 1):
                new = F.lit(b == 0) if j == 0 else F.col(f"more{j - 1}")
                level = rows.filter(new).select("tree", F.lit(b * BAND + j).alias("level"), F.inline(f"lev{j}"))
                out = level if out is None else out.unionByName(level)
        return out

    def paths(self) -> DataFrame:
        return with_paths(self.bands, self.carry)


def build(leaves: DataFrame, carry: list[str]) -> Tree:
    """Trees over leaves (tree, rank, total, digest, carried columns)."""
    nodes = leaves.select("tree", "total", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", *carry)
    bands = []
    while True:
        rows = materialize(fold(nodes, len(bands), carry if not bands else []), f"merkle-band{len(bands)}")
        bands.append(rows)
        if rows.filter("bucket > 0").isEmpty():
            return Tree(bands, carry)
        nodes = rows.select("tree", "total", F.inline(f"lev{BAND}"))


@dataclass
class Manifest:
    """Trees of the groups, and the tree over their roots (which has one tree, null)."""

    groups: Tree
    top: Tree

    def proofs(self) -> DataFrame:
        """(tree, lo, digest, carried columns, subroot, root, path) of every leaf, the path up to the root."""
        whole = self.top.roots.select(F.col("tree").alias("__all"), F.col("digest").alias("root"))
        above = self.top.paths().select(
            "tree", F.col("of").alias("__of"), F.col("digest").alias("subroot"), F.col("path").alias("__upper")
        )
        tops = materialize(above.join(whole, F.col("tree").eqNullSafe(F.col("__all"))).drop("tree", "__all"), "merkle-tops")
        leaves = self.groups.paths()
        found = leaves.join(tops, F.col("tree").eqNullSafe(F.col("__of")))
        return found.select("tree", "lo", "digest", *self.groups.carry, "subroot", "root", F.concat("path", "__upper").alias("path"))


def manifest(rows: DataFrame, tree: str, order: list[str], leaf: str, carry: list[str]) -> Manifest:
    """Manifest of ``rows``: one tree for each value of ``tree`` (null too) over ``leaf`` digests by ``order``.

    ``order`` ascends, null first; of equal rows the order has no effect on any
    result.  The trees' roots ascend by ``tree``, null first, bytes of UTF-8.
    """
    require_columns(rows, tree, leaf, *order, *carry)
    named = rows.select(
        F.col(tree).alias("tree"), F.col(leaf).alias("digest"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
        *[F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)], F.monotonically_increasing_id().alias("__row"),
    )
    keys = [f"__o{i}" for i in range(len(order))]
    numbered = ranked(materialize(named, "merkle-leaves"), ["tree"], [*keys, "digest", "__row"])
    kept = [f"__c{i}" for i in range(len(carry))]
    groups = build(numbered.select("tree", "rank", "total", "digest", *[F.col(k).alias(c) for k, c in zip(kept, carry, strict=True)]), carry)
    subroots = ranked(groups.roots.select(F.col("tree").alias("of"), "digest"), [], ["of"])
    top = build(subroots.select(F.lit(None).cast("string").alias("tree"), "rank", "total", "digest", "of"), ["of"])
    return Manifest(groups, top)


def folded(path: Column, leaf: Column) -> Column:
    """The root that ``leaf`` has with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda acc, s: digest(s["left"], acc, s["right"]))


def path_digest(path: Column) -> Column:
    """SHA-256 of all sibling digests of a path, from the leaf upwards, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def document_proofs(docs: DataFrame) -> DataFrame:
    """Every document's leaf, subroot, root and proof, and the check of its copy, of which some are tampered with.

    Copies whose id's unsigned CRC-32 (of its decimal text) is even lose the
    line feeds of their text; a null id's copy and a null text stay.  Equal
    rows each have a leaf; empty tables have no rows.
    """
    require_columns(docs, *COLUMNS)
    cols = [F.col(c) for c in COLUMNS]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    rows = docs.select("doc_id", "source", leaf_digest(*cols).alias("leaf"), leaf_digest(*cols[:-1], text).alias("copy"))
    found = manifest(rows, "source", ["doc_id"], "leaf", ["doc_id", "copy"]).proofs()
    return found.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("path"), F.col("copy")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
