"""Mixing sources to target weights.

Each source gets a share of the wanted words by its weight, but no more than
``cap`` times what it has; what is over goes to the others by weight.  Within a
source, documents follow a hash-random key; running sums of their word counts
say where the budget ends.  A budget beyond the source's size first takes whole
epochs.  DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import BLANKS, free_names, hash_key, materialize, prefix_sums, require_columns, word_array

#: Copies of one row that one task writes.
LOT = 1_000
WEIGHTS = (3.0, 1.0, 2.0)


def word_count(text: Column) -> Column:
    return F.size(word_array(text, BLANKS)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: one row for each source.

    Sources in code point order, null last, take ``weights`` in turn.  Sorted by
    cap / weight, the level up to which sources fill is the largest of
    (words left after the caps before) / (weights from here on); a target is the
    smaller of the source's cap and weight * level.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    return (
        sizes.withColumn("w", w)
        .withColumn("cap", F.col("source_size") * F.lit(float(cap)))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("before", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("rest", F.sum("w").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", F.max((F.col("total") - F.col("before")) / F.col("rest")).over(everything))
        .select("source", "source_size", F.least("cap", F.col("w") * F.col("level")).alias("target"))
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix",
    keep: Sequence[str] = (),
) -> DataFrame:
    """How many words of each document the mix takes; one row for each input row.

    Returns ``id_col``, ``text_hash``, ``size``, ``source_size``, ``target``,
    ``epochs`` (whole passes over the source), ``partial`` (words taken besides,
    from the document's start; less than ``size`` for the one document in which
    the source's budget ends) and ``taken`` = epochs * size + partial.  A
    source's ``taken`` add up to its target rounded down.

    A null text has size 0; a null source is a source of its own, the last;
    null ids and repeated rows take part one by one (which of two equal rows is
    cut is not defined, the set of answers is).  Sources without words have
    target 0.  An empty table gives no rows.  Other columns are ignored, but
    those in ``keep`` come out too.
    """
    require_columns(docs, id_col, text_col, source_col, *keep)
    rows = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            F.xxhash64(F.lit(2), F.col(text_col).isNull(), F.col(text_col)).alias("text_hash"),
            word_count(F.col(text_col)).alias("size"),
            hash_key(F.lit(seed), F.col(id_col), F.md5(F.col(text_col))).alias("key"),
            *[F.col(c).alias(f"__keep{i}") for i, c in enumerate(keep)],
        ),
        "mix-rows",
    )
    # one row for each source
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    budget = F.floor("target")
    plan = targets.withColumns(
        {
            "epochs": F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)),
        }
    ).withColumn("rest", F.floor("target") - F.col("epochs") * F.col("source_size"))
    plan = plan.withColumnRenamed("source", "__source")
    placed = prefix_sums(rows, ["source"], "key", ["id", "text_hash"], "size", "before")
    partial = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before"))).cast("long")
    return (
        placed.join(plan, F.col("source").eqNullSafe(F.col("__source")), "left")
        .withColumn("partial", partial)
        .select(
            F.col("id").alias(id_col),
            "text_hash",
            "size",
            "source_size",
            "target",
            F.col("epochs").cast("long").alias("epochs"),
            "partial",
            (F.col("epochs") * F.col("size") + F.col("partial")).cast("long").alias("taken"),
            *[F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)],
        )
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """``docs`` (its columns, of whatever name) with each row as often as the mix takes it.

    The copy in which a source's budget ends keeps as many words as are taken,
    joined by single blanks.  Documents without words are not taken.  Rows are
    told apart by all of their columns (two 64-bit hashes), so rows of one id and
    text keep their sources and other values; rows that are equal in all of them
    stand for each other, and each is copied by itself, however many there are.
    """
    names = docs.columns
    k1, k2, n_copy = free_names(docs, "__k1", "__k2", "__n")
    plain = [F.to_json(c) if isinstance(docs.schema[c].dataType, T.MapType) else F.col(c) for c in names]
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in names])
    own = docs.withColumns({k: F.xxhash64(F.lit(i), nulls, *plain) for i, k in enumerate((k1, k2))})
    text_size = F.col("size") > 0
    plan = mix(own, id_col, text_col, source_col, keep=[k1, k2], **how).select(
        k1,
        k2,
        F.when(text_size, F.col("epochs")).otherwise(F.lit(0)).alias("e"),
        (text_size & (F.col("partial") == F.col("size"))).cast("long").alias("x"),
        F.when((F.col("partial") > 0) & (F.col("partial") < F.col("size")), F.col("partial")).alias("p"),
    )
    # equal rows have one source, hence the same epochs; its budget may end among them
    per = plan.groupBy(k1, k2).agg(F.max("e").alias("e"), F.sum("x").alias("x"), F.count(F.lit(1)).alias("m"), F.max("p").alias("p"))
    per = materialize(per, "mix-plan")
    every = F.col("e") + (F.col("x") == F.col("m")).cast("long")
    whole = own.join(per.select(k1, k2, every.alias(n_copy)).filter(F.col(n_copy) > 0), [k1, k2])
    whole = whole.withColumn(n_copy, F.explode(F.array_repeat(F.lit(-1).cast("long"), F.col(n_copy).cast("int"))))
    # the rows in which a budget ends, at most one kind for each source: some of them once more, one in part
    rest = F.when(F.col("x") < F.col("m"), F.col("x")).otherwise(F.lit(0))
    ends = materialize(per.select(k1, k2, rest.alias("__rest"), F.col("p").alias("__p")).filter("__rest > 0 OR __p IS NOT NULL"), "mix-ends")
    some = own.join(ends, [k1, k2]).dropDuplicates([k1, k2])
    lots = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"__rest div {LOT}")))
    again = some.filter("__rest > 0").withColumn("__lot", lots).repartition(F.rand(7))  # lots of copies, one task each
    left = F.least(F.lit(LOT), F.col("__rest") - F.col("__lot") * LOT).cast("int")
    again = again.withColumn(n_copy, F.explode(F.array_repeat(F.lit(-1).cast("long"), left)))
    part = some.filter("__p IS NOT NULL").withColumn(n_copy, F.col("__p"))
    cut = F.array_join(F.slice(word_array(F.col(text_col), BLANKS), F.lit(1), F.col(n_copy).cast("int")), " ")
    text = F.when(F.col(n_copy) < 0, F.col(text_col)).otherwise(cut)
    out = [text.alias(c) if c == text_col else F.col(c) for c in names]
    return whole.select(*out).unionByName(again.select(*out)).unionByName(part.select(*out))
