"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Separators between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
#: Everything in ASCII but digits and lower-case letters.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and read it back.

    Cuts the lineage: what follows survives the loss of an executor without
    repeating the work before it, and every reader sees the same rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Keys in one row of a packed table.
PACK = 16


def listed(rows: DataFrame, key: str, keys: DataFrame, most: int, how: str = "left_semi") -> DataFrame:
    """The ``rows`` whose long ``key`` is in ``keys`` (its one column, distinct, not null); how: or ``left_anti``.

    Up to ``most`` keys are broadcast, ``PACK`` of them to a row: about 12 bytes each,
    where a hash table of single longs takes 70 to 110 and the driver holds several
    copies while it builds one.  Beyond it, a shuffle join: files of hashes say too
    little about their rows to leave that to their size.
    """
    n = keys.count()
    k, p, ks = free_names(rows, "__key", "__p", "__ks")
    keys = keys.toDF(k)
    if n > most:
        return rows.join(keys.hint("merge"), F.col(key) == F.col(k), how)
    pack = lambda c: F.pmod(F.col(c), F.lit(max(1, -(-n // PACK))))
    packed = keys.groupBy(pack(k).alias(p)).agg(F.collect_list(k).alias(ks))
    return rows.join(F.broadcast(packed), (pack(key) == F.col(p)) & F.array_contains(F.col(ks), F.col(key)), how)


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names`` as column names that ``df`` does not have yet, with underscores added where it does."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else; texts without other characters take the fast path."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.length(t) == F.octet_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, UPPER.lower()))


def word_array(text: Column, separators: str) -> Column:
    """The text's words (null: none), cut at runs of ``separators``."""
    # separators at either end leave an empty element there
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def hash_key(*cols: Column) -> Column:
    """A pseudo-random key in [0, 2^60) from the MD5 of the columns' text, nulls told from empty text."""
    parts = [F.coalesce(c.cast("string"), F.lit("~")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast(T.LongType())


KEY_BITS = 60


def prefix_sums(
    df: DataFrame, group: list[str], key: str, ties: list[str], value: str, out: str, rows_per_bucket: int = 2_000
) -> DataFrame:
    """Exclusive running sum of ``value`` within ``group`` in the order of ``key``, then ``ties``.

    ``key`` is a hash key of ``KEY_BITS`` bits.  Two levels, so that no group,
    however large, meets in one task: each group's key range is cut into equal
    buckets, as many as its row count asks for; a small table of bucket sums is
    summed up per group, and the rows only within their bucket.  ``df`` should
    be materialised, it is read twice.
    """
    def renamed(t: DataFrame, cols: list[str]) -> DataFrame:
        return t.withColumnsRenamed({c: f"__r{c}" for c in cols})

    def same(cols: list[str]) -> list[Column]:
        return [F.col(c).eqNullSafe(F.col(f"__r{c}")) for c in cols]

    rows = F.ceil(F.count(F.lit(1)) / F.lit(rows_per_bucket)).cast("long")
    counts = renamed(df.groupBy(*group).agg(rows.alias("__nb")), group)
    hi = F.shiftright(key, KEY_BITS - 30)  # 30 bits: hi * buckets stays within a long
    dealt = df.join(counts, same(group), "left").select(*df.columns, F.shiftright(hi * F.col("__nb"), 30).alias("__b"))
    by = [*group, "__b"]
    sums = dealt.groupBy(*by).agg(F.sum(value).alias("__s"))
    before = F.sum("__s").over(Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    starts = renamed(sums.select(*by, F.coalesce(before, F.lit(0)).alias("__before")), by)
    inner = Window.partitionBy(*by).orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    within = dealt.withColumn("__in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return within.join(starts, same(by), "left").select(*df.columns, (F.col("__before") + F.col("__in")).alias(out))


def ranked(df: DataFrame, tree: list[str], order: list[str], rank: str = "rank", total: str = "total") -> DataFrame:
    """``df`` with each row's rank (from 0) in its tree by ``order``, null first, and the tree's row count.

    ``order`` should have no ties.  One task numbers one block of a range
    partitioning; only the blocks' counts are summed up for each tree.
    """
    blocks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in [*tree, *order]]
    cut = materialize(df.repartitionByRange(blocks, *by).withColumn("__blk", F.spark_partition_id()), "ranks")
    counts = cut.groupBy("__blk", *tree).agg(F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy(*tree)
    before = whole.orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("__blk").alias("__b"),
        *[F.col(c).alias(f"__t{i}") for i, c in enumerate(tree)],
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(whole).alias(total),
    )
    own = F.row_number().over(Window.partitionBy("__blk", *tree).orderBy(*by[len(tree) :])) - 1
    same = (F.col("__blk") == F.col("__b")) & F.lit(True)
    for i, c in enumerate(tree):
        same &= F.col(c).eqNullSafe(F.col(f"__t{i}"))
    numbered = cut.withColumn("__own", own).join(starts, same)
    return numbered.select(*df.columns, (F.col("__before") + F.col("__own")).alias(rank), total)
