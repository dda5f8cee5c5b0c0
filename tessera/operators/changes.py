"""Change-feed operators (SRC-14..16, CDC-6, CDC-10).

A change feed is a DataFrame of table rows plus ``_change_type`` (insert,
update_preimage, update_postimage, delete), ``_commit_version`` (bigint) and
``_commit_timestamp`` (timestamp).  On disk it is a Parquet directory
partitioned by ``_commit_version`` (see ``sinks.tables.append_changes``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHANGE_TYPE = "_change_type"
COMMIT_VERSION = "_commit_version"
COMMIT_TIMESTAMP = "_commit_timestamp"
CDF_COLUMNS = [CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP]
UPSERT_AND_DELETE = ("insert", "update_postimage", "delete")


def read_changes(changes: DataFrame, types: Sequence[str] = UPSERT_AND_DELETE) -> DataFrame:
    """Keep the wanted change types (pre-images dropped by default) (SRC-16, FLT-4)."""
    return changes.filter(F.col(CHANGE_TYPE).isin(*types))


def join_bounded(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "left_semi",
    null_safe: bool = False,
) -> DataFrame:
    """Join with a lookup table, without a hint: Spark broadcasts it when its size in bytes allows.

    ``null_safe=True`` matches NULL keys to NULL keys (``<=>``).  Otherwise a
    shuffle join is planned and AQE's skew-join split takes care of hot keys on
    the big side.
    """
    side = small
    if not null_safe:
        return big.join(side, on=list(on), how=how)
    renamed = side.select(*[F.col(k).alias(f"__r_{k}") for k in on])
    cond = None
    for k in on:
        c = big[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = big.join(renamed, on=cond, how=how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"__r_{k}" for k in on])


def whole_commits(batch: DataFrame, log: DataFrame) -> DataFrame:
    """All rows that ``log`` has of the commits from a micro-batch's first to its last.

    A commit may span files and a micro-batch may end between them.  The log
    holds every committed file, so what a batch sees of a commit does not
    depend on where the batch was cut.  Commits must be complete before the
    first of their files is listed.  The range is two scalars, pushed down to
    the scan of the log.
    """
    lo, hi = batch.agg(F.min(COMMIT_VERSION), F.max(COMMIT_VERSION)).first()
    return log.filter(F.col(COMMIT_VERSION).between(lo, hi)) if lo is not None else log.limit(0)


def skip_change_commits(changes: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Drop every commit holding any non-insert row (SRC-15, ``skipChangeCommits``).

    Which commits are clean is one partial aggregate per commit (no commit
    is ever gathered into one task); the rows are then semi-joined to it.
    ``log``: where commits are judged, by default ``changes`` itself.  A
    micro-batch may hold only some files of a commit, so a stream passes the
    log it reads from.
    """
    judged = changes if log is None else whole_commits(changes, log)
    clean = (
        judged.groupBy(COMMIT_VERSION)
        .agg(F.bool_and(F.col(CHANGE_TYPE) == F.lit("insert")).alias("__clean"))
        .filter("__clean")
        .select(COMMIT_VERSION)
    )
    return join_bounded(changes, clean, [COMMIT_VERSION], "left_semi")


def assert_append_only(changes: DataFrame) -> DataFrame:
    """Fail the query on any non-insert change (SRC-14: a strict append stream).

    The check is a filter, so it runs whichever columns are read later.  Its
    condition counts as nondeterministic, which keeps it above upstream joins:
    it sees the rows this frame yields, not rows that a join removes.
    """
    ct = F.col(CHANGE_TYPE)
    message = F.concat(F.lit("non-append change in an append-only stream: "), F.coalesce(ct, F.lit("null")))
    fails = F.raise_error(message).cast("boolean")
    here = F.spark_partition_id() >= 0  # true for every row; keeps the optimizer from moving the filter
    return changes.filter(F.when((ct == F.lit("insert")) & here, F.lit(True)).otherwise(fails))


def _diff_rows(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in old.columns if c not in keys]
    if sorted(values) != sorted(c for c in new.columns if c not in keys):
        raise ValueError("both versions need the same columns")
    def comparable(df: DataFrame) -> Column:
        # maps cannot be compared; their JSON text stands in for the equality test
        return F.struct(
            *[F.to_json(F.col(c)) if isinstance(df.schema[c].dataType, T.MapType) else F.col(c) for c in old.columns]
        )

    o = old.select(
        *[F.col(k).alias(f"__ok_{k}") for k in keys],
        F.struct(*[F.col(c) for c in old.columns]).alias("__o"),
        comparable(old).alias("__oc"),
    )
    n = new.select(
        *[F.col(k).alias(f"__nk_{k}") for k in keys],
        F.struct(*[F.col(c) for c in old.columns]).alias("__n"),
        comparable(new).alias("__nc"),
    )
    # Null-safe key match: a NULL key is one key, like in grouping.
    cond = None
    for k in keys:
        c = F.col(f"__ok_{k}").eqNullSafe(F.col(f"__nk_{k}"))
        cond = c if cond is None else cond & c
    j = o.join(n, on=cond, how="full_outer")
    changed = F.col("__o").isNotNull() & F.col("__n").isNotNull() & ~F.col("__oc").eqNullSafe(F.col("__nc"))

    def image(kind: str, cond: Column, side: str) -> Column:
        return F.when(cond, F.struct(F.lit(kind).alias(CHANGE_TYPE), F.col(side).alias("__r")))

    images = F.array(
        image("insert", F.col("__o").isNull(), "__n"),
        image("delete", F.col("__n").isNull(), "__o"),
        image("update_preimage", changed, "__o"),
        image("update_postimage", changed, "__n"),
    )
    exploded = j.select(F.explode(F.filter(images, lambda x: x.isNotNull())).alias("__c"))
    return exploded.select(*[F.col(f"__c.__r.{c}").alias(c) for c in old.columns], F.col(f"__c.{CHANGE_TYPE}").alias(CHANGE_TYPE))


def changed_buckets(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both versions' rows in key buckets that differ, and the (``__bucket``) list of these.

    A bucket's digest is its row count and two sums over 64-bit hashes of its rows:
    whole tables pass through partial aggregates and ``buckets`` rows meet.  Only
    rows of unequal buckets go on; the list is joined without a hint, so Spark
    broadcasts it when its bytes allow.
    """
    order = old.columns

    def prepared(df: DataFrame) -> DataFrame:
        return df.select(*order, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).alias("__bucket"))

    def digest(df: DataFrame) -> DataFrame:
        plain = [F.to_json(c) if isinstance(df.schema[c].dataType, T.MapType) else F.col(c) for c in order]
        nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in order])
        sums = [F.sum(F.xxhash64(F.lit(i), nulls, *plain).cast("decimal(20,0)")) for i in range(2)]
        return df.groupBy("__bucket").agg(F.struct(F.count(F.lit(1)).alias("n"), *[x.alias(f"s{i}") for i, x in enumerate(sums)]).alias("d"))

    o, n = prepared(old), prepared(new)
    both = digest(o).withColumnRenamed("d", "__o").join(digest(n).withColumnRenamed("d", "__n"), "__bucket", "full_outer")
    unequal = both.filter(~F.col("__o").eqNullSafe(F.col("__n"))).select("__bucket")
    return o.join(unequal, "__bucket", "left_semi").drop("__bucket"), n.join(unequal, "__bucket", "left_semi").drop("__bucket"), unequal


def change_feed(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    version: int | Column,
    timestamp: str | Column | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Change rows that turn table version ``old`` into ``new`` (CDC-6).

    One full outer equi-join on the keys (both sides shuffle by key; a table
    version holds one row per key, so no key is hot), then a null-safe
    comparison of whole rows.  ``old`` may be an empty DataFrame.

    With ``buckets`` the versions are first compared by digests of that many key
    buckets, and only rows of buckets that differ are joined: both tables are read
    twice, but little is shuffled when little has changed.
    """
    if buckets:
        old, new, _ = changed_buckets(old, new.select(*old.columns), keys, buckets)
    ts = F.current_timestamp() if timestamp is None else (F.lit(timestamp).cast("timestamp") if isinstance(timestamp, str) else timestamp)
    ver = version if isinstance(version, Column) else F.lit(int(version))
    return _diff_rows(old, new, keys).withColumn(COMMIT_VERSION, ver.cast("bigint")).withColumn(COMMIT_TIMESTAMP, ts)


def diff_tables(a: DataFrame, b: DataFrame, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Rows that differ between two results of one shape (CDC-10); ``buckets`` as in :func:`change_feed`."""
    if buckets:
        a, b, _ = changed_buckets(a, b.select(*a.columns), keys, buckets)
    return _diff_rows(a, b, keys)
