"""SCD1 / SCD2 / change feed / skip-change-commits: unit cases and properties."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import MEDIUM, SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import changes as C
from tessera.operators.ordered import next_in_key
from tessera.operators.scd import flatten_sequence, scd1, scd1_state, scd1_view, scd2, scd2_current, with_change_helpers
from tessera.plans import fixtures as X

SCHEMA = "k string, v string, seq int, _change_type string"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_scd1_latest_sequence_wins_regardless_of_order(spark):
    data = [("a", "v3", 3, "update_postimage"), ("a", "v1", 1, "insert"), ("a", "v2", 2, "update_postimage")]
    out = scd1(rows(spark, data), ["k"], "seq").collect()
    assert [(r["k"], r["v"]) for r in out] == [("a", "v3")]


def test_scd1_delete_wins_a_tie_and_tombstone_blocks_late_rows(spark):
    data = [("a", "v1", 1, "insert"), ("a", "v1", 5, "delete"), ("a", "late", 5, "update_postimage"), ("b", "x", 1, "insert")]
    out = scd1(rows(spark, data), ["k"], "seq").collect()
    assert [r["k"] for r in out] == ["b"]
    # fold the state with an older, late-arriving upsert: the key stays deleted
    st = scd1_state(with_change_helpers(rows(spark, data), "seq"), ["k"])
    late = with_change_helpers(rows(spark, [("a", "older", 4, "update_postimage")]), "seq")
    again = scd1_view(scd1_state(st.unionByName(late), ["k"])).collect()
    assert [r["k"] for r in again] == ["b"]


def test_scd1_fold_is_associative(spark):
    ch = C.read_changes(X.changes(spark, SMALL))
    staged = with_change_helpers(ch, ["ts", "event_id"], except_columns=C.CDF_COLUMNS)
    whole = scd1_view(scd1_state(staged, ["user_id"]))
    a = staged.filter(F.col("event_id") % 3 == 0)
    b = staged.filter(F.col("event_id") % 3 != 0)
    parts = scd1_view(scd1_state(scd1_state(b, ["user_id"]).unionByName(scd1_state(a, ["user_id"])), ["user_id"]))
    assert sorted(whole.collect()) == sorted(parts.collect())


def test_scd2_versions_and_deletes(spark):
    data = [("a", "v1", 1, "insert"), ("a", "v2", 3, "update_postimage"), ("a", None, 5, "delete"), ("a", "v3", 7, "insert")]
    h = flatten_sequence(scd2(rows(spark, data), ["k"], "seq", apply_as_deletes="_change_type = 'delete'"))
    got = sorted((r["v"], r["__START_AT_seq"], r["__END_AT_seq"]) for r in h.collect())
    assert got == [("v1", 1, 3), ("v2", 3, 5), ("v3", 7, None)]
    cur = scd2_current(scd2(rows(spark, data), ["k"], "seq", apply_as_deletes="_change_type = 'delete'")).collect()
    assert [r["v"] for r in cur] == ["v3"]


def test_scd2_delete_in_a_tie_leaves_zero_length_version(spark):
    data = [("a", "v1", 1, "insert"), ("a", "v1", 1, "delete")]
    h = flatten_sequence(scd2(rows(spark, data), ["k"], "seq", apply_as_deletes="_change_type = 'delete'")).collect()
    assert [(r["__START_AT_seq"], r["__END_AT_seq"]) for r in h] == [(1, 1)]


def test_scd2_properties_on_events(spark):
    ch = C.read_changes(X.changes(spark, MEDIUM))
    h = flatten_sequence(scd2(ch, ["user_id"], ["ts", "event_id"], "_change_type = 'delete'", C.CDF_COLUMNS))
    assert h.count() == 6005
    open_per_key = h.filter(F.col("__END_AT_ts").isNull()).groupBy("user_id").count()
    assert open_per_key.filter("count > 1").count() == 0
    assert open_per_key.count() == 116
    # intervals of a key never overlap: each START is >= the previous END
    w = Window.partitionBy("user_id").orderBy("__START_AT_ts", "__START_AT_event_id")
    prev_end = F.lag(F.struct("__END_AT_ts", "__END_AT_event_id")).over(w)
    bad = h.withColumn("p", prev_end).filter(
        F.col("p").isNotNull() & (F.struct("__START_AT_ts", "__START_AT_event_id") < F.col("p"))
    )
    assert bad.count() == 0
    # SCD1 == SCD2 current, key by key
    s1 = scd1(ch, ["user_id"], ["ts", "event_id"], except_columns=C.CDF_COLUMNS)
    cur = scd2_current(scd2(ch, ["user_id"], ["ts", "event_id"], "_change_type = 'delete'", C.CDF_COLUMNS))
    assert sorted(s1.collect()) == sorted(cur.drop("__START_AT", "__END_AT").collect())


@pytest.mark.parametrize("blocks", [1, 3, 16])
def test_next_in_key_matches_window_with_a_hot_key(spark, blocks):
    # one key holds most rows; with several blocks it spans several of them
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 37).cast("string")).alias("k"),
        ((F.col("id") * 7919) % 3001).alias("s"),
    )
    got = next_in_key(df, ["k"], ["s"], blocks=blocks).select("k", "s", F.col("__next.s").alias("n"))
    w = Window.partitionBy("k").orderBy("s")
    want = df.select("k", "s", F.lead("s").over(w).alias("n"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_next_in_key_null_keys_and_nested_order(spark):
    df = spark.createDataFrame(
        [(None, dt.datetime(2024, 1, 1), 1), (None, dt.datetime(2024, 1, 2), 2), ("x", None, 3), ("x", dt.datetime(2024, 1, 1), 4)],
        "k string, ts timestamp_ntz, id int",
    ).select("k", F.struct("ts", "id").alias("q"))
    got = {(r["k"], r["q"]["id"], r["__next"]["q"]["id"] if r["__next"] else None) for r in next_in_key(df, ["k"], ["q"], blocks=3).collect()}
    assert got == {(None, 1, 2), (None, 2, None), ("x", 3, 4), ("x", 4, None)}


def test_change_feed_counts(spark):
    feed = C.change_feed(X.snapshot_old(spark, MEDIUM), X.snapshot_new(spark, MEDIUM), ["k"], 2)
    counts = {r["_change_type"]: r["count"] for r in feed.groupBy("_change_type").count().collect()}
    assert counts == {"insert": 100, "delete": 150, "update_preimage": 150, "update_postimage": 150}


def test_change_feed_of_identical_versions_is_empty(spark):
    old = X.snapshot_old(spark, SMALL)
    assert C.change_feed(old, old, ["k"], 1).count() == 0


def test_skip_change_commits(spark):
    kept = C.skip_change_commits(X.changes(spark, MEDIUM))
    assert kept.count() == 422
    assert kept.filter("_change_type <> 'insert'").count() == 0


def test_strict_append_raises_on_change(spark):
    from pyspark.errors import PySparkException

    ok = C.assert_append_only(C.skip_change_commits(X.changes(spark, SMALL)))
    assert ok.count() > 0
    with pytest.raises(PySparkException):
        C.assert_append_only(X.changes(spark, SMALL)).collect()
    with pytest.raises(PySparkException):
        C.assert_append_only(X.changes(spark, SMALL)).drop("_change_type").collect()
    with pytest.raises(PySparkException):
        C.assert_append_only(X.changes(spark, SMALL)).count()
    # rows that an upstream join removes do not count
    removed = X.changes(spark, SMALL).join(ok.select("event_id"), "event_id", "left_semi")
    assert C.assert_append_only(removed).count() == ok.count()


def test_commits_are_judged_by_their_whole_log(spark):
    log = spark.createDataFrame([("a", 1, "insert"), ("b", 1, "delete"), ("c", 2, "insert")], "k string, _commit_version long, _change_type string")
    batch = log.filter("k in ('a', 'c')")  # the delete of commit 1 is in another file
    assert [r["k"] for r in C.skip_change_commits(batch, log).collect()] == ["c"]
    assert sorted(r["k"] for r in C.whole_commits(log.filter("k = 'a'"), log).collect()) == ["a", "b"]
    assert C.whole_commits(log.limit(0), log).count() == 0


def test_scd2_does_not_depend_on_the_number_of_blocks(spark):
    ch = C.read_changes(X.changes(spark, SMALL))
    one, many = (
        sorted(scd2(ch, ["user_id"], ["ts", "event_id"], "_change_type = 'delete'", C.CDF_COLUMNS, blocks=b).collect()) for b in (1, 40)
    )
    assert one == many
    w = Window.partitionBy("k").orderBy("s")
    df = spark.range(0, 2000).select((F.col("id") % 3).alias("k"), ((F.col("id") * 7) % 2003).alias("s"))
    want = df.select("k", "s", F.lead("s").over(w).alias("n")).collect()
    got = next_in_key(df, ["k"], ["s"], blocks=30).select("k", "s", F.col("__next.s").alias("n")).collect()
    assert sorted(got) == sorted(want)


def test_tombstones_without_a_sequence_time_stay(spark):
    from tessera.operators.scd import gc_tombstones

    df = spark.createDataFrame([("a", None, "delete"), ("b", None, "insert")], "k string, ts timestamp, _change_type string")
    state = scd1_state(with_change_helpers(df, ["ts"]), ["k"])
    assert gc_tombstones(state, "ts", 60).count() == 2


def test_map_columns_in_changes(spark):
    df = spark.createDataFrame(
        [("a", {"x": "1"}, 1, "insert"), ("a", {"x": "2"}, 2, "update_postimage")],
        "k string, m map<string,string>, seq int, _change_type string",
    )
    assert scd1(df, ["k"], "seq").collect()[0]["m"] == {"x": "2"}
    old = df.filter("seq = 1").select("k", "m")
    new = df.filter("seq = 2").select("k", "m")
    kinds = sorted(r["_change_type"] for r in C.diff_tables(old, new, ["k"]).collect())
    assert kinds == ["update_postimage", "update_preimage"]
    assert C.diff_tables(old, old, ["k"]).count() == 0


# ------------------------------------------------------------ unchanged versions, equal changes, digests
def _history(rows, compared):
    """Versions (key, value, start, end) of (key, value, sequence, delete) rows, runs of equal ones merged."""
    out = []
    for k in {r[0] for r in rows}:
        events, last = [], None
        for r in sorted({r for r in rows if r[0] == k}, key=lambda r: (r[2], r[3])):
            same = last is not None and last[3] == r[3] and (r[3] or not compared or last[1] == r[1])
            if not (compared and same):
                events.append(r)
            last = r
        for i, r in enumerate(events):
            if not r[3]:
                out.append((r[0], r[1], r[2], events[i + 1][2] if i + 1 < len(events) else None))
    return sorted(out, key=str)


def test_unchanged_versions_collapse_over_blocks(spark):
    """A third of all rows are one key's, whose runs are far longer than a block."""
    import random

    r = random.Random(6)
    rows, seq = [], 0
    for _ in range(40):
        value, gone = r.choice(["x", "y", None]), r.random() < 0.2
        for _ in range(r.choice([1, 2, 60])):
            seq += 1
            rows.append(("hot", value, seq, gone))
    rows += [(r.choice(["a", "b", "c", None]), r.choice(["x", None]), i, r.random() < 0.1) for i in range(2 * len(rows))]
    df = spark.createDataFrame(r.sample(rows, len(rows)), "k string, v string, seq int, gone boolean")
    for compared in (True, ["v"], False):
        for blocks in (1, 13):
            got = scd2(df, ["k"], "seq", "gone", except_columns=["gone"], blocks=blocks, collapse_unchanged=compared).collect()
            flat = [(x["k"], x["v"], x["__START_AT"]["seq"], None if x["__END_AT"] is None else x["__END_AT"]["seq"]) for x in got]
            assert sorted(flat, key=str) == _history(rows, bool(compared))
    assert scd2(df.limit(0), ["k"], "seq", "gone", collapse_unchanged=True).count() == 0


def test_equal_changes_are_reduced_before_they_travel(spark):
    """Half of all rows share a null key and sequence: what the range exchange reads is one row."""
    rows = spark.range(20000).selectExpr("IF(id % 2 = 0, NULL, id) AS k", "IF(id % 2 = 0, NULL, id) AS seq", "'v' AS v")
    out = scd2(rows, ["k"], "seq")
    assert out.count() == 10001
    from tessera.operators.ordered import ranges
    from tessera.operators.scd import IS_DELETE, SEQ, with_change_helpers

    staged = with_change_helpers(rows, "seq", None)
    plan = ranges(staged.groupBy("k", SEQ, IS_DELETE).count(), ["k", SEQ, IS_DELETE], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("rangepartitioning") < plan.index("hashpartitioning") < plan.index("partial_count")


def test_only_unequal_buckets_are_joined(spark):
    schema = "k long, v string, m map<string,int>"
    old = spark.createDataFrame([(i, f"v{i}", {"a": i}) for i in range(2000)] + [(None, None, None)], schema)
    new = old.filter("k is null or k not in (5, 700)").withColumn("v", F.when(F.col("k") == 9, "other").otherwise(F.col("v")))
    new = new.unionByName(spark.createDataFrame([(5000, "new", None)], schema))
    o, n, unequal = C.changed_buckets(old, new, ["k"], 500)
    assert unequal.count() <= 4 and o.count() < 40 and n.count() < 40
    want = sorted(map(str, C.change_feed(old, new, ["k"], 3, "2024-01-01 00:00:00").collect()))
    assert sorted(map(str, C.change_feed(old, new, ["k"], 3, "2024-01-01 00:00:00", buckets=500).collect())) == want and len(want) == 5
    assert sorted(map(str, C.diff_tables(old, new, ["k"], buckets=7).collect())) == sorted(map(str, C.diff_tables(old, new, ["k"]).collect()))
    assert C.change_feed(old, old, ["k"], 1, buckets=16).count() == 0
    assert C.change_feed(old.limit(0), old, ["k"], 1, buckets=16).count() == 2001
