"""Streaming forms equal their batch twins; the propagate track equals a replay."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import changes as C
from tessera.operators.scd import scd1, scd2
from tessera.plans import fixtures as X
from tessera.plans import flows
from tessera.plans import staging as S
from tessera.sinks.tables import run_to_completion
from tessera.sources.files import stream_table
from tessera.streaming.history import HistoryTable
from tessera.streaming.state import StateTable, apply_stream, scd1_stream

SEQ = ["ts", "event_id"]


def _stream_events(spark, tmp, arrival):
    ch = X.changes(spark, SMALL)
    schema = S.write_change_log(spark, ch, f"{tmp}/log", files=5, arrival=arrival)
    stream = lambda: stream_table(spark, f"{tmp}/log", schema, maxFilesPerTrigger=1, recursiveFileLookup="true")
    query, table = scd1_stream(stream(), f"{tmp}/ck1", ["user_id"], SEQ, except_columns=C.CDF_COLUMNS, transform=C.read_changes)
    run_to_completion(query)
    history = HistoryTable(spark, f"{tmp}/h", ["user_id"], SEQ, except_columns=C.CDF_COLUMNS)
    run_to_completion(apply_stream(stream(), history, f"{tmp}/ck2", transform=C.read_changes))
    return ch, table, history, query


def test_stream_equals_batch_for_any_arrival(spark, tmp):
    for arrival in ("in_order", "reversed", "interleaved"):
        ch, table, history, q = _stream_events(spark, f"{tmp}/{arrival}", arrival)
        assert len([p for p in q.recentProgress if p.numInputRows > 0]) == 5
        batch1 = scd1(C.read_changes(ch), ["user_id"], SEQ, except_columns=C.CDF_COLUMNS)
        assert sorted(table.scd1().collect()) == sorted(batch1.collect())
        batch2 = scd2(C.read_changes(ch), ["user_id"], SEQ, "_change_type = 'delete'", C.CDF_COLUMNS)
        assert sorted(history.scd2().collect()) == sorted(batch2.collect())


def test_replayed_batches_change_nothing(spark, tmp):
    ch = C.read_changes(X.changes(spark, SMALL))
    first, second = ch.filter("event_id < 3000"), ch.filter("event_id >= 3000")
    t = StateTable(spark, f"{tmp}/t", ["user_id"], SEQ, except_columns=C.CDF_COLUMNS)
    h = HistoryTable(spark, f"{tmp}/h", ["user_id"], SEQ, except_columns=C.CDF_COLUMNS)
    for table in (t, h):
        table.apply(second, 0)  # late rows come last
        table.apply(first, 1)
    want1 = sorted(scd1(ch, ["user_id"], SEQ, except_columns=C.CDF_COLUMNS).collect())
    want2 = sorted(scd2(ch, ["user_id"], SEQ, "_change_type = 'delete'", C.CDF_COLUMNS).collect())
    assert sorted(t.scd1().collect()) == want1 and sorted(h.scd2().collect()) == want2
    for table in (t, h):
        table.apply(first, 1)  # a retried micro-batch
        table.apply(second, 0)
    assert sorted(t.scd1().collect()) == want1 and sorted(h.scd2().collect()) == want2


def test_a_restarted_stream_goes_on_from_its_state(spark, tmp):
    ch = C.read_changes(X.changes(spark, SMALL))
    first = ch.filter("event_id < 3000")
    first.write.parquet(f"{tmp}/log/a")

    def run():
        log = stream_table(spark, f"{tmp}/log", ch.schema, recursiveFileLookup="true")
        query, table = scd1_stream(log, f"{tmp}/ck", ["user_id"], SEQ, except_columns=C.CDF_COLUMNS)
        run_to_completion(query)
        return table

    before = sorted(run().scd1().collect())
    assert before == sorted(scd1(first, ["user_id"], SEQ, except_columns=C.CDF_COLUMNS).collect())
    ch.filter("event_id >= 3000").write.parquet(f"{tmp}/log/b")
    table = run()
    assert sorted(run().scd1().collect()) == sorted(scd1(ch, ["user_id"], SEQ, except_columns=C.CDF_COLUMNS).collect())
    # the state as of the first batch can still be read
    from tessera.operators.scd import scd1_view

    assert sorted(scd1_view(table.state(0)).collect()) == before


def test_a_crash_between_feed_and_log_is_repaired(spark, tmp):
    from tessera.session import fs_delete

    schema = "k string, v string, seq int, _change_type string"
    t = StateTable(spark, f"{tmp}/t", ["k"], "seq", except_columns=["_change_type"])
    t.apply(spark.createDataFrame([("a", "1", 1, "insert")], schema), 0, emit_changes=True)
    late = spark.createDataFrame([("a", "2", 2, "update_postimage"), ("b", "1", 2, "insert")], schema)
    t.apply(late, 1, emit_changes=True)
    want = sorted(map(str, t.change_feed().drop("_commit_timestamp").collect()))
    fs_delete(spark, f"{tmp}/t/log/batch_id=1")  # as if the run had died before the log was written
    t.apply(late, 1, emit_changes=True)
    assert sorted(map(str, t.change_feed().drop("_commit_timestamp").collect())) == want
    t.apply(late, 1, emit_changes=True)  # and a replay of a whole batch
    assert sorted(map(str, t.change_feed().drop("_commit_timestamp").collect())) == want
    assert sorted((r["k"], r["v"]) for r in t.scd1().collect()) == [("a", "2"), ("b", "1")]


def test_late_changes_touch_their_neighbours_only(spark, tmp):
    """The rows that are put in order are the batch's and at most two more for each of its keys."""
    schema = "k long, v string, seq long, gone boolean"
    rows = [(k, f"v{k}-{s}", s, False) for k in range(50) for s in range(0, 200, 10)]
    h = HistoryTable(spark, f"{tmp}/h", ["k"], "seq", "gone")
    h.apply(spark.createDataFrame(rows, schema), 0)
    late = [(3, "late", 55, False), (3, "later", 57, True), (7, "first", -5, False), (9, "last", 500, False), (99, "new", 1, False)]
    from tessera.operators.scd import with_change_helpers

    batch = with_change_helpers(spark.createDataFrame(late, schema), "seq", "gone")
    near = h.neighbourhood(batch, 1).select("k", "__seq.seq", "__new").collect()
    assert sorted(map(tuple, near)) == [
        (3, 50, False), (3, 55, True), (3, 57, True), (3, 60, False), (7, -5, True), (7, 0, False),
        (9, 190, False), (9, 500, True), (99, 1, True),
    ]
    h.apply(spark.createDataFrame(late, schema), 1)
    written = spark.read.parquet(f"{tmp}/h/versions/batch_id=1")
    assert sorted((r["k"], r["__seq"]["seq"]) for r in written.filter("NOT __new").collect()) == [(3, 50), (9, 190)]
    want = scd2(spark.createDataFrame(rows + late, schema), ["k"], "seq", "gone")
    assert sorted(h.scd2().collect()) == sorted(want.collect())


def test_history_of_any_batches_equals_the_batch_history(spark, tmp):
    """Random cuts and orders, null keys and sequences, ties, deletes, changes that are sent again."""
    import random

    r = random.Random(8)
    schema = "k string, v int, seq int, gone boolean"
    rows = [(r.choice(["a", "b", None]), r.randrange(5), r.choice([None, *range(12)]), r.random() < 0.2) for _ in range(120)]
    want = sorted(map(str, scd2(spark.createDataFrame(rows, schema), ["k"], "seq", "gone").collect()))
    for turn in range(2):
        h = HistoryTable(spark, f"{tmp}/{turn}", ["k"], "seq", "gone", blocks=3)
        left = r.sample(rows, len(rows))
        sent = []
        for batch_id in range(4):
            part, left = left[:30], left[30:]
            again = r.sample(sent, min(5, len(sent)))
            sent += part
            h.apply(spark.createDataFrame(part + again, schema), batch_id)
        assert sorted(map(str, h.scd2().collect())) == want


def test_emitted_change_feed(spark, tmp):
    schema = "k string, v string, seq int, _change_type string"
    t = StateTable(spark, f"{tmp}/t", ["k"], "seq", except_columns=["_change_type"])
    t.apply(spark.createDataFrame([("a", "1", 1, "insert"), ("b", "1", 1, "insert")], schema), 0, emit_changes=True)
    t.apply(spark.createDataFrame([("a", "2", 2, "update_postimage"), ("b", "1", 2, "delete"), ("c", "1", 2, "insert")], schema), 1, emit_changes=True)
    feed = {(r["_commit_version"], r["k"], r["v"], r["_change_type"]) for r in t.change_feed().collect()}
    assert feed == {
        (0, "a", "1", "insert"), (0, "b", "1", "insert"),
        (1, "a", "1", "update_preimage"), (1, "a", "2", "update_postimage"),
        (1, "b", "1", "delete"), (1, "c", "1", "insert"),
    }


# ------------------------------------------------------------- propagate replay
def _row(rid, empid, dob, salary, upd, create="1/1/2020", dept="D1", ctype="insert"):
    return (rid, empid, f"N{rid}", dob, None if salary is None else Decimal(salary), "1/1/2019", dept, create, upd, ctype)


# each inner list is one commit (one file, one micro-batch)
COMMITS = [
    [_row(1, "E1", "1/1/1990", "100.00", "1/2/2020"), _row(2, "E2", "2/2/1991", "200.00", "1/2/2020"),
     _row(3, "E3", "3/3/1992", "300.00", "1/2/2020", create="11/2020/2019"), _row(4, "E4", "4/4/1993", "0.00", "1/2/2020")],
    [_row(5, "E1", "1/1/1990", "110.00", "1/3/2020", ctype="update_postimage"),
     _row(6, "E2", "2/2/1991", "200.00", "1/2/2020", ctype="delete"), _row(7, "E6", "6/6/1996", "60.00", "1/3/2020")],
    [_row(8, "E4", "4/4/1993", "400.00", "1/4/2020", ctype="update_postimage"), _row(9, "E5", "5/5/1995", "500.00", "1/4/2020"),
     _row(10, "E6", "6/6/1996", "61.00", "1/2/2020", ctype="update_postimage")],  # E6 arrives late: older sequence
    [_row(11, "E1", "1/1/1990", "0.00", "1/5/2020", ctype="update_postimage"), _row(12, "E5", "5/5/1995", "500.00", "1/4/2020", ctype="delete"),
     _row(13, "E7", None, "70.00", "1/5/2020")],
    [_row(14, "E2", "2/2/1991", "210.00", "1/6/2020"), _row(15, "E4", "4/4/1993", "410.00", "1/6/2020", ctype="update_postimage")],
]
RAW_CH_SCHEMA = T.StructType(
    [T.StructField("row_id", T.LongType()), *[f for f in X.RAW_SCHEMA.fields if f.name != "_corrupt_record"],
     T.StructField("_change_type", T.StringType()), T.StructField("_commit_version", T.LongType()),
     T.StructField("_commit_timestamp", T.TimestampType())]
)


def _parse(s):
    if s is None:
        return None, False
    try:
        m, d_, y = (int(x) for x in s.split("/"))
        return dt.date(y, m, d_), False
    except ValueError:
        return None, True


def _replay():
    """Commit-by-commit model of the three hops; returns the gold history."""
    silver, curated, gold_log = {}, {}, []

    def fold(state, key, seq, is_del, row):
        cur = state.get(key)
        if cur is None or (seq, is_del) > (cur[0], cur[1]):
            state[key] = (seq, is_del, row)

    def view(entry):
        return None if entry is None or entry[1] else entry[2]

    def diff(before, after):
        out = []
        for k in sorted(after, key=str):
            b, a = view(before.get(k)), view(after.get(k))
            if b is None and a is not None:
                out.append(("insert", a))
            elif b is not None and a is None:
                out.append(("delete", b))
            elif b is not None and a != b:
                out.append(("update_postimage", a))
        return out

    for ci, commit in enumerate(COMMITS):
        # hop 1: enforce; good rows and deletes fold into silver
        keys = set()
        staged = []
        for rid, empid, name, dob, sal, join, dept, create, upd, ctype in commit:
            (dob_d, b1), (join_d, b2), (cr_d, b3), (up_d, b4) = _parse(dob), _parse(join), _parse(create), _parse(upd)
            row = (rid, empid, name, dob_d, sal, join_d, dept, cr_d, up_d)
            if ctype == "delete" or not (b1 or b2 or b3 or b4):
                staged.append((empid, (up_d, cr_d), ctype == "delete", row))
                keys.add(empid)
        before = {k: silver.get(k) for k in keys}
        for k, seq, is_del, row in staged:
            fold(silver, k, seq, is_del, row)
        feed = diff(before, {k: silver.get(k) for k in keys})
        # hop 2: gate (deletes pass), fold into curated by silver commit
        keys2 = set()
        before2 = {}
        for ctype, row in feed:
            k = row[1]
            ok = ctype == "delete" or (row[3] is not None and row[1] is not None and row[4] is not None and row[4] > 0)
            if ok:
                before2.setdefault(k, curated.get(k))
                fold(curated, k, (ci,), ctype == "delete", row)
                keys2.add(k)
        # hop 3: gold SCD2 log of the curated feed
        for ctype, row in diff(before2, {k: curated.get(k) for k in keys2}):
            gold_log.append((row[1], (row[8], row[7]), ctype == "delete", row))
    hist = set()
    for k in {e[0] for e in gold_log}:
        events = sorted([e for e in gold_log if e[0] == k], key=lambda e: (e[1], e[2]))
        for i, (_, seq, is_del, row) in enumerate(events):
            if not is_del:
                nxt = events[i + 1][1] if i + 1 < len(events) else None
                hist.add((k, row[0], seq, nxt))
    return hist


def test_propagate_matches_replay(spark, tmp):
    base = f"{tmp}/prop"
    for ci, commit in enumerate(COMMITS):
        rows = [(*r, ci, dt.datetime(2024, 1, 1, 0, ci)) for r in commit]
        spark.createDataFrame(rows, RAW_CH_SCHEMA).coalesce(1).write.parquet(f"{base}/log/c{ci}")
        t = flows.run_propagate(spark, f"{base}/log", RAW_CH_SCHEMA, X.SILVER_SCHEMA, f"{base}/tables", as_of="2024-06-15")
    got = set()
    for r in t.gold.scd2().collect():
        s, e = r["__START_AT"], r["__END_AT"]
        got.add((r["empid"], r["row_id"], (s["upd_tmst"], s["create_tmst"]), None if e is None else (e["upd_tmst"], e["create_tmst"])))
    assert got == _replay()
    # the stale-row rule: E1's last change fails the gate, curated keeps the older good row
    cur = {r["empid"]: r for r in t.curated.scd1().collect()}
    assert cur["E1"]["salary"] == Decimal("110.00")
    assert "E5" not in cur and "E3" not in cur and "E7" not in cur
    assert {r["empid"] for r in t.silver_bad.scd1().collect()} == {"E3"}
    gold_cols = t.gold.scd2().columns
    assert {"age", "tenure_years", "salary_band"} <= set(gold_cols)
    # quarantine branch: rows that changed side leave a stale row behind
    manual = {r["empid"] for r in t.manual_curated.scd1().collect()}
    manual_bad = {r["empid"] for r in t.manual_bad.scd1().collect()}
    assert manual == {"E1", "E2", "E4", "E6"}
    assert manual_bad == {"E1", "E4", "E7"}
    staged = {r["empid"]: r["quarantine_reason"] for r in t.staging.scd1().collect()}
    assert staged["E1"] == "valid_salary" and staged["E4"] == "" and staged["E7"] == "valid_dob"
    assert "quarantine_reason" not in t.manual_curated.scd1().columns


def test_propagation_does_not_depend_on_batch_cuts(spark):
    from tessera.operators.scd import flatten_sequence
    from tessera.plans.q_streaming import propagate, three_row_commits

    log = three_row_commits(spark, SMALL).persist()
    outcomes = []
    for i, (files, parts) in enumerate([(1, 1), (3, 2)]):
        t = propagate(spark, SMALL, f"cuts{i}", files=files, parts=parts, changes=log, quarantine=False)
        outcomes.append((sorted(map(str, flatten_sequence(t.gold.scd2()).collect())), sorted(map(str, t.curated.scd1().collect()))))
    log.unpersist()
    assert outcomes[0] == outcomes[1]
    # the recomputed view holds the curated keys as they are now
    assert sorted(map(str, t.gold_view.select("empid").collect())) == sorted(map(str, t.curated.scd1().select("empid").collect()))


def test_strict_stream_raises(spark, tmp):
    import pytest

    from tessera.sinks.tables import append_table

    schema = S.write_change_log(spark, X.changes(spark, SMALL), f"{tmp}/log", files=2)
    log = stream_table(spark, f"{tmp}/log", schema, recursiveFileLookup="true")
    with pytest.raises(Exception, match="non-append change"):
        run_to_completion(append_table(C.assert_append_only(log).drop("_change_type"), f"{tmp}/out", f"{tmp}/ck"))


def test_a_batch_with_a_new_column_is_merged_by_name(spark, tmp):
    schema = "k string, v string, seq int, _change_type string"
    rows = spark.createDataFrame([("a", "1", 1, "insert"), ("b", "1", 1, "insert")], schema)
    t = StateTable(spark, f"{tmp}/t", ["k"], "seq", except_columns=["_change_type"])
    h = HistoryTable(spark, f"{tmp}/h", ["k"], "seq", except_columns=["_change_type"])
    wide = rows.filter("k = 'a'").withColumn("more", F.lit("x")).withColumn("seq", F.lit(2))
    for table, how in ((t, {"emit_changes": True}), (h, {})):
        table.apply(rows, 0, **how)
        table.apply(wide, 1, **how)
    assert sorted((r["k"], r["more"]) for r in t.scd1().collect()) == [("a", "x"), ("b", None)]
    assert sorted((r["k"], r["more"] or "") for r in h.scd2().collect()) == [("a", ""), ("a", "x"), ("b", "")]


def test_observed_expectations_on_a_stream(spark, tmp):
    from tessera.plans.catalog import QUERIES

    got = {r["rule"]: (r["passed"], r["failed"]) for r in QUERIES["str_expect_metrics"](spark, SMALL).collect()}
    staff = X.staff(spark, SMALL)
    assert got["valid_empid"][0] + got["valid_empid"][1] == staff.count()
    assert got["valid_dob"][1] == staff.filter(F.col("dob").isNull()).count()


def test_processing_time_trigger_and_sinks(spark, tmp):
    from tessera.session import fs_write_text
    from tessera.sinks.tables import start_stream
    from tessera.sources.files import csv_stream

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType())])
    for i in range(3):
        fs_write_text(spark, f"{tmp}/in/f{i}.csv", f"id,v\n{i},x{i}\n")
    src = csv_stream(spark, f"{tmp}/in", schema, max_files=1)
    q = start_stream(src, f"{tmp}/json", f"{tmp}/ck1", fmt="json", trigger="processingTime", interval="1 second", name="json_sink")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert q.name == "json_sink"
    assert sorted(r["id"] for r in spark.read.schema(schema).json(f"{tmp}/json").collect()) == ["0", "1", "2"]
    name = f"t_{abs(hash(tmp)) % 10**8}"
    q2 = start_stream(csv_stream(spark, f"{tmp}/in", schema), None, f"{tmp}/ck2", table=name)
    run_to_completion(q2)
    assert spark.table(name).count() == 3


def test_foreach_row_sink(spark, tmp):
    import glob
    import tempfile

    from tessera.session import fs_write_text
    from tessera.sinks.tables import foreach_row
    from tessera.sources.files import csv_stream

    class LineWriter:
        """Appends each row's id to a per-partition file (a per-row side effect)."""

        def __init__(self, path):
            self.path = path

        def open(self, partition_id, epoch_id):
            import os

            os.makedirs(self.path, exist_ok=True)
            self.f = open(f"{self.path}/p{partition_id}-e{epoch_id}.txt", "w")
            return True

        def process(self, row):
            self.f.write(f"{row['id']}\n")

        def close(self, error):
            self.f.close()

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType())])
    for i in range(3):
        fs_write_text(spark, f"{tmp}/in/f{i}.csv", f"id,v\n{i},x\n")
    out = tempfile.mkdtemp(prefix="tessera-foreach-")  # local side-effect target of this test only
    run_to_completion(foreach_row(csv_stream(spark, f"{tmp}/in", schema), LineWriter(out), f"{tmp}/ck"))
    ids = sorted(line.strip() for p in glob.glob(f"{out}/*.txt") for line in open(p) if line.strip())
    assert ids == ["0", "1", "2"]


def test_primary_track_side_outputs(spark, tmp):
    from tessera.operators import quality as Q

    raw = X.staff_raw(spark, SMALL)
    S.write_csv(raw, f"{tmp}/files", files=3)
    gold = flows.run_primary(spark, f"{tmp}/files", S.STAFF_CSV_SCHEMA, X.SILVER_SCHEMA, f"{tmp}/tables", as_of=X.AS_OF)
    read = lambda name: spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp}/tables/{name}")
    enforced = X.staff_enforced(spark, SMALL)
    assert read("silver").count() == Q.good_rows(enforced).count()
    assert sorted(r["row_id"] for r in read("silver_bad").collect()) == sorted(
        r["row_id"] for r in Q.bad_rows(enforced).collect()
    )
    staff = X.staff(spark, SMALL)
    assert read("curated").count() == Q.expect_or_drop(staff, Q.CURATED_DROP_RULES).count()
    bad = {r["row_id"]: r["failure_reason"] for r in read("curated_bad").collect()}
    want = {r["row_id"]: r["failure_reason"] for r in Q.quarantine_complement(staff, Q.CURATED_DROP_RULES).collect()}
    assert bad == want
    assert gold.count() == read("curated").select("empid").distinct().count()
    ok, quarantined = Q.split_quarantine(Q.tag_violations(staff))
    assert read("curated_manual").count() == ok.count() and read("curated_manual_bad").count() == quarantined.count()
    counts = spark.read.parquet(f"{tmp}/tables/curated_counts").groupBy("rule").agg(F.sum("passed").alias("p"), F.sum("failed").alias("f"))
    want_counts = Q.expectation_counts(staff, {**Q.CURATED_DROP_RULES, **Q.CURATED_WARN_RULES})
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, want_counts.collect()))
    history = flows.gold_history(spark, f"{tmp}/tables").scd2()
    assert {r["empid"] for r in history.filter("__END_AT IS NULL").collect()} == {r["empid"] for r in read("curated").collect()}
