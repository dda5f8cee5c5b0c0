"""Queries for streaming operators and the multi-hop tracks (STR-*, CDC-7/8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.operators.changes import CDF_COLUMNS, read_changes
from tessera.operators.scd import flatten_sequence
from tessera.plans import fixtures as X
from tessera.plans import flows
from tessera.plans import staging as S
from tessera.plans.q_cdc import EV, SCD1_DEL_SQL, SCD2_DEL_SQL, SCD2_OUT, SEQ
from tessera.plans.q_quality import DERIVED_SQL, EXPECT_SQL, STAFF, STAFF_CHANGES, TAG_SQL, TYPED_OUT, _changes_enforced
from tessera.plans.q_sources import RAW_SQL
from tessera.plans.registry import comparable, register
from tessera.session import scratch_path
from tessera.sinks.tables import append_table, run_to_completion, start_stream
from tessera.sources.files import csv_stream, stream_table
from tessera.streaming.history import scd2_stream
from tessera.operators.metrics import employee_metrics
from tessera.streaming.metrics import append_with_counts, expectation_totals, metric_stream
from tessera.streaming.state import StateTable, apply_stream, scd1_stream


def _event_stream(spark, sf, base, arrival="in_order"):
    """The events change log as a stream of 6 files of whole commits."""
    schema = S.write_change_log(spark, X.changes(spark, sf), f"{base}/log", files=6, arrival=arrival)
    return stream_table(spark, f"{base}/log", schema, maxFilesPerTrigger=1, recursiveFileLookup="true")


@register("str_scd1_stream", SCD1_DEL_SQL + f"SELECT {EV} FROM ranked WHERE rn = 1 AND _change_type <> 'delete'")
def str_scd1_stream(spark, sf):
    """SCD1 in the streaming state (six groups of commits) equals the batch SCD1 (STR-4)."""
    base = scratch_path(spark, "str_scd1")
    stream = _event_stream(spark, sf, base)
    query, table = scd1_stream(stream, f"{base}/ck", ["user_id"], SEQ, except_columns=CDF_COLUMNS, transform=read_changes)
    run_to_completion(query)
    return table.scd1()


def _event_history(spark, sf, name, arrival="in_order"):
    base = scratch_path(spark, name)
    stream = _event_stream(spark, sf, base, arrival)
    query, table = scd2_stream(
        stream, f"{base}/table", f"{base}/ck", ["user_id"], SEQ, "_change_type = 'delete'", CDF_COLUMNS, transform=read_changes
    )
    run_to_completion(query)
    return flatten_sequence(table.scd2())


@register("str_scd2_stream", SCD2_DEL_SQL + f"SELECT {SCD2_OUT} FROM hist")
def str_scd2_stream(spark, sf):
    """SCD2 history spliced together by micro-batches equals the batch history (STR-4)."""
    return _event_history(spark, sf, "str_scd2")


@register("str_out_of_order", SCD2_DEL_SQL + f"SELECT {SCD2_OUT} FROM hist")
def str_out_of_order(spark, sf):
    """Newest commits arrive first; late ones are spliced in where their sequence belongs (STR-5)."""
    return _event_history(spark, sf, "str_ooo", arrival="reversed")


@register("str_restart_resume", RAW_SQL)
def str_restart_resume(spark, sf):
    """Two runs on one checkpoint with files added between: every row exactly once (STR-3)."""
    base = scratch_path(spark, "str_restart")
    raw = X.staff_raw(spark, sf)
    S.write_csv(raw.filter(S.joined_before()), f"{base}/in/first", files=3)

    def run():
        s = csv_stream(spark, f"{base}/in", S.STAFF_FILE_SCHEMA, recursive=True, max_files=2)
        run_to_completion(append_table(s, f"{base}/out", f"{base}/ck"))

    run()
    S.write_csv(raw.filter(~S.joined_before()), f"{base}/in/second", files=3)
    run()
    run()  # nothing new: a no-op
    return comparable(spark.read.parquet(f"{base}/out"))


@register("str_expect_metrics", STAFF + EXPECT_SQL)
def str_expect_metrics(spark, sf):
    """Expectation pass/fail counts kept per micro-batch, summed over the run (STR-7)."""
    base = scratch_path(spark, "str_metrics")
    S.write_csv(X.staff(spark, sf), f"{base}/in", files=4)
    schema = X.staff(spark, sf).schema
    rules = {**Q.CURATED_DROP_RULES, **Q.CURATED_WARN_RULES}
    s = csv_stream(spark, f"{base}/in", schema, max_files=1)
    run_to_completion(append_with_counts(s, rules, f"{base}/out", f"{base}/counts", f"{base}/ck"))
    return expectation_totals(spark, f"{base}/counts")


LIVE_SQL = STAFF_CHANGES.rstrip() + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY empid ORDER BY upd_tmst DESC NULLS LAST, create_tmst DESC NULLS LAST, row_id DESC) AS rn
  FROM chg_enforced WHERE _change_type = 'delete' OR NOT _is_bad),
live AS (SELECT *, CAST(floor(datesub('month', joining_date, DATE '2001-12-15') / 12) AS BIGINT) AS tenure_y
  FROM ranked WHERE rn = 1 AND _change_type <> 'delete')
"""


@register(
    "agg_metric_from_changes",
    LIVE_SQL
    + """SELECT dept_id, count(*) AS employee_count, CAST(sum(salary) AS DOUBLE) AS total_salary,
      CAST(sum(salary) AS DOUBLE) / count(salary) AS avg_salary, avg(tenure_y) AS avg_tenure_years FROM live GROUP BY dept_id""",
)
def agg_metric_from_changes(spark, sf):
    """The metric view kept from a table's change feed equals the recomputed one after updates and deletes (AGG-9, SNK-2)."""
    base = scratch_path(spark, "agg_changes")
    good, _ = Q.split_enforced_changes(_changes_enforced(spark, sf))
    schema = S.write_change_log(spark, good, f"{base}/log", files=4)
    log = stream_table(spark, f"{base}/log", schema, maxFilesPerTrigger=1, recursiveFileLookup="true")
    table = StateTable(spark, f"{base}/staff", ["empid"], ["upd_tmst", "create_tmst", "row_id"], except_columns=CDF_COLUMNS)
    run_to_completion(apply_stream(log, table, f"{base}/ck", transform=read_changes, emit_changes=True))
    feed = stream_table(spark, table.changes_path, table.change_feed().schema, recursiveFileLookup="true")
    query, view = metric_stream(employee_metrics(log, as_of=X.AS_OF), feed, ["dept_id"], f"{base}/ck_view")
    run_to_completion(query)
    return comparable(view.read())


CURATED_LATEST_SQL = STAFF.rstrip() + """,
curated AS (SELECT * FROM staff WHERE dob IS NOT NULL AND empid IS NOT NULL AND salary > 0),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY empid
    ORDER BY upd_tmst DESC NULLS LAST, create_tmst DESC NULLS LAST, row_id DESC) AS rn FROM curated) WHERE rn = 1)
"""


@register("str_medallion", CURATED_LATEST_SQL + f"SELECT row_id, {TYPED_OUT}, {DERIVED_SQL} FROM latest")
def str_medallion(spark, sf):
    """CSV -> raw -> silver -> curated -> gold, each layer streaming from the last (STR-6)."""
    base = scratch_path(spark, "str_medallion")
    S.write_csv(X.staff_raw(spark, sf), f"{base}/files", files=6)
    gold = flows.run_primary(
        spark, f"{base}/files", S.STAFF_CSV_SCHEMA, X.SILVER_SCHEMA, f"{base}/tables", as_of=X.AS_OF,
        order_desc=("upd_tmst", "create_tmst", "row_id"),
    )
    return comparable(gold)


# Commits of three neighbouring rows: some clean, some with an update or a delete.
def three_row_commits(spark, sf):
    return X.staff_changes(spark, sf).withColumn("_commit_version", F.floor(F.col("row_id") / 3).cast("bigint"))


IGNORE_SQL = STAFF_CHANGES.rstrip() + """,
clean AS (SELECT * FROM chg_enforced WHERE row_id // 3 IN
    (SELECT row_id // 3 FROM staff_changes GROUP BY 1 HAVING bool_and(_change_type = 'insert'))),
curated AS (SELECT * FROM clean WHERE NOT _is_bad AND dob IS NOT NULL AND empid IS NOT NULL AND salary > 0),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY empid
    ORDER BY upd_tmst DESC NULLS LAST, create_tmst DESC NULLS LAST, row_id DESC) AS rn FROM curated) WHERE rn = 1)
"""


@register("cdc_ignore_hops", IGNORE_SQL + f"SELECT row_id, {TYPED_OUT}, {DERIVED_SQL} FROM latest")
def cdc_ignore_hops(spark, sf):
    """Ignore-changes track: update/delete commits skipped, layers keep old rows (CDC-8).

    Each commit's rows are spread over three files and the stream takes one
    file at a time."""
    base = scratch_path(spark, "cdc_ignore")
    schema = S.write_change_log(spark, three_row_commits(spark, sf), f"{base}/log", files=3, parts=3)
    gold = flows.run_ignore(
        spark, f"{base}/log", schema, X.SILVER_SCHEMA, f"{base}/tables", as_of=X.AS_OF,
        order_desc=("upd_tmst", "create_tmst", "row_id"),
    )
    return comparable(gold)


def propagate(spark, sf, name="cdc_propagate", arrival="in_order", files=6, changes=None, parts=1, **how):
    base = scratch_path(spark, name)
    log = X.staff_changes(spark, sf) if changes is None else changes
    schema = S.write_change_log(spark, log, f"{base}/log", files=files, arrival=arrival, parts=parts)
    return flows.run_propagate(
        spark, f"{base}/log", schema, X.SILVER_SCHEMA, f"{base}/tables", as_of=X.AS_OF,
        silver_sequence=("upd_tmst", "create_tmst", "row_id"), **how,
    )


# One row per commit.  o numbers the rows by silver sequence, so a running max of o
# names the row that is the key's state after each commit; feeds are its changes.
FEED_SQL = STAFF_CHANGES.rstrip() + """,
good AS (SELECT *, row_number() OVER (ORDER BY upd_tmst NULLS FIRST, create_tmst NULLS FIRST, row_id) AS o
  FROM chg_enforced WHERE _change_type = 'delete' OR NOT _is_bad),
st AS (SELECT empid, _commit_version AS v,
    max(o) OVER (PARTITION BY empid ORDER BY _commit_version ROWS UNBOUNDED PRECEDING) AS a,
    max(o) OVER (PARTITION BY empid ORDER BY _commit_version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM good),
live AS (SELECT st.*, ra._change_type <> 'delete' AS al, coalesce(rb._change_type <> 'delete', FALSE) AS bl
  FROM st JOIN good ra ON ra.o = st.a LEFT JOIN good rb ON rb.o = st.b),
feed1 AS (SELECT v, CASE WHEN al THEN a ELSE b END AS o, NOT al AS del FROM live WHERE (al AND a IS DISTINCT FROM b) OR (bl AND NOT al))"""
PROPAGATE_SQL = FEED_SQL + f""",
gated AS (SELECT feed1.v, feed1.o, feed1.del, g.empid FROM feed1 JOIN good g ON g.o = feed1.o
  WHERE feed1.del OR (g.dob IS NOT NULL AND g.empid IS NOT NULL AND g.salary > 0)),
cur AS (SELECT *, lag(o) OVER w AS b, coalesce(NOT lag(del) OVER w, FALSE) AS bl FROM gated WINDOW w AS (PARTITION BY empid ORDER BY v)),
feed2 AS (SELECT v, CASE WHEN del THEN b ELSE o END AS o, del FROM cur WHERE (NOT del AND NOT (bl AND b = o)) OR (del AND bl)),
gold AS (SELECT g.*, feed2.v, feed2.del, lead(g.upd_tmst) OVER w AS nu, lead(g.create_tmst) OVER w AS nc, lead(feed2.v) OVER w AS nv
  FROM feed2 JOIN good g ON g.o = feed2.o
  WINDOW w AS (PARTITION BY g.empid ORDER BY g.upd_tmst NULLS FIRST, g.create_tmst NULLS FIRST, feed2.v, feed2.del))
SELECT row_id, {TYPED_OUT}, {DERIVED_SQL}, CAST(upd_tmst AS VARCHAR) AS __START_AT_upd_tmst, CAST(create_tmst AS VARCHAR) AS __START_AT_create_tmst,
  v AS __START_AT__commit_version, CAST(nu AS VARCHAR) AS __END_AT_upd_tmst, CAST(nc AS VARCHAR) AS __END_AT_create_tmst,
  nv AS __END_AT__commit_version
FROM gold WHERE NOT del"""


@register("cdc_propagate_hops", PROPAGATE_SQL)
def cdc_propagate_hops(spark, sf):
    """Raw change log -> silver SCD1 -> curated SCD1 -> gold SCD2 through change feeds (CDC-7)."""
    t = propagate(spark, sf)
    return comparable(flatten_sequence(t.gold.scd2()))


def _manual_sql(side):
    """The last change of each key on one side of the quarantine; deletes reach both sides."""
    return FEED_SQL + f""",
tagged AS (SELECT *, {TAG_SQL} AS quarantine_reason FROM (SELECT g.*, f.v, f.del FROM feed1 f JOIN good g ON g.o = f.o)),
target AS (SELECT *, row_number() OVER (PARTITION BY empid ORDER BY v DESC) AS rn FROM tagged WHERE del OR length(quarantine_reason) {side} 0)
SELECT row_id, {TYPED_OUT} FROM target WHERE rn = 1 AND NOT del"""


@register("dq_propagate_manual_curated", _manual_sql("="))
def dq_propagate_manual_curated(spark, sf):
    """Quarantine staging by change feeds, its good target: a row that turned bad leaves its last good version (DQ-8)."""
    t = propagate(spark, sf, "dq_manual_curated")
    return comparable(t.manual_curated.scd1().select("row_id", *X.SILVER_COLUMNS))


@register("dq_propagate_manual_bad", _manual_sql(">"))
def dq_propagate_manual_bad(spark, sf):
    """The same branch's quarantine target (DQ-8)."""
    t = propagate(spark, sf, "dq_manual_bad")
    return comparable(t.manual_bad.scd1().select("row_id", *X.SILVER_COLUMNS))


@register("str_processing_time", RAW_SQL)
def str_processing_time(spark, sf):
    """A processingTime trigger: batches of two files a second until all files are in, then stopped (STR-2)."""
    base = scratch_path(spark, "str_processing")
    S.write_csv(X.staff_raw(spark, sf), f"{base}/in", files=4)
    rows = csv_stream(spark, f"{base}/in", S.STAFF_FILE_SCHEMA, max_files=2)
    query = start_stream(rows, f"{base}/out", f"{base}/ck", trigger="processingTime", interval="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return comparable(spark.read.parquet(f"{base}/out"))
