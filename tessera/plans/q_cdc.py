"""Queries for change-data operators (SRC-14..16, CDC-1..10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import changes as C
from tessera.operators.derive import latest_per_key
from tessera.operators.scd import (
    flatten_sequence,
    gc_tombstones,
    scd1,
    scd1_state,
    scd2,
    scd2_current,
    with_change_helpers,
)
from tessera.plans import fixtures as X
from tessera.plans import staging as S
from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sinks.tables import append_table, run_to_completion
from tessera.sources.files import stream_table

CHG = X.with_ctes(X.SQL_CHANGES)
EV = "event_id, ts, user_id, event_type, value, props"
EV_CDF = EV + ", _change_type, _commit_version, _commit_timestamp"
SEQ = ["ts", "event_id"]
CH_FILTER = "_change_type IN ('insert', 'update_postimage', 'delete')"
UPSERTS = "_change_type IN ('insert', 'update_postimage')"


def _changes(spark, sf):
    return C.read_changes(X.changes(spark, sf))


@register("cdc_read_changes", CHG + f"SELECT {EV_CDF} FROM changes WHERE {CH_FILTER}")
def cdc_read_changes(spark, sf):
    return _changes(spark, sf)


@register(
    "cdc_skip_change_commits",
    CHG
    + f"""SELECT {EV_CDF} FROM changes WHERE _commit_version IN
      (SELECT _commit_version FROM changes GROUP BY 1 HAVING bool_and(_change_type = 'insert'))""",
)
def cdc_skip_change_commits(spark, sf):
    return C.skip_change_commits(X.changes(spark, sf))


@register(
    "src_strict_append",
    CHG
    + f"""SELECT {EV_CDF} FROM changes WHERE _commit_version IN
      (SELECT _commit_version FROM changes GROUP BY 1 HAVING bool_and(_change_type = 'insert'))""",
)
def src_strict_append(spark, sf):
    """A stream over an append-only log passes the strict check untouched (SRC-14).

    The same check raises on any update or delete (see tests)."""
    base = scratch_path(spark, "strict_append")
    schema = S.write_change_log(spark, C.skip_change_commits(X.changes(spark, sf)), f"{base}/log", files=4)
    log = stream_table(spark, f"{base}/log", schema, maxFilesPerTrigger=2, recursiveFileLookup="true")
    run_to_completion(append_table(C.assert_append_only(log), f"{base}/out", f"{base}/ck"))
    return spark.read.schema(schema).parquet(f"{base}/out")


@register(
    "cdc_scd1_upsert",
    CHG
    + f"""SELECT {EV_CDF} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM changes WHERE {UPSERTS}) WHERE rn = 1""",
)
def cdc_scd1_upsert(spark, sf):
    ups = X.changes(spark, sf).filter(F.col("_change_type").isin("insert", "update_postimage"))
    return scd1(ups, ["user_id"], SEQ, apply_as_deletes=None)


SCD1_DEL_SQL = CHG.rstrip() + f""",
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY ts DESC, event_id DESC, (_change_type = 'delete') DESC) AS rn FROM changes WHERE {CH_FILTER})
"""


@register("cdc_scd1_deletes", SCD1_DEL_SQL + f"SELECT {EV} FROM ranked WHERE rn = 1 AND _change_type <> 'delete'")
def cdc_scd1_deletes(spark, sf):
    return scd1(_changes(spark, sf), ["user_id"], SEQ, except_columns=C.CDF_COLUMNS)


@register(
    "cdc_tombstone_gc",
    SCD1_DEL_SQL
    + """, st AS (SELECT * FROM ranked WHERE rn = 1)
    SELECT user_id, event_id, ts, _change_type = 'delete' AS deleted FROM st
    WHERE _change_type <> 'delete' OR ts >= (SELECT max(ts) FROM st) - INTERVAL 7 DAY""",
)
def cdc_tombstone_gc(spark, sf):
    """Tombstones older than 7 days before the newest change are dropped (CDC-9)."""
    staged = with_change_helpers(_changes(spark, sf), SEQ, except_columns=C.CDF_COLUMNS)
    kept = gc_tombstones(scd1_state(staged, ["user_id"]), "ts", 7 * 24 * 3600)
    return kept.select("user_id", "event_id", "ts", F.col("__is_delete").alias("deleted"))


SCD2_OUT = f"{EV}, ts AS __START_AT_ts, event_id AS __START_AT_event_id, nts AS __END_AT_ts, nid AS __END_AT_event_id"


@register(
    "cdc_scd2_history",
    CHG
    + f"""SELECT {SCD2_OUT} FROM (SELECT *,
      lead(ts) OVER w AS nts, lead(event_id) OVER w AS nid FROM changes WHERE {UPSERTS}
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""",
)
def cdc_scd2_history(spark, sf):
    ups = X.changes(spark, sf).filter(F.col("_change_type").isin("insert", "update_postimage"))
    return flatten_sequence(scd2(ups, ["user_id"], SEQ, except_columns=C.CDF_COLUMNS))


SCD2_DEL_SQL = CHG.rstrip() + f""",
hist AS (SELECT * FROM (SELECT *, lead(ts) OVER w AS nts, lead(event_id) OVER w AS nid
    FROM changes WHERE {CH_FILTER}
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id, (_change_type = 'delete')))
  WHERE _change_type <> 'delete')
"""


def _scd2_deletes(spark, sf):
    return flatten_sequence(
        scd2(_changes(spark, sf), ["user_id"], SEQ, apply_as_deletes="_change_type = 'delete'", except_columns=C.CDF_COLUMNS)
    )


@register("cdc_scd2_deletes", SCD2_DEL_SQL + f"SELECT {SCD2_OUT} FROM hist")
def cdc_scd2_deletes(spark, sf):
    return _scd2_deletes(spark, sf)


@register("cdc_scd2_current", SCD2_DEL_SQL + f"SELECT {SCD2_OUT} FROM hist WHERE nts IS NULL")
def cdc_scd2_current(spark, sf):
    h = scd2(_changes(spark, sf), ["user_id"], SEQ, apply_as_deletes="_change_type = 'delete'", except_columns=C.CDF_COLUMNS)
    return flatten_sequence(scd2_current(h))


@register(
    "cdc_scd2_collapsed",
    CHG.rstrip()
    + f""",
ev AS (SELECT *, _change_type = 'delete' AS del, lag(_change_type = 'delete') OVER w AS pdel, lag(event_type) OVER w AS ptype
  FROM changes WHERE {CH_FILTER} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id, (_change_type = 'delete'))),
runs AS (SELECT * FROM ev WHERE pdel IS NULL OR del <> pdel OR (NOT del AND event_type IS DISTINCT FROM ptype)),
hist AS (SELECT * FROM (SELECT *, lead(ts) OVER w AS nts, lead(event_id) OVER w AS nid FROM runs
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id, del)) WHERE NOT del)
SELECT {SCD2_OUT} FROM hist""",
)
def cdc_scd2_collapsed(spark, sf):
    """Neighbouring versions of one event type are one version (CDC-3/4)."""
    h = scd2(
        _changes(spark, sf), ["user_id"], SEQ, apply_as_deletes="_change_type = 'delete'", except_columns=C.CDF_COLUMNS,
        collapse_unchanged=["event_type"],
    )
    return flatten_sequence(h)


FEED_TS = "2024-01-02 00:00:00"
CF_SQL = X.with_ctes(X.SQL_SNAPSHOTS) + f"""
SELECT k, name, bal, _change_type, CAST(2 AS BIGINT) AS _commit_version, TIMESTAMP '{FEED_TS}' AS _commit_timestamp FROM (
  SELECT n.*, 'insert' AS _change_type FROM snap_new n WHERE NOT EXISTS (SELECT 1 FROM snap_old o WHERE o.k = n.k)
  UNION ALL
  SELECT o.*, 'delete' FROM snap_old o WHERE NOT EXISTS (SELECT 1 FROM snap_new n WHERE o.k = n.k)
  UNION ALL
  SELECT o.*, 'update_preimage' FROM snap_old o JOIN snap_new n ON o.k = n.k
    WHERE o.name IS DISTINCT FROM n.name OR o.bal IS DISTINCT FROM n.bal
  UNION ALL
  SELECT n.*, 'update_postimage' FROM snap_old o JOIN snap_new n ON o.k = n.k
    WHERE o.name IS DISTINCT FROM n.name OR o.bal IS DISTINCT FROM n.bal)"""


@register("cdc_change_feed", CF_SQL)
def cdc_change_feed(spark, sf):
    return C.change_feed(
        X.snapshot_old(spark, sf), X.snapshot_new(spark, sf), ["k"], 2, F.lit(FEED_TS).cast("timestamp_ntz")
    )


@register("cdc_change_feed_digests", CF_SQL)
def cdc_change_feed_digests(spark, sf):
    """The same feed, with key buckets compared by digests before any row is joined (CDC-6)."""
    return C.change_feed(
        X.snapshot_old(spark, sf), X.snapshot_new(spark, sf), ["k"], 2, F.lit(FEED_TS).cast("timestamp_ntz"), buckets=64
    )


DIVERGE_SQL = SCD1_DEL_SQL.rstrip() + f""",
b AS (SELECT {EV} FROM ranked WHERE rn = 1 AND _change_type <> 'delete'),
clean AS (SELECT * FROM changes WHERE _commit_version IN
    (SELECT _commit_version FROM changes GROUP BY 1 HAVING bool_and(_change_type = 'insert'))),
a AS (SELECT {EV} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r2
    FROM clean) WHERE r2 = 1)
SELECT x.*, 'insert' AS _change_type FROM b x WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.user_id = x.user_id)
UNION ALL
SELECT x.*, 'delete' FROM a x WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = x.user_id)
UNION ALL
SELECT a.*, 'update_preimage' FROM a JOIN b ON a.user_id = b.user_id WHERE a.event_id <> b.event_id
UNION ALL
SELECT b.*, 'update_postimage' FROM a JOIN b ON a.user_id = b.user_id WHERE a.event_id <> b.event_id"""


@register("cdc_track_divergence", DIVERGE_SQL)
def cdc_track_divergence(spark, sf):
    """Rows where the append-only (ignore-changes) gold differs from the recomputed gold (CDC-10)."""
    ignoring = latest_per_key(
        C.skip_change_commits(X.changes(spark, sf)).drop(*C.CDF_COLUMNS), ["user_id"], SEQ
    )
    recomputed = scd1(_changes(spark, sf), ["user_id"], SEQ, except_columns=C.CDF_COLUMNS)
    cols = EV.split(", ")
    return C.diff_tables(ignoring.select(*cols), recomputed.select(*cols), ["user_id"])
