"""Driver contract: entry point, registry completeness, oracle agreement on a core set."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as E

ROWS_ONLY: set[str] = set()  # every query of the library has an oracle
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
CORE = [
    "prj_enforce_schema", "flt_bad_rows", "dq_tag_violations", "dq_first_failure_reason", "dq_propagated_curated",
    "agg_metric_query", "agg_metric_formatted", "win_gold_summary", "cdc_scd1_deletes", "cdc_scd2_deletes",
    "cdc_change_feed", "cdc_track_divergence", "src_rescued_csv", "src_permissive_corrupt",
]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"empid", "age", "tenure_years", "salary_band"} <= set(df.columns)


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    from tessera.plans.catalog import ORACLES, QUERIES

    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert not any(n.startswith("op") and n[2:3].isdigit() for n in QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", CORE)
def test_core_queries_match_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    rel = duck.execute(E.oracle_sql()[name])
    ocols = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(ocols)
    idx = [ocols.index(c) for c in df.columns]
    orows = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    srows = Counter(tuple(_norm(v) for v in r) for r in df.collect())
    assert srows == orows
