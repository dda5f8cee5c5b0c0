"""Metric view: measures re-aggregate per grouping; brackets and display formats."""

from __future__ import annotations

from decimal import Decimal

from conftest import GOOD, SILVER, d
from pyspark.sql import functions as F

from tessera.operators.metrics import employee_metrics


def _rows(spark):
    base = list(GOOD)
    rows = []
    for i, (dept, sal, dob, join) in enumerate(
        [("D1", "100.00", "2000-01-01", "2024-01-01"), ("D1", "200.01", "1980-01-01", "2018-01-01"), ("D2", "300.00", "1960-06-01", "2021-06-01")]
    ):
        r = base.copy()
        r[0], r[5], r[3], r[2], r[4] = f"E{i}", dept, Decimal(sal), d(dob), d(join)
        rows.append(tuple(r))
    return spark.createDataFrame(rows, SILVER)


def test_measures_by_dimension(spark):
    v = employee_metrics(_rows(spark), as_of="2024-06-15")
    by_dept = {r["dept_id"]: r for r in v.query(by=["dept_id"]).collect()}
    assert by_dept["D1"]["employee_count"] == 2
    assert by_dept["D1"]["total_salary"] == Decimal("300.01")
    assert abs(by_dept["D1"]["avg_salary"] - 150.005) < 1e-9
    assert by_dept["D1"]["avg_tenure_years"] == 3.0  # (0 + 6) / 2
    total = v.query().collect()[0]
    assert total["employee_count"] == 3  # rows, not re-aggregated groups


def test_brackets_and_month(spark):
    v = employee_metrics(_rows(spark), as_of="2024-06-15")
    ages = {r["age_bracket"]: r["employee_count"] for r in v.query(by=["age_bracket"]).collect()}
    assert ages == {"Under 30": 1, "40-49": 1, "50+": 1}
    ten = {r["tenure_bracket"] for r in v.query(by=["tenure_bracket"]).collect()}
    assert ten == {"Less than 1 year", "5+ years", "3-5 years"}
    months = {r["joining_month"].date() for r in v.query(by=["joining_month"]).collect()}
    assert d("2021-06-01") in months


def test_display_rounding_is_half_up_on_the_decimal_value(spark):
    v = employee_metrics(_rows(spark), as_of="2024-06-15")
    row = {r["dept_id"]: r for r in v.query(by=["dept_id"], display=True).collect()}["D1"]
    assert row["avg_salary"] == 150.01  # 150.005 -> 150.01, not its binary neighbour
    assert row["employee_count"] == 2
    meta = v.query(by=["dept_id"], display=True).schema["avg_salary"].metadata
    assert meta["format"]["type"] == "currency" and meta["display_name"] == "Average Salary"


def test_where_filter(spark):
    v = employee_metrics(_rows(spark), as_of="2024-06-15")
    assert v.query(measures=["employee_count"], where=F.col("dept_id") == "D2").collect()[0][0] == 1


def test_a_view_follows_its_change_feed(spark, tmp):
    """Inserts, updates that change group, deletes and nulls: the kept sums equal the recomputed view at every step."""
    import random

    from pyspark.sql import functions as F

    from tessera.operators.metrics import employee_metrics
    from tessera.sinks.tables import run_to_completion
    from tessera.sources.files import stream_table
    from tessera.streaming.metrics import metric_stream
    from tessera.streaming.state import StateTable

    r = random.Random(4)
    schema = "empid string, dept_id string, dob date, joining_date date, salary decimal(10,2), seq int, _change_type string"
    table = StateTable(spark, f"{tmp}/t", ["empid"], "seq", except_columns=["_change_type"])
    seq = 0
    for batch in range(4):
        rows = []
        for _ in range(40):
            seq += 1
            kind = r.choice(["update_postimage", "update_postimage", "delete"])
            pay = r.choice([None, Decimal(r.randrange(1, 10**8)) / 100])
            rows.append((f"E{r.randrange(25)}", r.choice(["D1", "D2", None]), d("1990-01-01"), r.choice([None, d("2015-05-05")]), pay, seq, kind))
        table.apply(spark.createDataFrame(rows, schema), batch, emit_changes=True)
        feed = stream_table(spark, table.changes_path, table.change_feed().schema, recursiveFileLookup="true")
        for by in (["dept_id"], ["dept_id", "tenure_bracket"], []):
            view = employee_metrics(table.scd1(), as_of="2024-06-15")
            query, kept = metric_stream(view, feed, by, f"{tmp}/ck-{len(by)}")
            run_to_completion(query)
            assert sorted(map(str, kept.read().collect())) == sorted(map(str, view.query(by=by).collect()))
            shown = view.query(by=by, display=True)
            assert sorted(map(str, kept.read(display=True).collect())) == sorted(map(str, shown.collect()))


def test_other_measures_cannot_follow_a_feed(spark, tmp):
    import pytest

    from tessera.operators.metrics import Dimension, Measure, MetricView

    view = MetricView(spark.range(3), [Dimension("k", "id % 2")], [Measure("top", "max(id)")])
    with pytest.raises(ValueError, match="not made of sums"):
        view.deltas(spark.range(3).selectExpr("id", "'insert' AS _change_type"), ["k"])
