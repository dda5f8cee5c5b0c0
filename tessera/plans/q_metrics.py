"""Queries for the metric view, dedup windows and limits (AGG, WIN, LIM)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.operators.derive import gold_summary, latest_per_key
from tessera.operators.metrics import employee_metrics
from tessera.plans import fixtures as X
from tessera.plans.q_quality import DERIVED_SQL, STAFF, TYPED_OUT
from tessera.plans.registry import comparable, register

CURATED = STAFF.rstrip() + """,
curated AS (SELECT *,
    CAST(floor(datesub('month', dob, DATE '2001-12-15') / 12) AS BIGINT) AS age_y,
    CAST(floor(datesub('month', joining_date, DATE '2001-12-15') / 12) AS BIGINT) AS tenure_y
  FROM staff WHERE dob IS NOT NULL AND empid IS NOT NULL AND salary > 0)
"""
DIM_SQL = {
    "dept_id": "dept_id",
    "joining_month": "CAST(CAST(date_trunc('month', joining_date) AS DATE) AS VARCHAR)",
    "age_bracket": "CASE WHEN age_y < 30 THEN 'Under 30' WHEN age_y < 40 THEN '30-39' WHEN age_y < 50 THEN '40-49' ELSE '50+' END",
    "tenure_bracket": "CASE WHEN tenure_y < 1 THEN 'Less than 1 year' WHEN tenure_y < 3 THEN '1-3 years' "
    "WHEN tenure_y < 5 THEN '3-5 years' ELSE '5+ years' END",
}
MEASURE_SQL = {
    "employee_count": "count(*)",
    "total_salary": "CAST(sum(salary) AS DOUBLE)",
    "avg_salary": "CAST(sum(salary) AS DOUBLE) / count(salary)",
    "avg_tenure_years": "avg(tenure_y)",
}
MEASURE_DISPLAY_SQL = {
    "employee_count": "count(*)",
    "total_salary": "CAST(round(CAST(sum(salary) AS DECIMAL(38,10)), 2) AS DOUBLE)",
    "avg_salary": "CAST(round(CAST(CAST(sum(salary) AS DOUBLE) / count(salary) AS DECIMAL(38,10)), 2) AS DOUBLE)",
    "avg_tenure_years": "CAST(round(CAST(avg(tenure_y) AS DECIMAL(38,10)), 1) AS DOUBLE)",
}


def metric_sql(by, measures, display=False):
    msql = MEASURE_DISPLAY_SQL if display else MEASURE_SQL
    sel = [f"{DIM_SQL[d]} AS {d}" for d in by] + [f"{msql[m]} AS {m}" for m in measures]
    group = f" GROUP BY {', '.join(str(i + 1) for i in range(len(by)))}" if by else ""
    return CURATED + f"SELECT {', '.join(sel)} FROM curated{group}"


def view(spark, sf):
    curated = Q.expect_or_drop(X.staff(spark, sf), Q.CURATED_DROP_RULES)
    return employee_metrics(curated, as_of=X.AS_OF)


def metric_query(by, measures, display=False):
    def run(spark, sf):
        out = view(spark, sf).query(by=by, measures=measures, display=display)
        if "joining_month" in by:
            out = out.withColumn("joining_month", F.col("joining_month").cast("date"))
        return comparable(out)

    return run


ALL = ["employee_count", "total_salary", "avg_salary", "avg_tenure_years"]
METRIC_QUERIES = {
    "agg_metric_all": ([], ALL, False),
    "agg_total_by_dept": (["dept_id"], ["total_salary"], False),
    "agg_avg_by_dept": (["dept_id"], ["employee_count", "avg_salary"], False),
    "agg_avg_tenure": (["dept_id"], ["avg_tenure_years"], False),
    "agg_by_month": (["joining_month"], ["employee_count", "total_salary"], False),
    "agg_by_age_bracket": (["age_bracket"], ["employee_count", "avg_salary"], False),
    "agg_by_tenure_bracket": (["tenure_bracket"], ["employee_count", "avg_tenure_years"], False),
    "agg_metric_query": (["dept_id", "tenure_bracket"], ALL, False),
    "agg_metric_formatted": (["dept_id"], ALL, True),
}
for _name, (_by, _ms, _disp) in METRIC_QUERIES.items():
    register(_name, metric_sql(_by, _ms, _disp))(metric_query(_by, _ms, _disp))


@register(
    "agg_filtered_count",
    X.with_ctes(X.SQL_STAFF_RAW) + "SELECT count(*) AS n_rows FROM staff_raw WHERE dept_id = 'X99' OR empid IS NULL",
)
def agg_filtered_count(spark, sf):
    r = X.staff_raw(spark, sf)
    return r.filter((F.col("dept_id") == "X99") | F.col("empid").isNull()).agg(F.count(F.lit(1)).alias("n_rows"))


LATEST_SQL = STAFF.rstrip() + """,
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY empid
    ORDER BY upd_tmst DESC NULLS LAST, create_tmst DESC NULLS LAST, row_id DESC) AS rn FROM staff) WHERE rn = 1)
"""


@register("win_latest_per_key", LATEST_SQL + f"SELECT row_id, {TYPED_OUT} FROM latest")
def win_latest_per_key(spark, sf):
    return comparable(latest_per_key(X.staff(spark, sf), ["empid"], ["upd_tmst", "create_tmst", "row_id"]))


@register("win_latest_per_key_window", LATEST_SQL + f"SELECT row_id, {TYPED_OUT} FROM latest")
def win_latest_per_key_window(spark, sf):
    """The row_number() form of WIN-1 (plans as WindowGroupLimit)."""
    return comparable(
        latest_per_key(X.staff(spark, sf), ["empid"], ["upd_tmst", "create_tmst", "row_id"], method="window")
    )


@register("win_gold_summary", LATEST_SQL + f"SELECT row_id, {TYPED_OUT}, {DERIVED_SQL} FROM latest")
def win_gold_summary(spark, sf):
    return comparable(gold_summary(X.staff(spark, sf), as_of=X.AS_OF, order_desc=["upd_tmst", "create_tmst", "row_id"]))


@register("lim_first_n", STAFF + f"SELECT row_id, {TYPED_OUT} FROM staff ORDER BY row_id LIMIT 10")
def lim_first_n(spark, sf):
    """First n rows of a result (LIM-1); ordered so the n rows are well defined."""
    return comparable(X.staff(spark, sf).orderBy("row_id").limit(10))
