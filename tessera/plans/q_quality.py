"""Queries for projections, filters and data-quality operators (PRJ, FLT, DQ)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import as_of_column, whole_years_between
from tessera.operators import quality as Q
from tessera.operators.derive import add_derived, employee_derivations
from tessera.operators.scd import scd1
from tessera.plans import fixtures as X
from tessera.plans.registry import comparable, register

STAFF = X.with_ctes(*X.STAFF_CTES)
STAFF_CHANGES = X.with_ctes(
    X.SQL_STAFF_RAW,
    X.SQL_STAFF_CHANGES,
    X.sql_enforced("staff_changes", "chg_enforced", keep=("row_id", "_change_type", "_commit_version", "_commit_timestamp")),
)
TYPED = "empid, empname, dob, salary, joining_date, dept_id, create_tmst, upd_tmst"
TYPED_OUT = (
    "empid, empname, CAST(dob AS VARCHAR) AS dob, CAST(salary AS DOUBLE) AS salary, "
    "CAST(joining_date AS VARCHAR) AS joining_date, dept_id, CAST(create_tmst AS VARCHAR) AS create_tmst, "
    "CAST(upd_tmst AS VARCHAR) AS upd_tmst"
)
RESCUE_OUT = (
    "rescue_empid, rescue_empname, rescue_dob, rescue_salary, rescue_joining_date, rescue_dept_id, "
    "rescue_create_tmst, rescue_upd_tmst"
)


def flatten_rescue(df: DataFrame, col: str = "_rescue_data") -> DataFrame:
    fields = df.schema[col].dataType.fieldNames()
    return df.select("*", *[F.col(f"{col}.{f}").alias(f"rescue_{f}") for f in fields]).drop(col)


def _changes_enforced(spark, sf):
    raw = X.staff_changes(spark, sf)
    return Q.enforce_schema(
        raw, X.SILVER_SCHEMA, Q.EMPLOYEE_DATE_FORMATS, keep=["row_id", *Q.CDF_COLUMNS]
    )


# ------------------------------------------------------------------ PRJ
@register(
    "prj_enforce_schema",
    STAFF + f"SELECT row_id, {TYPED_OUT}, _is_bad FROM staff_enforced",
)
def prj_enforce_schema(spark, sf):
    return comparable(X.staff_enforced(spark, sf).drop("_rescue_data"))


@register(
    "prj_rescue_struct",
    STAFF + f"SELECT row_id, {RESCUE_OUT} FROM staff_enforced",
)
def prj_rescue_struct(spark, sf):
    return comparable(flatten_rescue(X.staff_enforced(spark, sf)).select("row_id", *[f"rescue_{c}" for c in X.SILVER_COLUMNS]))


@register(
    "prj_is_bad",
    STAFF + "SELECT row_id, _is_bad, _is_bad AS _is_bad_compat FROM staff_enforced",
)
def prj_is_bad(spark, sf):
    # one scan: the compat flag is "some rescued field is not null", which is the same on a nullable schema
    enforced = X.staff_enforced(spark, sf)
    rescued = [F.col(f"_rescue_data.{c}").isNotNull() for c in X.SILVER_COLUMNS]
    compat = reduce(lambda a, b: a | b, rescued)
    return enforced.select("row_id", "_is_bad", compat.alias("_is_bad_compat"))


@register("prj_is_bad_compat", STAFF + "SELECT row_id, _is_bad FROM staff_enforced")
def prj_is_bad_compat(spark, sf):
    """The compat flag (a rescued field is not null) agrees with the default one on a nullable schema (PRJ-3)."""
    return X.staff_enforced(spark, sf, compat=True).select("row_id", "_is_bad")


@register("prj_age_today", STAFF + "SELECT row_id, CAST(floor(datesub('month', dob, current_date) / 12) AS BIGINT) AS age FROM staff")
def prj_age_today(spark, sf):
    """Whole years up to current_date, where no date is given."""
    age = whole_years_between(as_of_column(None), "dob").cast("bigint")
    return X.staff(spark, sf).select("row_id", age.alias("age"))


@register(
    "prj_enforce_with_change_type",
    STAFF_CHANGES + f"SELECT row_id, _change_type, {TYPED_OUT}, _is_bad FROM chg_enforced",
)
def prj_enforce_with_change_type(spark, sf):
    return comparable(_changes_enforced(spark, sf).drop("_rescue_data", "_commit_version", "_commit_timestamp"))


@register(
    "prj_select_alias",
    STAFF + "SELECT row_id, empid AS employee_id, empname AS name, dept_id AS department FROM staff",
)
def prj_select_alias(spark, sf):
    return X.staff(spark, sf).select(
        "row_id", F.col("empid").alias("employee_id"), F.col("empname").alias("name"), F.col("dept_id").alias("department")
    )


DERIVED_SQL = """CAST(floor(datesub('month', dob, DATE '2001-12-15') / 12) AS BIGINT) AS age,
  CAST(floor(datesub('month', joining_date, DATE '2001-12-15') / 12) AS BIGINT) AS tenure_years,
  CASE WHEN salary < 30000 THEN 'Junior' WHEN salary < 60000 THEN 'Mid' WHEN salary < 100000 THEN 'Senior'
       ELSE 'Executive' END AS salary_band"""


@register(
    "prj_derived_columns",
    STAFF + f"SELECT row_id, {TYPED_OUT}, {DERIVED_SQL} FROM staff",
)
def prj_derived_columns(spark, sf):
    return comparable(add_derived(X.staff(spark, sf), employee_derivations(X.AS_OF)))


@register(
    "prj_except_columns",
    X.with_ctes(X.SQL_CHANGES)
    + """SELECT user_id, event_id, ts, event_type, value, props
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
          FROM changes WHERE _change_type IN ('insert', 'update_postimage')) WHERE rn = 1""",
)
def prj_except_columns(spark, sf):
    """SCD1 written with the change-feed columns excepted (PRJ-8)."""
    ups = X.changes(spark, sf).filter(F.col("_change_type").isin("insert", "update_postimage"))
    return scd1(ups, ["user_id"], ["ts", "event_id"], apply_as_deletes=None, except_columns=Q.CDF_COLUMNS)


@register(
    "prj_date_pattern_compare",
    X.with_ctes(X.SQL_STAFF_RAW)
    + """SELECT row_id,
      CAST(CAST(try_strptime(joining_date, '%-m/%-d/%Y') AS DATE) AS VARCHAR) AS parsed_mdy,
      CAST(CAST(try_strptime(joining_date, '%Y-%m-%d') AS DATE) AS VARCHAR) AS parsed_iso
    FROM staff_raw""",
)
def prj_date_pattern_compare(spark, sf):
    """The right pattern parses; the wrong one gives NULL, never an error (FLT-6)."""
    r = X.staff_raw(spark, sf)
    return comparable(
        r.select(
            "row_id",
            F.try_to_date("joining_date", "M/d/yyyy").alias("parsed_mdy"),
            F.try_to_date("joining_date", "yyyy-MM-dd").alias("parsed_iso"),
        )
    )


# ------------------------------------------------------------------ FLT
@register("flt_good_rows", STAFF + f"SELECT row_id, {TYPED_OUT} FROM staff")
def flt_good_rows(spark, sf):
    return comparable(X.staff(spark, sf))


@register(
    "flt_bad_rows",
    STAFF + f"SELECT row_id, {TYPED_OUT}, {RESCUE_OUT}, _is_bad FROM staff_enforced WHERE _is_bad",
)
def flt_bad_rows(spark, sf):
    return comparable(flatten_rescue(Q.bad_rows(X.staff_enforced(spark, sf))))


@register(
    "flt_pass_deletes_good",
    STAFF_CHANGES + f"SELECT row_id, _change_type, {TYPED_OUT} FROM chg_enforced WHERE _change_type = 'delete' OR NOT _is_bad",
)
def flt_pass_deletes_good(spark, sf):
    good, _ = Q.split_enforced_changes(_changes_enforced(spark, sf))
    return comparable(good.drop("_commit_version", "_commit_timestamp"))


@register(
    "flt_pass_deletes_bad",
    STAFF_CHANGES + f"SELECT row_id, _change_type, {TYPED_OUT} FROM chg_enforced WHERE _change_type = 'delete' OR _is_bad",
)
def flt_pass_deletes_bad(spark, sf):
    _, bad = Q.split_enforced_changes(_changes_enforced(spark, sf))
    return comparable(bad.drop("_commit_version", "_commit_timestamp"))


@register(
    "flt_or_not_null",
    X.with_ctes(X.SQL_STAFF_RAW) + "SELECT row_id, empid, dept_id FROM staff_raw WHERE dept_id = 'X99' OR empid IS NULL",
)
def flt_or_not_null(spark, sf):
    r = X.staff_raw(spark, sf)
    return r.filter((F.col("dept_id") == "X99") | F.col("empid").isNull()).select("row_id", "empid", "dept_id")


@register(
    "flt_date_equals",
    X.with_ctes(X.SQL_STAFF_RAW)
    + """SELECT row_id, joining_date FROM staff_raw
    WHERE CAST(try_strptime(joining_date, '%-m/%-d/%Y') AS DATE) = DATE '1995-03-15'""",
)
def flt_date_equals(spark, sf):
    r = X.staff_raw(spark, sf)
    cond = F.try_to_date("joining_date", "M/d/yyyy") == F.try_to_date(F.lit("3/15/1995"), "M/d/yyyy")
    return r.filter(cond).select("row_id", "joining_date")


RULE_SQL = ", ".join(f"({cond}) AS {name}" for name, cond in Q.QUARANTINE_BAD_RULES.items())


@register("flt_rule_predicates", STAFF + f"SELECT row_id, {RULE_SQL}, (salary > 0) AS salary_positive FROM staff")
def flt_rule_predicates(spark, sf):
    """Rule texts evaluated with three-valued logic: NULL stays NULL (FLT-7)."""
    s = X.staff(spark, sf)
    rules = {**Q.QUARANTINE_BAD_RULES, "salary_positive": "salary > 0"}
    return s.select("row_id", *[F.expr(c).alias(n) for n, c in rules.items()])


# ------------------------------------------------------------------ DQ
def _curated_rules():
    return {**Q.CURATED_DROP_RULES, **Q.CURATED_WARN_RULES}


EXPECT_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS rule, count_if(coalesce({c}, false)) AS passed, count_if(NOT coalesce({c}, false)) AS failed FROM staff"
    for n, c in {**Q.CURATED_DROP_RULES, **Q.CURATED_WARN_RULES}.items()
)


@register("dq_expect_metrics", STAFF + EXPECT_SQL)
def dq_expect_metrics(spark, sf):
    """Per-rule pass/fail counts of the curated expectations, one aggregate pass (DQ-1)."""
    return Q.expectation_counts(X.staff(spark, sf), _curated_rules())


@register(
    "dq_expect_or_drop",
    STAFF + f"SELECT row_id, {TYPED_OUT} FROM staff WHERE dob IS NOT NULL AND empid IS NOT NULL AND salary > 0",
)
def dq_expect_or_drop(spark, sf):
    return comparable(Q.expect_or_drop(X.staff(spark, sf), Q.CURATED_DROP_RULES))


@register(
    "dq_first_failure_reason",
    STAFF
    + f"""SELECT row_id, {TYPED_OUT},
      CASE WHEN NOT coalesce(dob IS NOT NULL, false) THEN 'NULL_DOB'
           WHEN NOT coalesce(empid IS NOT NULL, false) THEN 'NULL_EMPID'
           WHEN NOT coalesce(salary > 0, false) THEN 'INVALID_SALARY' ELSE 'MULTIPLE_FAILURES' END AS failure_reason
    FROM staff WHERE NOT coalesce(dob IS NOT NULL AND empid IS NOT NULL AND salary > 0, false)""",
)
def dq_first_failure_reason(spark, sf):
    return comparable(Q.quarantine_complement(X.staff(spark, sf), Q.CURATED_DROP_RULES))


@register(
    "dq_first_failure_reason_compat",
    STAFF
    + f"""SELECT row_id, {TYPED_OUT},
      CASE WHEN dob IS NULL THEN 'NULL_DOB' WHEN empid IS NULL THEN 'NULL_EMPID'
           WHEN salary <= 0 THEN 'INVALID_SALARY' ELSE 'MULTIPLE_FAILURES' END AS failure_reason
    FROM staff WHERE dob IS NULL OR empid IS NULL OR salary <= 0""",
)
def dq_first_failure_reason_compat(spark, sf):
    return comparable(Q.quarantine_complement(X.staff(spark, sf), Q.CURATED_DROP_RULES, compat=True))


TAG_SQL = (
    "concat_ws('; ', "
    + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in Q.QUARANTINE_BAD_RULES.items())
    + ")"
)
STAFF_TAGGED = STAFF.rstrip() + f""",
tagged AS (SELECT *, {TAG_SQL} AS quarantine_reason FROM staff),
tagged2 AS (SELECT *, length(quarantine_reason) > 0 AS is_quarantined FROM tagged)
"""


@register("dq_tag_violations", STAFF_TAGGED + f"SELECT row_id, {TYPED_OUT}, quarantine_reason, is_quarantined FROM tagged2")
def dq_tag_violations(spark, sf):
    return comparable(Q.tag_violations(X.staff(spark, sf)))


@register("dq_manual_curated", STAFF_TAGGED + f"SELECT row_id, {TYPED_OUT}, quarantine_reason, is_quarantined FROM tagged2 WHERE NOT is_quarantined")
def dq_manual_curated(spark, sf):
    ok, _ = Q.split_quarantine(Q.tag_violations(X.staff(spark, sf)))
    return comparable(ok)


@register("dq_manual_bad", STAFF_TAGGED + f"SELECT row_id, {TYPED_OUT}, quarantine_reason, is_quarantined FROM tagged2 WHERE is_quarantined")
def dq_manual_bad(spark, sf):
    _, bad = Q.split_quarantine(Q.tag_violations(X.staff(spark, sf)))
    return comparable(bad)


@register(
    "dq_gate_changes",
    STAFF_CHANGES
    + f"""SELECT row_id, _change_type, {TYPED_OUT} FROM chg_enforced
    WHERE (_change_type = 'delete' OR NOT _is_bad)
      AND (_change_type = 'delete' OR (dob IS NOT NULL AND empid IS NOT NULL AND salary > 0))""",
)
def dq_gate_changes(spark, sf):
    good, _ = Q.split_enforced_changes(_changes_enforced(spark, sf))
    return comparable(Q.gate_changes(good).drop("_commit_version", "_commit_timestamp"))


@register(
    "dq_label_changes",
    STAFF_CHANGES
    + f"""SELECT row_id, _change_type, {TYPED_OUT},
      CASE WHEN _change_type = 'delete' THEN 'DELETED' WHEN dob IS NULL THEN 'NULL_DOB'
           WHEN empid IS NULL THEN 'NULL_EMPID' WHEN salary <= 0 THEN 'INVALID_SALARY'
           ELSE 'MULTIPLE_FAILURES' END AS failure_reason
    FROM chg_enforced WHERE _change_type = 'delete' OR _is_bad""",
)
def dq_label_changes(spark, sf):
    _, bad = Q.split_enforced_changes(_changes_enforced(spark, sf))
    return comparable(Q.label_changes(bad).drop("_commit_version", "_commit_timestamp"))


# DQ-8: tag the silver change rows -> SCD1 staging keyed on empid by commit ->
# split with delete pass-through -> two SCD1 targets.
def _staging(spark, sf):
    good, _ = Q.split_enforced_changes(_changes_enforced(spark, sf))
    tagged = Q.tag_violations(good)
    return scd1(tagged, ["empid"], ["_commit_version", "_commit_timestamp"], except_columns=Q.CDF_COLUMNS)


STAGING_SQL = STAFF_CHANGES.rstrip() + f""",
silver_chg AS (SELECT * FROM chg_enforced WHERE _change_type = 'delete' OR NOT _is_bad),
tagged AS (SELECT *, {TAG_SQL} AS quarantine_reason FROM silver_chg),
ranked AS (SELECT *, row_number() OVER (PARTITION BY empid
    ORDER BY _commit_version DESC, _commit_timestamp DESC, (_change_type = 'delete') DESC) AS rn FROM tagged),
staging AS (SELECT *, length(quarantine_reason) > 0 AS is_quarantined FROM ranked WHERE rn = 1 AND _change_type <> 'delete')
"""


@register(
    "dq_propagated_curated",
    STAGING_SQL + f"SELECT row_id, {TYPED_OUT} FROM staging WHERE NOT is_quarantined",
)
def dq_propagated_curated(spark, sf):
    ok, _ = Q.split_quarantine(_staging(spark, sf))
    return comparable(ok.select("row_id", *X.SILVER_COLUMNS))


@register(
    "dq_propagated_bad",
    STAGING_SQL + f"SELECT row_id, {TYPED_OUT} FROM staging WHERE is_quarantined",
)
def dq_propagated_bad(spark, sf):
    _, bad = Q.split_quarantine(_staging(spark, sf))
    return comparable(bad.select("row_id", *X.SILVER_COLUMNS))
