"""Schema enforcement, expectations, quarantine and derived columns on unit rows."""

from __future__ import annotations

from decimal import Decimal

from conftest import BAD, CHANGE_SCHEMA, DELETED, GOOD, RAW_GOOD, SILVER, d
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import quality as Q
from tessera.operators.derive import add_derived, employee_derivations, gold_summary, latest_per_key
from tessera.plans import fixtures as X


def enforce(df, **kw):
    return Q.enforce_schema(df, SILVER, Q.EMPLOYEE_DATE_FORMATS, **kw)


def test_good_raw_row_parses(raw_rows):
    out = enforce(raw_rows).collect()[0]
    assert out["_is_bad"] is False
    assert out["dob"] == d("1990-01-15") and out["upd_tmst"] == d("2024-06-01")
    assert all(v is None for v in out["_rescue_data"].asDict().values())


def test_bad_date_is_rescued(spark):
    row = list(RAW_GOOD)
    row[2] = "not-a-date"
    out = enforce(spark.createDataFrame([tuple(row)], X.RAW_SCHEMA)).collect()[0]
    assert out["_is_bad"] is True
    assert out["dob"] is None
    assert out["_rescue_data"]["dob"] == "not-a-date"
    assert out["_rescue_data"]["joining_date"] is None


def test_impossible_dates_fail_not_raise(spark):
    rows = [tuple([*RAW_GOOD[:2], v, *RAW_GOOD[3:]]) for v in ("2/30/2020", "11/2020/2019", "2020-01-15")]
    out = enforce(spark.createDataFrame(rows, X.RAW_SCHEMA)).select("_is_bad").collect()
    assert [r[0] for r in out] == [True, True, True]


def test_null_is_not_a_failure_for_nullable(spark):
    row = list(RAW_GOOD)
    row[2] = None
    assert enforce(spark.createDataFrame([tuple(row)], X.RAW_SCHEMA)).collect()[0]["_is_bad"] is False


def test_required_field_null(spark):
    schema = T.StructType([T.StructField("empid", T.StringType(), nullable=False)])
    df = spark.createDataFrame([("E001",), (None,)], "empid string")
    default = Q.enforce_schema(df, schema).orderBy(F.col("empid").asc_nulls_last()).select("_is_bad").collect()
    compat = Q.enforce_schema(df, schema, compat=True).orderBy(F.col("empid").asc_nulls_last()).select("_is_bad").collect()
    assert [r[0] for r in default] == [False, True]  # the missing required value is caught
    assert [r[0] for r in compat] == [False, False]  # reference behaviour: missed


def test_good_and_bad_partition_the_input(spark):
    df = X.staff_enforced(spark, "/root/testdata/sf0.001")
    n = df.count()
    good = Q.good_rows(df)
    bad = Q.bad_rows(df)
    assert good.count() + bad.count() == n
    assert "_is_bad" not in good.columns and "_rescue_data" not in good.columns


def test_tag_violations_lists_all_rules_in_order(silver_rows):
    out = {r["empid"]: r for r in Q.tag_violations(silver_rows).collect()}
    assert out["E002"]["quarantine_reason"] == "valid_dob; valid_salary; valid_dept_format"
    assert out["E002"]["is_quarantined"] is True
    assert out["E001"]["quarantine_reason"] == "" and out["E001"]["is_quarantined"] is False


def test_null_dept_is_not_flagged(spark):
    row = list(GOOD)
    row[5] = None
    out = Q.tag_violations(spark.createDataFrame([tuple(row)], SILVER)).collect()[0]
    assert out["is_quarantined"] is False


def test_first_failure_reason(spark, silver_rows):
    out = Q.quarantine_complement(silver_rows, Q.CURATED_DROP_RULES).collect()
    assert [(r["empid"], r["failure_reason"]) for r in out] == [("E002", "NULL_DOB")]
    # NULL salary: the derived complement keeps it, the literal (compat) filter loses it
    row = list(GOOD)
    row[3] = None
    df = spark.createDataFrame([tuple(row)], SILVER)
    assert [r["failure_reason"] for r in Q.quarantine_complement(df, Q.CURATED_DROP_RULES).collect()] == ["INVALID_SALARY"]
    assert Q.quarantine_complement(df, Q.CURATED_DROP_RULES, compat=True).count() == 0
    assert Q.expect_or_drop(df, Q.CURATED_DROP_RULES).count() == 0


def test_multiple_failures_takes_first(spark):
    row = list(BAD)
    row[0] = None
    out = Q.quarantine_complement(spark.createDataFrame([tuple(row)], SILVER), Q.CURATED_DROP_RULES).collect()[0]
    assert out["failure_reason"] == "NULL_DOB"


def test_expect_or_drop_and_counts(silver_rows):
    kept = Q.expect_or_drop(silver_rows, Q.CURATED_DROP_RULES).collect()
    assert [r["empid"] for r in kept] == ["E001"]
    counts = {r["rule"]: (r["passed"], r["failed"]) for r in Q.expectation_counts(silver_rows, Q.CURATED_DROP_RULES).collect()}
    assert counts == {"valid_dob": (1, 1), "valid_empid": (2, 0), "valid_salary": (1, 1)}


def test_expect_observes_metrics(silver_rows):
    from pyspark.sql import Observation

    obs = Observation("dq")
    rules = {**Q.CURATED_DROP_RULES, **Q.CURATED_WARN_RULES}
    silver_rows.observe(obs, *[F.count_if(F.coalesce(F.expr(c), F.lit(False))).alias(n) for n, c in rules.items()]).collect()
    assert obs.get["valid_dept_format"] == 1
    assert Q.expect(silver_rows, rules).count() == 2  # warn-only: rows kept


def test_change_gate_and_labels(spark):
    rows = [("insert", *GOOD), ("insert", *BAD), ("delete", *DELETED)]
    ch = spark.createDataFrame(rows, CHANGE_SCHEMA)
    assert sorted(r["empid"] for r in Q.gate_changes(ch).collect()) == ["E001", "E003"]
    labels = {r["empid"]: r["failure_reason"] for r in Q.label_changes(ch).collect()}
    assert labels == {"E001": "MULTIPLE_FAILURES", "E002": "NULL_DOB", "E003": "DELETED"}


def test_salary_bands(spark):
    rows = [tuple([*GOOD[:3], Decimal(s), *GOOD[4:]]) for s in ("25000", "45000", "80000", "150000")]
    out = add_derived(spark.createDataFrame(rows, SILVER), employee_derivations("2024-06-15")).collect()
    assert [r["salary_band"] for r in out] == ["Junior", "Mid", "Senior", "Executive"]
    assert out[0]["age"] == 34 and out[0]["tenure_years"] == 4


def test_dedup_picks_latest_update(spark):
    old = GOOD
    new = tuple([*GOOD[:7], d("2024-08-01")])
    df = spark.createDataFrame([old, new], SILVER)
    for method in ("aggregate", "window"):
        out = latest_per_key(df, ["empid"], ["upd_tmst", "create_tmst"], method=method).collect()
        assert len(out) == 1 and out[0]["upd_tmst"] == d("2024-08-01")
    g = gold_summary(df, as_of="2024-09-15").collect()
    assert g[0]["salary_band"] == "Senior"


def test_null_sorts_last_in_dedup(spark):
    newer_null = tuple([*GOOD[:7], None])
    dated = GOOD
    out = latest_per_key(spark.createDataFrame([newer_null, dated], SILVER), ["empid"], ["upd_tmst", "create_tmst"]).collect()
    assert out[0]["upd_tmst"] == d("2024-06-01")


def test_retract_on_fail(spark):
    later_bad = tuple([*GOOD[:3], Decimal("0.00"), *GOOD[4:7], d("2024-09-01")])
    ch = spark.createDataFrame([("insert", *GOOD), ("update_postimage", *later_bad)], CHANGE_SCHEMA)
    kept = Q.gate_changes(ch).collect()
    assert [r["_change_type"] for r in kept] == ["insert"]  # stale good row stays downstream
    retracted = sorted(r["_change_type"] for r in Q.gate_changes(ch, retract_on_fail=True).collect())
    assert retracted == ["delete", "insert"]
    from tessera.operators.scd import scd1

    assert scd1(Q.gate_changes(ch, retract_on_fail=True), ["empid"], ["upd_tmst"]).count() == 0
    assert scd1(Q.gate_changes(ch), ["empid"], ["upd_tmst"]).count() == 1


def test_typed_source_is_cast_not_parsed(spark, silver_rows):
    out = Q.enforce_schema(silver_rows, SILVER, Q.EMPLOYEE_DATE_FORMATS).collect()
    assert all(r["_is_bad"] is False for r in out)
    assert {r["dob"] for r in out} == {d("1990-01-15"), None}


def test_expect_with_metrics(silver_rows, tmp):
    rules = {**Q.CURATED_DROP_RULES, **Q.CURATED_WARN_RULES}
    df, obs = Q.expect_with_metrics(silver_rows, rules)
    df.write.parquet(f"{tmp}/out")  # any action fills the observation
    m = obs.get
    assert m["valid_dob_passed"] == 1 and m["valid_dob_failed"] == 1
    assert m["valid_dept_format_failed"] == 1 and m["valid_empid_passed"] == 2
