"""Schema enforcement, expectations and quarantine (PRJ-1..4, FLT-1..3, DQ-1..7).

All of these are narrow (map-only) transformations: no shuffle, and their
predicates stay plain Catalyst expressions so filters push into the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType, TimestampNTZType, TimestampType

from tessera.functions.rules import all_true, as_column, not_true, rule_labels

CHANGE_TYPE = "_change_type"
CDF_COLUMNS = ["_change_type", "_commit_version", "_commit_timestamp"]

# Fixed values that must equal the reference's for identical output.
# Curated expectations: three dropping rules and one warn-only rule.
CURATED_DROP_RULES = {
    "valid_dob": "dob IS NOT NULL",
    "valid_empid": "empid IS NOT NULL",
    "valid_salary": "salary > 0",
}
CURATED_WARN_RULES = {"valid_dept_format": "dept_id LIKE 'D%'"}
# Manual quarantine: a rule fires when the row is bad; names in this order.
QUARANTINE_BAD_RULES = {
    "valid_dob": "dob IS NULL",
    "valid_empid": "empid IS NULL",
    "valid_salary": "salary <= 0 OR salary IS NULL",
    "valid_dept_format": "dept_id NOT LIKE 'D%'",
}
# First-failing-rule labels, checked in this order.
FAILURE_LABELS = [
    ("NULL_DOB", "dob IS NULL"),
    ("NULL_EMPID", "empid IS NULL"),
    ("INVALID_SALARY", "salary <= 0"),
]
# Label of each curated rule when it is the first one a row fails.
RULE_LABELS = {"valid_dob": "NULL_DOB", "valid_empid": "NULL_EMPID", "valid_salary": "INVALID_SALARY"}
DELETED_LABEL = "DELETED"
MULTIPLE_FAILURES_LABEL = "MULTIPLE_FAILURES"
# Date pattern of every date column in the employee feed.
EMPLOYEE_DATE_FORMATS = {
    "dob": "M/d/yyyy",
    "joining_date": "M/d/yyyy",
    "create_tmst": "M/d/yyyy",
    "upd_tmst": "M/d/yyyy",
}


# ------------------------------------------------------------ enforcement
def _typed(src: Column, field, date_formats: Mapping[str, str], src_type=None) -> Column:
    # a pattern applies to text only; an already typed source is just cast
    fmt = date_formats.get(field.name) if src_type is None or isinstance(src_type, StringType) else None
    if fmt is not None and isinstance(field.dataType, DateType):
        return F.try_to_date(src, fmt)
    if fmt is not None and isinstance(field.dataType, (TimestampType, TimestampNTZType)):
        return F.try_to_timestamp(src, F.lit(fmt)).try_cast(field.dataType)
    return src.try_cast(field.dataType)


def enforce_schema(
    df: DataFrame,
    schema: StructType,
    date_formats: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
    rescue_col: str | None = "_rescue_data",
    bad_col: str = "_is_bad",
    compat: bool = False,
) -> DataFrame:
    """Cast every column to ``schema`` and keep evidence for each failed cast.

    A field *fails* when its source is non-NULL and the cast is NULL (nullable
    field), or when either is NULL (non-nullable field).  ``rescue_col`` is a
    struct holding the source value of failed fields only; ``bad_col`` is the OR
    of the failure predicates.  ``compat=True`` derives the flag from the rescue
    members instead, which — like the reference — misses a NULL in a required
    field (its rescued value is NULL too).
    ``keep`` columns pass through unchanged in front (e.g. ``_change_type``).
    """
    date_formats = dict(date_formats or {})
    src_names = [f"__src_{f.name}" for f in schema.fields]
    # Project every source once beside its typed value; the flags below read
    # both, so each cast is evaluated a single time.
    staged = df.select(
        *[F.col(k) for k in keep],
        *[F.col(f.name).alias(s) for f, s in zip(schema.fields, src_names)],
        *[_typed(F.col(f.name), f, date_formats, df.schema[f.name].dataType).alias(f.name) for f in schema.fields],
    )
    failed = []
    for f, s in zip(schema.fields, src_names):
        src, typed = F.col(s), F.col(f.name)
        failed.append((src.isNull() | typed.isNull()) if not f.nullable else (src.isNotNull() & typed.isNull()))
    out = [*[F.col(k) for k in keep], *[F.col(f.name) for f in schema.fields]]
    if rescue_col:
        out.append(
            F.struct(*[F.when(c, F.col(s)).alias(f.name) for c, f, s in zip(failed, schema.fields, src_names)]).alias(
                rescue_col
            )
        )
    if compat and rescue_col:
        flag = reduce(lambda a, b: a | b, [F.col(f"{rescue_col}.{f.name}").isNotNull() for f in schema.fields])
        return staged.select(*out).withColumn(bad_col, flag)
    flag = reduce(lambda a, b: a | b, failed) if failed else F.lit(False)
    return staged.select(*out, flag.alias(bad_col))


def good_rows(df: DataFrame, bad_col: str = "_is_bad", rescue_col: str = "_rescue_data") -> DataFrame:
    """Rows that passed enforcement, without the helper columns (FLT-1, PRJ-5)."""
    return df.filter(~F.col(bad_col)).drop(bad_col, rescue_col)


def bad_rows(df: DataFrame, bad_col: str = "_is_bad") -> DataFrame:
    """Rows that failed enforcement, evidence kept (FLT-2)."""
    return df.filter(F.col(bad_col))


def pass_deletes(pred: Column | str, change_col: str = CHANGE_TYPE) -> Column:
    """Predicate that lets every delete through (FLT-3): deletes reach all targets."""
    return (F.col(change_col) == F.lit("delete")) | as_column(pred)


def retract(df: DataFrame, failing: Column, change_col: str = CHANGE_TYPE) -> DataFrame:
    """Turn failing upserts into deletes, so a row that goes bad leaves its target."""
    ct = F.col(change_col)
    return df.withColumn(change_col, F.when(failing & (ct != F.lit("delete")), F.lit("delete")).otherwise(ct))


def split_enforced_changes(
    df: DataFrame, bad_col: str = "_is_bad", rescue_col: str = "_rescue_data", retract_on_fail: bool = False
):
    """(good, bad) change rows after enforcement; deletes go to both (FLT-3).

    By default a failing post-image is simply not sent to the good target,
    which keeps the key's older good row there (reference behaviour).
    ``retract_on_fail=True`` sends it to the good target as a delete instead.
    """
    if retract_on_fail:
        good = retract(df, F.col(bad_col)).drop(bad_col, rescue_col)
    else:
        good = df.filter(pass_deletes(~F.col(bad_col))).drop(bad_col, rescue_col)
    bad = df.filter(pass_deletes(F.col(bad_col))).drop(bad_col, rescue_col)
    return good, bad


# ------------------------------------------------------------ expectations
def expect(df: DataFrame, rules: Mapping[str, str | Column], name: str = "expectations") -> DataFrame:
    """Warn-only expectations (DQ-1): rows unchanged; pass/fail counts observed.

    Counts land in ``Observation``/``StreamingQueryProgress.observedMetrics``
    under ``<rule>_passed`` / ``<rule>_failed``.  For a table of counts use
    :func:`expectation_counts`.
    """
    metrics = []
    for rule, cond in rules.items():
        c = as_column(cond)
        metrics.append(F.count_if(F.coalesce(c, F.lit(False))).alias(f"{rule}_passed"))
        metrics.append(F.count_if(not_true(c)).alias(f"{rule}_failed"))
    return df.observe(name, *metrics)


def expect_with_metrics(df: DataFrame, rules: Mapping[str, str | Column]):
    """Warn-only expectations returning ``(df, observation)`` (DQ-1).

    The rows are unchanged; ``observation.get`` holds ``<rule>_passed`` /
    ``<rule>_failed`` once an action (a write, a count) has run on ``df``.
    The counts are computed by the executors alongside that action — no
    extra pass over the data.
    """
    from pyspark.sql import Observation

    obs = Observation()
    metrics = []
    for rule, cond in rules.items():
        c = as_column(cond)
        metrics.append(F.count_if(F.coalesce(c, F.lit(False))).alias(f"{rule}_passed"))
        metrics.append(F.count_if(not_true(c)).alias(f"{rule}_failed"))
    return df.observe(obs, *metrics), obs


def expectation_counts(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """One row per rule with passed/failed counts, in a single aggregate pass."""
    aggs = []
    for rule, cond in rules.items():
        c = as_column(cond)
        aggs.append(F.count_if(F.coalesce(c, F.lit(False))).alias(f"p_{rule}"))
        aggs.append(F.count_if(not_true(c)).alias(f"f_{rule}"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{r}', p_{r}, f_{r}" for r in rules)
    return wide.selectExpr(f"stack({len(rules)}, {stack}) as (rule, passed, failed)")


def expect_or_drop(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """Keep rows where every rule is TRUE (DQ-2); NULL drops, like a filter."""
    return df.filter(all_true(rules))


def quarantine_complement(
    df: DataFrame,
    rules: Mapping[str, str | Column] = CURATED_DROP_RULES,
    rule_labels_map: Mapping[str, str] | None = None,
    reason_col: str = "failure_reason",
    default: str = MULTIPLE_FAILURES_LABEL,
    compat: bool = False,
    labels: Sequence[tuple[str, str | Column]] = FAILURE_LABELS,
) -> DataFrame:
    """Rows an ``expect_or_drop`` would drop, labelled with the first failing rule (DQ-3).

    Default: the complement is derived from the rules (``NOT coalesce(rule,
    false)``), so every row lands in exactly one of kept/quarantined, and the
    label is that of the first rule not TRUE (a NULL salary is INVALID_SALARY).
    ``compat=True`` reproduces the reference: the filter and the labels are
    the literal ``labels`` predicates (``dob IS NULL``, ``empid IS NULL``,
    ``salary <= 0``), so NULL-salary rows fall out of both outputs.
    """
    if compat:
        cond = reduce(lambda a, b: a | b, [as_column(c) for _, c in labels])
        return df.filter(cond).withColumn(reason_col, first_label(labels, default))
    names = dict(rule_labels_map or RULE_LABELS)
    derived = [(names.get(r, r), not_true(as_column(c))) for r, c in rules.items()]
    return df.filter(not_true(all_true(rules))).withColumn(reason_col, first_label(derived, default))


def first_label(labels: Sequence[tuple[str, str | Column]], default: str | None) -> Column:
    out = None
    for label, cond in labels:
        out = F.when(as_column(cond), F.lit(label)) if out is None else out.when(as_column(cond), F.lit(label))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def tag_violations(
    df: DataFrame,
    bad_rules: Mapping[str, str | Column] = QUARANTINE_BAD_RULES,
    sep: str = "; ",
    reason_col: str = "quarantine_reason",
    flag_col: str = "is_quarantined",
) -> DataFrame:
    """Every violated rule name joined by ``sep`` plus a boolean (DQ-4)."""
    return df.withColumn(reason_col, rule_labels(bad_rules, sep)).withColumn(
        flag_col, F.length(F.col(reason_col)) > 0
    )


def split_quarantine(df: DataFrame, flag_col: str = "is_quarantined"):
    """(curated, quarantined) from tagged rows (DQ-5).

    Filtering on the flag (the partition column when the staging table is
    written with ``partitionBy(flag_col)``) lets the scan prune partitions.
    """
    return df.filter(~F.col(flag_col)), df.filter(F.col(flag_col))


def gate_changes(
    df: DataFrame, rules: Mapping[str, str | Column] = CURATED_DROP_RULES, retract_on_fail: bool = False
) -> DataFrame:
    """Change-aware expectation (DQ-6): deletes always pass, upserts must pass every rule.

    ``retract_on_fail=True`` turns a failing upsert into a delete of its key.
    """
    if retract_on_fail:
        return retract(df, not_true(all_true(rules)))
    return df.filter(pass_deletes(all_true(rules)))


def label_changes(
    df: DataFrame,
    labels: Sequence[tuple[str, str | Column]] = FAILURE_LABELS,
    reason_col: str = "failure_reason",
) -> DataFrame:
    """Change-aware failure label (DQ-7): DELETED first, default MULTIPLE_FAILURES."""
    return df.withColumn(
        reason_col, first_label([(DELETED_LABEL, f"{CHANGE_TYPE} = 'delete'"), *labels], MULTIPLE_FAILURES_LABEL)
    )

