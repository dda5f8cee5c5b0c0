"""Deduplication to the latest row per key and derived gold columns (WIN-1/2, PRJ-7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.dates import as_of_column, whole_years_between

# Fixed values that must equal the reference's for identical output.
# Salary bands: upper bounds (exclusive) in order; anything else, NULL
# included, is the last band.
SALARY_BANDS = [(30000, "Junior"), (60000, "Mid"), (100000, "Senior")]
TOP_BAND = "Executive"
# Dedup order of the gold table: newest update, then newest creation.
GOLD_DEDUP_ORDER = ["upd_tmst", "create_tmst"]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_desc: Sequence[str],
    method: str = "aggregate",
) -> DataFrame:
    """One row per key: the greatest by ``order_desc`` (each DESC NULLS LAST).

    ``method="aggregate"`` (default) is ``max_by(row, struct(order))`` — a
    partial aggregate that reduces every key map-side before the shuffle, so a
    key with a third of all rows costs no more than any other.  Struct order
    puts NULL first, so max() is exactly DESC NULLS LAST.
    ``method="window"`` is the ``row_number() = 1`` form (planned as a
    WindowGroupLimit, also partial before the shuffle).
    Full ties are arbitrary; pass a unique last column to make them stable.
    """
    cols = df.columns
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_desc])
        return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    packed = F.struct(*[F.col(c) for c in cols])
    order = F.struct(*[F.col(c) for c in order_desc])
    return df.groupBy(*[F.col(k) for k in keys]).agg(F.max_by(packed, order).alias("__row")).select(
        *[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in cols]
    )


def salary_band(salary: Column | str = "salary") -> Column:
    s = F.col(salary) if isinstance(salary, str) else salary
    out = None
    for bound, name in SALARY_BANDS:
        cond = s < F.lit(bound)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(TOP_BAND))


def employee_derivations(as_of=None) -> dict[str, Column]:
    """age, tenure_years, salary_band — ``as_of`` pins current_date()."""
    today = as_of_column(as_of)
    return {
        "age": whole_years_between(today, "dob"),
        "tenure_years": whole_years_between(today, "joining_date"),
        "salary_band": salary_band("salary"),
    }


def add_derived(df: DataFrame, specs: Mapping[str, Column]) -> DataFrame:
    """All derived columns in one projection (PRJ-7)."""
    return df.withColumns(dict(specs))


def gold_summary(
    df: DataFrame,
    as_of=None,
    keys: Sequence[str] = ("empid",),
    order_desc: Sequence[str] = tuple(GOLD_DEDUP_ORDER),
) -> DataFrame:
    """Latest row per employee plus derived columns (WIN-2)."""
    return add_derived(latest_per_key(df, keys, order_desc), employee_derivations(as_of))
