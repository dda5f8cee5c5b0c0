"""Metric views: named dimensions and measures over one source (AGG-1..11).

``MetricView(source, dims, measures).query(by=[...], measures=[...])`` builds
``groupBy(*dimension exprs).agg(*measure exprs)``; Catalyst plans it as a
partial + final hash aggregate, so only one (small) row per group per map
task crosses the shuffle.  Any subset of dimensions can be asked for: the
measures are re-aggregated from the source, never from another grouping.

Measures that are made of sums also follow a change feed: ``deltas`` adds what
the feed's post-images bring and takes off what its pre-images held, and
``streaming.metrics.metric_stream`` keeps these sums in the streaming state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import as_of_column, whole_years_between
from tessera.operators.changes import CHANGE_TYPE


@dataclass(frozen=True)
class Dimension:
    name: str
    expr: Callable[[Column], Column] | str  # fn(as_of) -> Column, or SQL text
    display_name: str | None = None
    comment: str | None = None

    def column(self, as_of: Column) -> Column:
        c = F.expr(self.expr) if isinstance(self.expr, str) else self.expr(as_of)
        return c.alias(self.name, metadata=_meta(self.display_name, self.comment))


@dataclass(frozen=True)
class Measure:
    name: str
    expr: Callable[[Column], Column] | str
    display_name: str | None = None
    comment: str | None = None
    format_type: str = "number"  # number | currency
    places: int | None = None
    currency: str | None = None
    integral: bool = False  # an exact integer (a count): never rounded
    # the sums that the measure is made of (a value for each row; null counts as none), and the measure from them
    sums: dict[str, Callable[[Column], Column]] | None = None
    finish: Callable[[Callable[[str], Column]], Column] | None = None

    def column(self, as_of: Column, display: bool = False) -> Column:
        c = F.expr(self.expr) if isinstance(self.expr, str) else self.expr(as_of)
        if display and self.places is not None and not self.integral:
            c = self._rounded(c)
        meta = _meta(self.display_name, self.comment)
        meta["format"] = {"type": self.format_type, "places": self.places, "currency": self.currency}
        return c.alias(self.name, metadata=meta)

    def _rounded(self, c: Column) -> Column:
        # Round the decimal value, half up: going through decimal(38,10)
        # first keeps 2.675 at 2.675 instead of its binary neighbour.
        return F.round(c.cast("decimal(38,10)"), self.places).cast("double")

    def finished(self, display: bool = False) -> Column:
        """The measure from the columns of its sums (named like them)."""
        c = self.finish(F.col)
        return (self._rounded(c) if display and self.places is not None and not self.integral else c).alias(self.name)


def _meta(display_name, comment) -> dict:
    out = {}
    if display_name:
        out["display_name"] = display_name
    if comment:
        out["comment"] = comment
    return out


@dataclass
class MetricView:
    source: DataFrame
    dimensions: Sequence[Dimension]
    measures: Sequence[Measure]
    as_of: object = None
    comment: str | None = None
    _dims: dict = field(init=False, repr=False)
    _meas: dict = field(init=False, repr=False)

    def __post_init__(self):
        self._dims = {d.name: d for d in self.dimensions}
        self._meas = {m.name: m for m in self.measures}

    def query(
        self,
        by: Sequence[str] = (),
        measures: Sequence[str] | None = None,
        where: str | Column | None = None,
        display: bool = False,
    ) -> DataFrame:
        """Group the source by the named dimensions and compute the named measures."""
        today = as_of_column(self.as_of)
        src = self.source
        if where is not None:
            src = src.filter(F.expr(where) if isinstance(where, str) else where)
        names = list(measures) if measures is not None else list(self._meas)
        aggs = [self._meas[m].column(today, display) for m in names]
        if not by:
            return src.agg(*aggs)
        return src.groupBy(*[self._dims[d].column(today) for d in by]).agg(*aggs)

    # ------------------------------------------------------------ change feeds
    def deltas(self, changes: DataFrame, by: Sequence[str], measures: Sequence[str] | None = None) -> DataFrame:
        """Signed sums of a change feed (batch or stream): group columns, ``__rows`` and the measures' sums.

        Inserts and post-images count once, deletes and pre-images minus once, so
        the sums over a feed's whole history are those of the table as it is now.
        """
        today = as_of_column(self.as_of)
        sign = F.when(F.col(CHANGE_TYPE).isin("insert", "update_postimage"), 1).when(
            F.col(CHANGE_TYPE).isin("delete", "update_preimage"), -1
        )
        signed = changes.withColumn("__sign", sign).filter(F.col("__sign").isNotNull())
        parts = self._sums(measures)
        values = [F.when(F.col("__sign") > 0, fn(today)).otherwise(-fn(today)).alias(n) for n, fn in parts.items()]
        rows = signed.select(*[self._dims[d].column(today) for d in by], F.col("__sign"), *values)
        totals = [F.sum(n).alias(n) for n in parts]
        return rows.groupBy(*by).agg(F.sum("__sign").alias("__rows"), *totals)

    def from_sums(self, sums: DataFrame, by: Sequence[str], measures: Sequence[str] | None = None, display: bool = False) -> DataFrame:
        """The measures from ``deltas`` summed up over all changes; groups without rows are gone."""
        names = list(measures) if measures is not None else list(self._meas)
        live = sums.filter(F.col("__rows") != 0) if by else sums
        return live.select(*by, *[self._meas[m].finished(display) for m in names])

    def _sums(self, measures: Sequence[str] | None) -> dict:
        out = {}
        for m in measures if measures is not None else self._meas:
            if self._meas[m].sums is None:
                raise ValueError(f"measure {m} is not made of sums and cannot follow a change feed")
            out.update(self._meas[m].sums)
        return out


# ------------------------------------------------------------ employee view
# Fixed values that must equal the reference's for identical output.
AGE_BRACKETS = [(30, "Under 30"), (40, "30-39"), (50, "40-49")]
AGE_TOP = "50+"
TENURE_BRACKETS = [(1, "Less than 1 year"), (3, "1-3 years"), (5, "3-5 years")]
TENURE_TOP = "5+ years"


def _bracket(value: Column, brackets, top: str) -> Column:
    out = None
    for bound, name in brackets:
        out = F.when(value < bound, F.lit(name)) if out is None else out.when(value < bound, F.lit(name))
    return out.otherwise(F.lit(top))


def employee_metrics(source: DataFrame, as_of=None) -> MetricView:
    """The employee metric view: 4 dimensions x 4 measures over curated rows.

    Rows, not employees, are counted (the source is not deduplicated).
    ``total_salary`` is the exact decimal sum; ``avg_salary`` divides that
    exact sum by the non-NULL count in double precision, so the value does
    not depend on partitioning or summation order.
    """
    dims = [
        Dimension("dept_id", lambda t: F.col("dept_id"), "Department ID", "Employee department identifier"),
        Dimension(
            "joining_month",
            lambda t: F.date_trunc("MONTH", F.col("joining_date").cast("timestamp")),
            "Joining Month",
            "Month when employee joined",
        ),
        Dimension("age_bracket", lambda t: _bracket(whole_years_between(t, "dob"), AGE_BRACKETS, AGE_TOP), "Age Bracket"),
        Dimension(
            "tenure_bracket",
            lambda t: _bracket(whole_years_between(t, "joining_date"), TENURE_BRACKETS, TENURE_TOP),
            "Tenure Bracket",
        ),
    ]
    paid = {"__salary": lambda t: F.col("salary"), "__paid": lambda t: F.col("salary").isNotNull().cast("int")}
    measures = [
        Measure(
            "employee_count", lambda t: F.count(F.lit(1)), "Employee Count", "Total number of employees", "number", 0,
            integral=True,
            sums={"__n": lambda t: F.lit(1)},
            finish=lambda of: of("__n"),
        ),
        Measure(
            "total_salary",
            lambda t: F.sum("salary"),
            "Total Salary",
            "Sum of all employee salaries",
            "currency",
            2,
            "USD",
            sums=paid,
            finish=lambda of: F.when(of("__paid") > 0, of("__salary")),
        ),
        Measure(
            "avg_salary",
            lambda t: F.sum("salary").cast("double") / F.count("salary"),
            "Average Salary",
            "Average employee salary",
            "currency",
            2,
            "USD",
            sums=paid,
            finish=lambda of: F.when(of("__paid") > 0, of("__salary").cast("double") / of("__paid")),
        ),
        Measure(
            "avg_tenure_years",
            lambda t: F.avg(whole_years_between(t, "joining_date")),
            "Average Tenure (Years)",
            None,
            "number",
            1,
            sums={
                "__tenure": lambda t: whole_years_between(t, "joining_date").cast("long"),
                "__joined": lambda t: whole_years_between(t, "joining_date").isNotNull().cast("int"),
            },
            finish=lambda of: F.when(of("__joined") > 0, of("__tenure").cast("double") / of("__joined")),
        ),
    ]
    return MetricView(source, dims, measures, as_of=as_of, comment="Employee metrics for HR analytics and reporting")
