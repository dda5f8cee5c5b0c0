"""Date parsing and date arithmetic.

Spark 4 runs with ANSI mode on, where ``to_date``/``cast`` raise on bad input;
the enforcement operators need NULL-on-failure, so the ``try_`` forms are used.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: ColumnOrName, fmt: str) -> Column:
    """String -> date by pattern; NULL when the text does not match."""
    return F.try_to_date(_col(c), fmt)


def parse_timestamp(c: ColumnOrName, fmt: str) -> Column:
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def as_of_column(as_of: str | _dt.date | Column | None) -> Column:
    """Reference date for age/tenure: a literal when given, else current_date()."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.date):
        as_of = as_of.isoformat()
    return F.lit(as_of).cast("date")


def whole_years_between(as_of: Column, c: ColumnOrName) -> Column:
    """floor(months_between(as_of, c) / 12) as bigint (age, tenure)."""
    return F.floor(F.months_between(as_of, _col(c)) / F.lit(12))
