"""Rule predicates given as SQL text or Columns, with three-valued logic kept.

A rule is "passed" only when it evaluates to TRUE; NULL counts as not passed
(that is how a filter and an expectation treat it).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(rule: str | Column) -> Column:
    return F.expr(rule) if isinstance(rule, str) else rule


def all_true(rules: Mapping[str, str | Column] | list) -> Column:
    """AND of the bare predicates (keeps them pushable into a Parquet scan)."""
    cols = [as_column(r) for r in (rules.values() if isinstance(rules, Mapping) else rules)]
    return reduce(lambda a, b: a & b, cols) if cols else F.lit(True)


def not_true(c: Column) -> Column:
    """TRUE when c is FALSE or NULL."""
    return ~F.coalesce(c, F.lit(False))


def rule_labels(rules: Mapping[str, str | Column], sep: str = "; ") -> Column:
    """Names of every rule whose predicate is TRUE, joined by ``sep`` in rule order.

    ``concat_ws`` skips NULL entries, so a rule evaluating NULL adds nothing.
    """
    parts = [F.when(as_column(cond), F.lit(name)) for name, cond in rules.items()]
    return F.concat_ws(sep, F.array(*parts)) if parts else F.lit("")
