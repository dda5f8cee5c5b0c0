"""Column-expression helpers (all JVM-side Catalyst expressions)."""

from tessera.functions.dates import parse_date, parse_timestamp, whole_years_between
from tessera.functions.rules import all_true, as_column, not_true, rule_labels

__all__ = [
    "parse_date",
    "parse_timestamp",
    "whole_years_between",
    "all_true",
    "as_column",
    "not_true",
    "rule_labels",
]
