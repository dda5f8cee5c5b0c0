"""DataFrame -> DataFrame operators (batch; streaming forms live in ``tessera.streaming``)."""

from tessera.operators.changes import (
    assert_append_only,
    change_feed,
    diff_tables,
    join_bounded,
    read_changes,
    skip_change_commits,
)
from tessera.operators.derive import add_derived, employee_derivations, gold_summary, latest_per_key, salary_band
from tessera.operators.metrics import Dimension, Measure, MetricView, employee_metrics
from tessera.operators.ordered import next_in_key
from tessera.operators.quality import (
    bad_rows,
    enforce_schema,
    expect,
    expect_or_drop,
    expect_with_metrics,
    expectation_counts,
    gate_changes,
    good_rows,
    label_changes,
    pass_deletes,
    quarantine_complement,
    split_enforced_changes,
    split_quarantine,
    tag_violations,
)
from tessera.operators.scd import flatten_sequence, gc_tombstones, scd1, scd2, scd2_current

__all__ = [
    "assert_append_only", "change_feed", "diff_tables", "join_bounded", "read_changes", "skip_change_commits",
    "add_derived", "employee_derivations", "gold_summary", "latest_per_key", "salary_band",
    "Dimension", "Measure", "MetricView", "employee_metrics", "next_in_key",
    "bad_rows", "enforce_schema", "expect", "expect_or_drop", "expect_with_metrics", "expectation_counts", "gate_changes", "good_rows",
    "label_changes", "pass_deletes", "quarantine_complement", "split_enforced_changes", "split_quarantine",
    "tag_violations", "flatten_sequence", "gc_tombstones", "scd1", "scd2", "scd2_current",
]
