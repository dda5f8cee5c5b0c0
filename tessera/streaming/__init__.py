"""Streaming forms: SCD1 in Spark's state, spliced SCD2 history, stream metrics."""

from tessera.streaming.history import HistoryTable, scd2_stream
from tessera.streaming.metrics import append_with_counts, expectation_totals, observed_totals
from tessera.streaming.state import Scd1State, StateTable, apply_stream, scd1_stream

__all__ = [
    "HistoryTable",
    "Scd1State",
    "StateTable",
    "append_with_counts",
    "apply_stream",
    "expectation_totals",
    "observed_totals",
    "scd1_stream",
    "scd2_stream",
]
