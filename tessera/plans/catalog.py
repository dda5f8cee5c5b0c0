"""Import every query module so the registry is complete."""

from tessera.plans import q_cdc, q_metrics, q_quality, q_sinks, q_sources, q_streaming  # noqa: F401
from tessera.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
