"""All queries of the engine by name, the SQL that says the same, and the flagship."""

from __future__ import annotations

from veilframe.plans import relational_queries, run_queries, scalar_queries, small_queries, state_queries, temporal_queries  # noqa: F401  they register their queries
from veilframe.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]

flagship = QUERIES["flagship_masked_revenue"]
