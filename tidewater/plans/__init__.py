from tidewater.plans import aggregates, alarms, late, matching, rows, windows  # noqa: F401  (each registers its queries)
from tidewater.plans.registry import QUERIES, Query

__all__ = ["QUERIES", "Query"]
