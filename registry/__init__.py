"""Named queries over the driver's tables, each next to the SQL that states its result."""

from registry import analytics, bronze, gold, reports, runs, silver  # noqa: F401  (fill the registry)
from registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
