"""Query catalogue: every operator of the inventory as a named query.

Importing this package registers all queries (``QUERIES``) and their
DuckDB oracles (``ORACLES``).
"""

from emporia.plans.registry import ORACLES, QUERIES  # noqa: F401
from emporia.plans import traffic, dwd, ods, dws, profile, lookups  # noqa: F401

__all__ = ["QUERIES", "ORACLES"]
