"""All queries over the driver's tables, and SQL of the same results."""

from __future__ import annotations

from .plans import state_queries  # noqa: F401  its queries join the catalog
from .plans.queries import CATALOG, flagship

__all__ = ["flagship", "oracle_sql", "queries"]


def queries() -> dict:
    return {name: f for name, (f, _) in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in CATALOG.items() if sql}
