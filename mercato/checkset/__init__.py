"""Registered queries with their check SQL."""

from mercato.checkset.registry import QUERIES, SQL
from mercato.checkset import analysis, basics, layers, storage  # noqa: F401  registered on import

__all__ = ["QUERIES", "SQL"]
