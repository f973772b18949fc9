"""Every registered query with the SQL that must give the same result."""

from granary.catalog import landing, operations, publication, quality, sales, silver, streams  # noqa: F401
from granary.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
