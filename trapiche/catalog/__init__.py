"""Queries over the driver's tables, with the SQL they are compared against."""

from trapiche.catalog.oracle import ORACLE_SQL
from trapiche.catalog.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
