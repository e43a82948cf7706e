"""Queries over the order-management tables, each with the SQL that gives the same rows."""

from graphloom.plans import algebra, documents, expressions, multigraph, patterns, storage  # noqa: F401
from graphloom.plans.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
