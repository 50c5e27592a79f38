"""Registered queries: each operator over whole tables, next to the SQL it must equal."""

from jatoba.queries import conditions, expressions, medallion, nested, relational, sinks  # noqa: F401
from jatoba.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
