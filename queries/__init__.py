"""Queries over the given tables, one or more per operator."""

from queries import learning, panels, relational, reports, scalar, series  # noqa: F401
from queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
