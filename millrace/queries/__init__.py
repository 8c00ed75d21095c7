"""Checked queries: each operator over the test tables, with the SQL that gives the same rows."""

from millrace.queries import corpus, files, groups, keyed, landing, reshape, scalars  # noqa: F401
from millrace.queries.registry import QUERIES

__all__ = ["QUERIES"]
