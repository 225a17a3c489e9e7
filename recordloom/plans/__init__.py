"""Registered queries of the record operators."""

from . import case_queries, more_queries, record_queries, table_queries, version_queries  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
