"""All queries of the core by name."""

from __future__ import annotations

from corpusloom.plans import corpus_queries, source_queries, table_queries  # noqa: F401
from corpusloom.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
