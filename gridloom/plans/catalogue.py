"""All queries of the engine: name -> (function, DuckDB text)."""

from __future__ import annotations

from gridloom.plans import advanced, analyses, basics, evaluation, files, further  # noqa: F401  registers the queries
from gridloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
