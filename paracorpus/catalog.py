"""All queries of the engine's own operators, with their oracle SQL."""

from __future__ import annotations

from .plans import pair_queries, text_queries  # noqa: F401
from .plans.registry import ORACLE, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
