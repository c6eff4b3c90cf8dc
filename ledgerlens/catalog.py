"""One registry of queries and their oracle SQL."""

from __future__ import annotations

from .plans import analyses, control, evaluation, further, handcases, ingest, marts, quality, reconciliation, relational  # noqa: F401  (registers its queries)
from .plans.registry import ORACLE, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
