"""The registry the driver reads: every query and every oracle SQL string."""

from __future__ import annotations

from farebox.plans.oracle import aggregate_sql, cleaning_sql
from farebox.plans.oracle_more import more_sql
from farebox.plans.queries import Query, all_queries

__all__ = ["Query", "all_queries", "all_sql"]


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for part in (cleaning_sql, aggregate_sql, more_sql):
        out.update(part())
    return out
