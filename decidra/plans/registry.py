"""The registry of the core's queries and their SQL."""

from __future__ import annotations

from decidra.plans import adapter_queries, decision_queries, event_queries, judgment_queries, nested_queries, quality_queries, replay_queries, rule_queries, source_queries, split_queries, text_queries
from decidra.plans.base import Query

_CATALOGUES = (split_queries.C, decision_queries.C, text_queries.C, event_queries.C, source_queries.C, quality_queries.C, rule_queries.C, judgment_queries.C, replay_queries.C, adapter_queries.C)


def queries() -> dict[str, Query]:
    out = dict(nested_queries.queries())
    for c in _CATALOGUES:
        out |= c.queries
    return out


def oracle_sql() -> dict[str, str]:
    return nested_queries.oracle_sql() | {k: v for c in _CATALOGUES for k, v in c.sql.items()}
