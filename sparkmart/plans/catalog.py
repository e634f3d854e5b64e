"""All named queries of the package."""

from __future__ import annotations

from sparkmart.plans import contract_queries, event_queries, layer_queries, mart_queries, model_queries, statistics_queries
from sparkmart.plans.registry import Query

_AREAS = (mart_queries, layer_queries, contract_queries, event_queries, statistics_queries, model_queries)


def all_queries() -> dict[str, Query]:
    merged: dict[str, Query] = {}
    for area in _AREAS:
        for name, query in area.R.queries.items():
            if name in merged:
                raise ValueError(f"query {name} is registered twice")
            merged[name] = query
    return merged
