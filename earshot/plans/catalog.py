"""All queries of the library itself."""

from __future__ import annotations

from earshot.plans import aggregate_queries, filter_queries, score_queries, similarity_queries, skew_queries, stream_queries, window_queries
from earshot.plans.registry import Registry


def core_registry() -> Registry:
    registry = Registry()
    for module in (score_queries, aggregate_queries, window_queries, filter_queries, similarity_queries, stream_queries, skew_queries):
        registry.update(module.REGISTRY)
    return registry
