"""All queries of this subpackage."""

from __future__ import annotations

from earshot.llm import cutoff_queries, grouping_queries, leak_queries, mixing_queries, take_queries, toxicity_queries
from earshot.plans.registry import Registry

REGISTRY = Registry()
for _module in (take_queries, grouping_queries, cutoff_queries, leak_queries, mixing_queries, toxicity_queries):
    REGISTRY.update(_module.REGISTRY)
