"""Registry of the named queries and their oracle SQL."""

from __future__ import annotations

from sieveline.plans import annotation_queries, inventory_queries, item_queries, routing_queries, sampling_queries, scoring_queries

_MODULES = (inventory_queries, sampling_queries, routing_queries, annotation_queries, scoring_queries, item_queries)
QUERIES = {name: f for m in _MODULES for name, f in m.registry.queries.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.registry.oracles.items()}
