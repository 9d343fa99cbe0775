"""Registered queries, each next to the SQL that checks it."""

from threadloom.plans.registry import CATALOG, oracles, queries

from threadloom.plans import (  # noqa: F401  (importing a module registers its queries)
    evaluation_queries,
    preference_queries,
    prompt_queries,
    retrieval_queries,
    rollout_queries,
    table_queries,
    thread_queries,
)

__all__ = ["CATALOG", "oracles", "queries"]
