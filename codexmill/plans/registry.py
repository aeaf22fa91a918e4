"""All queries of the core, by name."""

from __future__ import annotations

from codexmill.plans import orphan_queries, profile_queries, store_queries, structure_queries

_MODULES = [orphan_queries, structure_queries, profile_queries, store_queries]


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracles() -> dict:
    return {k: v for m in _MODULES for k, v in m.ORACLES.items()}


FLAGSHIP = structure_queries.full_tree
