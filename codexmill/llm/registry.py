"""All queries of this subpackage, by name."""

from __future__ import annotations

from codexmill.llm import queries_forms, queries_leaks, queries_markup, queries_names, queries_neardup, queries_packing, queries_split

_MODULES = [queries_neardup, queries_markup, queries_names, queries_split, queries_forms, queries_leaks, queries_packing]


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracles() -> dict:
    return {k: v for m in _MODULES for k, v in m.ORACLES.items()}
