"""Registered queries over the given tables."""

from __future__ import annotations

from importlib import import_module
from types import ModuleType

_MODULES = ("q_text", "q_chain", "q_stats", "q_triples", "q_graph", "q_patterns", "q_sources", "q_ml", "q_topics")


def load_all() -> ModuleType:
    """Import every query module and return the catalog they filled."""
    for name in _MODULES:
        import_module(f"textkg.plans.{name}")
    return import_module("textkg.plans.catalog")
