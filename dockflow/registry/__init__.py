"""Registered queries over the test tables, each beside the SQL that checks it."""

from importlib import import_module

MODULES = ["cleaning", "features", "reports", "models", "streams"]


def load():
    """(queries, oracle SQL) with every registry module imported."""
    for name in MODULES:
        import_module(f"dockflow.registry.{name}")
    from dockflow.registry.base import ORACLES, QUERIES

    return QUERIES, ORACLES
