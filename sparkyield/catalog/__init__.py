"""All registered queries."""

from __future__ import annotations

import importlib

from sparkyield.catalog import registry

MODULES = ["team", "lags", "prepare", "models", "evaluate", "profile", "tests", "similarity"]


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"sparkyield.catalog.{name}")


def queries():
    _load()
    return dict(registry.QUERIES)


def oracle_sql():
    _load()
    return dict(registry.SQL)
