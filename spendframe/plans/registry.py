"""Named queries: ``name -> (spark, src) -> DataFrame`` and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register a query builder and (optionally) its DuckDB SQL twin."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def add(name: str, fn: Callable, sql: str | None = None) -> None:
    register(name, sql)(fn)


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    for mod in MODULES:
        importlib.import_module(f"spendframe.plans.{mod}")
    if "web_export_json" not in QUERIES:      # made of other queries: registered after all of them
        exports = importlib.import_module("spendframe.plans.exports")
        add("web_export_json", exports.web_export_json, exports._web_export_sql())


MODULES = ["benchmark", "report", "calendar", "exports", "etl", "reconcile"]
