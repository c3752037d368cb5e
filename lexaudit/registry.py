"""The core's queries by name, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under a name."""

    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def load_all() -> None:
    """Imports every module that registers queries."""
    import importlib

    for name in MODULES:
        importlib.import_module(name)


MODULES = ["lexaudit.plans.general", "lexaudit.plans.audit", "lexaudit.plans.more"]
