"""Registry of named queries and their DuckDB oracle twins.

Modules declare queries with ``@query(name, oracle=SQL)``; importing
``quarry.catalog`` loads every module so the registry is complete.  A query
with ``oracle=None`` has no SQL twin (it is checked by tests instead).
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    fn: QueryFn
    oracle: str | None
    tier: str


_REGISTRY: dict[str, Entry] = {}

_MODULES = (
    "quarry.operators.relational",
    "quarry.operators.joins",
    "quarry.operators.aggregates",
    "quarry.operators.windows",
    "quarry.operators.sets",
    "quarry.operators.subqueries",
    "quarry.functions.scalar",
    "quarry.functions.udfs",
    "quarry.functions.variant",
    "quarry.operators.sketches",
    "quarry.sources.sinks",
    "quarry.streaming.queries",
    "quarry.search.knn",
    "quarry.search.containment",
)


def query(name: str, oracle: str | None = None, tier: str = "batch"):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Entry(name, fn, oracle, tier)
        return fn
    return deco


def _load() -> dict[str, Entry]:
    for m in _MODULES:
        importlib.import_module(m)
    return _REGISTRY


def entries() -> dict[str, Entry]:
    return dict(_load())


def queries() -> dict[str, QueryFn]:
    return {k: e.fn for k, e in _load().items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.oracle for k, e in _load().items() if e.oracle}
