"""Registry of named queries and their DuckDB oracle text.

Operator modules register their ``(spark, sf_dir) -> DataFrame`` callables
with ``@register(name, sql=...)``.  ``sql=None`` marks an operator that is
not expressible in plain SQL (models, streaming, random sampling); the
driver then checks rows only.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_MODULES = (
    "ledgerline.operators.queries",
    "ledgerline.operators.relational",
    "ledgerline.operators.aggregates",
    "ledgerline.operators.windows",
    "ledgerline.operators.scalars",
    "ledgerline.operators.quality",
    "ledgerline.operators.features",
    "ledgerline.operators.metrics",
    "ledgerline.operators.models",
    "ledgerline.operators.reuse",
    "ledgerline.operators.snapshot",
    "ledgerline.operators.sketches",
    "ledgerline.operators.observed",
    "ledgerline.sources.io",
    "ledgerline.sources.bucketed",
    "ledgerline.sources.rejects",
    "ledgerline.streaming.scorer",
    "ledgerline.streaming.stateful",
)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    for mod in _MODULES:
        importlib.import_module(mod)


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
