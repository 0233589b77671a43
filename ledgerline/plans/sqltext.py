"""DuckDB text helpers for the oracle SQL, mirroring ``functions.numeric``."""

from __future__ import annotations

from ledgerline.sources.fact import FACT_CTE_SQL


def with_fact(body: str, *ctes: str) -> str:
    """Prefix ``body`` with the fact CTE and any extra named CTEs."""
    parts = [FACT_CTE_SQL, *ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


def money(x: str, d: int = 2) -> str:
    return f"CAST(ROUND({x}, {d}) AS DOUBLE)"


def rnd(x: str, d: int = 2) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {d}) AS DOUBLE)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str) -> str:
    return f"((CAST({a} AS DOUBLE) * 100.0) / NULLIF(CAST({b} AS DOUBLE), 0))"


def mean(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def growth_pct(cur: str, prev: str) -> str:
    return f"((CAST({cur} - {prev} AS DOUBLE) / NULLIF(CAST({prev} AS DOUBLE), 0)) * 100.0)"


def spark_dow(d: str) -> str:
    """Spark's dayofweek (Sunday = 1) in DuckDB (Sunday = 0)."""
    return f"(dayofweek({d}) + 1)"
