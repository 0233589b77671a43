"""Numeric column helpers.

Rounding policy (shared with the DuckDB oracle text in ``plans.sqltext``):
  * exact money (DECIMAL sums) is rounded HALF_UP as a decimal, then cast
    to DOUBLE;
  * ratios and averages are computed as DOUBLE (the same IEEE operations in
    every engine), pinned to 10 decimals, then rounded HALF_UP.
ANSI mode raises on division by zero, so every ratio goes through
``try_divide``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dbl(c) -> Column:
    return _col(c).cast("double")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c, digits: int = 2) -> Column:
    """Round an exact DECIMAL value HALF_UP and return it as DOUBLE."""
    return F.round(_col(c), digits).cast("double")


def rnd(c, digits: int = 2) -> Column:
    """Round a DOUBLE value HALF_UP at ``digits`` (via a 10-decimal pin)."""
    return F.round(_col(c).cast("decimal(38,10)"), digits).cast("double")


def ratio(num, den) -> Column:
    """num / den as DOUBLE; null when den is 0 or null."""
    return F.try_divide(dbl(num), dbl(den))


def pct(num, den) -> Column:
    """100 * num / den as DOUBLE, guarded."""
    return F.try_divide(dbl(num) * F.lit(100.0), dbl(den))


def mean(c) -> Column:
    """Average as DOUBLE: sum / count of non-null values."""
    return F.try_divide(F.sum(_col(c)).cast("double"), F.count(_col(c)))


def growth_pct(cur, prev) -> Column:
    """Percentage change from ``prev`` to ``cur``; null when prev is 0/null."""
    return F.try_divide(dbl(_col(cur) - _col(prev)), dbl(prev)) * F.lit(100.0)


def clamp(c, lo: float, hi: float) -> Column:
    """Winsor clamp; null stays null (``greatest/least`` would skip nulls)."""
    x = _col(c)
    return F.when(x < F.lit(lo), F.lit(lo)).when(x > F.lit(hi), F.lit(hi)).otherwise(x)


def flag(cond: Column) -> Column:
    """Boolean condition -> 1.0 / 0.0 (null counts as false)."""
    return F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0))


def safe_div(num, den, default=None) -> Column:
    """num / den when den > 0, else ``default`` (typed null if None)."""
    fallback = F.lit(default).cast("double") if default is not None else F.lit(None).cast("double")
    return F.when(_col(den) > 0, dbl(num) / dbl(den)).otherwise(fallback)
