"""Date helpers (all built-in expressions, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_sunday(d: Column) -> Column:
    """Sunday-start week number, 1..54.

    Equals Python's ``%U`` plus one, except that a year starting on a
    Sunday keeps week 1 for its first day (the rule used to build the
    reference data).  ``dayofweek`` counts Sunday as 1.
    """
    return (F.floor((F.dayofyear(d) + F.dayofweek(F.trunc(d, "year")) - 2) / 7) + 1).cast("int")


def week_iso(d: Column) -> Column:
    """ISO-8601 week number (the serving-time rule)."""
    return F.weekofyear(d)


def parse_date(text: Column, fmt: str = "yyyy-MM-dd", default: str | None = None) -> Column:
    """Text -> date; unreadable text gives null (or ``default``)."""
    parsed = F.try_to_date(text, fmt)
    if default is None:
        return parsed
    return F.coalesce(parsed, F.to_date(F.lit(default)))


def date_parts(d: Column, prefix: str = "") -> list[Column]:
    """year, month, quarter, day of week (1 = Sunday)."""
    return [F.year(d).alias(f"{prefix}year"), F.month(d).alias(f"{prefix}month"),
            F.quarter(d).alias(f"{prefix}quarter"), F.dayofweek(d).alias(f"{prefix}weekday")]
