"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import sys
import types
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: A side of at most this many narrow rows may be broadcast (a few MB).
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def byte_rows(column: pa.Array) -> list[bytes | None]:
    """The rows of a string column as UTF-8 bytes, null as None."""
    return column.cast(pa.large_binary()).to_pylist()


_STATE = "_ledgerline_worker_state"


def worker_cache(key, make):
    """What ``make()`` returned for this key in an earlier task of a reused Python worker, else its result now.

    A worker keeps one such cache, that of the last key; it only saves time.
    """
    state = sys.modules.setdefault(_STATE, types.ModuleType(_STATE))
    if getattr(state, "key", None) != key:
        forget_worker_cache()  # before the next one is made
        state.cache, state.key = make(), key
    return state.cache


def forget_worker_cache() -> None:
    """Drop what ``worker_cache`` keeps, for steps that need the memory and not the cache."""
    state = sys.modules.get(_STATE)
    if getattr(state, "cache", None) is not None:
        state.cache = state.key = None
        give_back_memory()


def give_back_memory() -> None:
    """Return memory that this worker has freed to the system: an idle worker lives on beside the next steps."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count of its rows allows it, else as it is (a shuffle join)."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def row_groups(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that a worker unpacks few texts at a time; after the last one
    what was freed goes back to the system."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    batch = None
    give_back_memory()


#: Rows that are sent to a Python worker at a time where rows hold whole texts.
TEXT_ROWS = 1_000


@contextmanager
def few_rows_at_once(spark: SparkSession, rows: int = TEXT_ROWS):
    """Frames written inside send their Python workers at most ``rows`` rows at a time, so that neither side of the
    socket holds many texts; the session's number is set again afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(was)) if int(was) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, was)


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as an empty text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh_name(columns: list[str], stem: str) -> str:
    """A column name that no column has, whatever its case."""
    taken = {c.lower() for c in columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name
