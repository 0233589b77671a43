"""Cached frames are given back."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import reuse
from ledgerline.plans.registry import queries


def test_cached_until_the_block_is_left(spark):
    df = spark.range(10).select(F.col("id") * 3)
    with reuse.cached(df) as kept:
        assert kept.is_cached and kept.count() == 10
    assert not kept.is_cached
    with pytest.raises(ZeroDivisionError), reuse.cached(spark.range(11)) as kept:
        kept.count()
        1 / 0
    assert not kept.is_cached


def test_perf_cache_leaves_nothing_cached(spark):
    before = spark._jsc.sc().getPersistentRDDs().size()
    assert queries()["perf_cache"](spark, SF_SMALL).count() > 0
    assert spark._jsc.sc().getPersistentRDDs().size() == before


def test_enrichment_without_window_or_sort(spark):
    from ledgerline.streaming.scorer import _snapshot
    plan = _snapshot(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortAggregate" not in plan
