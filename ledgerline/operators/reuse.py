"""Frames that are used more than once: cached, released, or written and read again."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import numeric as N
from ledgerline.plans import sqltext as S
from ledgerline.plans.lineage import cut, drop_cut
from ledgerline.plans.registry import register
from ledgerline.sources.fact import order_totals


def segment_shares(orders: DataFrame) -> DataFrame:
    """Orders, sales and share of all sales per segment: the frame is read for the segments and for the total."""
    per = orders.groupBy("segment").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("sales").alias("s"))
    total = orders.agg(F.sum("sales").alias("total"))  # one row
    return per.crossJoin(F.broadcast(total)).select(
        "segment", "n_orders", N.money("s").alias("sales"), N.rnd(N.pct("s", "total"), 6).alias("share_pct"))


_SHARES_SQL = S.with_fact(f"""
SELECT segment, COUNT(DISTINCT order_id) AS n_orders, {S.money('SUM(sales)')} AS sales,
       {S.rnd(S.pct('SUM(sales)', 'SUM(SUM(sales)) OVER ()'), 6)} AS share_pct
FROM fact GROUP BY segment""")


def _orders(spark, sf_dir) -> DataFrame:
    return order_totals(spark, sf_dir, ["segment"], ["sales"])


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """``df`` kept in memory, and on disk what does not fit, until the block is left, also by an error."""
    df = df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


@register("perf_cache", sql=_SHARES_SQL)
def _perf_cache(spark, sf_dir):
    """The frame is kept for both of its uses, and given back once their result is written."""
    with cached(_orders(spark, sf_dir)) as orders:
        return cut(segment_shares(orders), "shares")


@register("perf_unpersist", sql=_SHARES_SQL)
def _perf_unpersist(spark, sf_dir):
    """As above, with the storage given back once the result is written."""
    orders = _orders(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cut(segment_shares(orders), "shares")
    finally:
        orders.unpersist()


@register("perf_lineage_cut", sql=_SHARES_SQL)
def _perf_lineage_cut(spark, sf_dir):
    """The frame is written once, read for both uses, and its files are given back once the result is written."""
    orders = cut(_orders(spark, sf_dir), "orders")
    result = cut(segment_shares(orders), "shares")
    drop_cut(orders)
    return result
