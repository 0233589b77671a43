"""Bucketed facts: joins, groups and windows by the order need no Exchange, also after an append and in a new opening."""

import pytest

from conftest import SF_SMALL
from ledgerline.sources import bucketed as B
from ledgerline.sources.io import scratch_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def facts(spark):
    return B.stored(spark, SF_SMALL)


def exchanges(df):
    # broadcasts of small sides move no table; nothing else may
    return [x for x in plan(df).splitlines() if "Exchange" in x and "BroadcastExchange" not in x]


def test_no_exchange(spark, facts):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(B.order_summary(facts)) == [] and exchanges(B.line_shares(facts)) == []
        assert "SortMergeJoin" in plan(B.order_summary(facts))
        assert len(exchanges(B.ship_priority(facts))) == 1  # the final groups only
        both = facts.lines.join(facts.orders, B.KEY, "left").where("customer_id IS NULL")
        assert exchanges(both) == [] and both.count() == 0
        plain = B.line_rows(spark, SF_SMALL).join(B.order_rows(spark, SF_SMALL), B.KEY)
        assert len(exchanges(plain)) == 2  # what the layout saves
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_all_rows_and_one_file_per_bucket_and_write(spark, facts):
    assert facts.lines.count() == B.line_rows(spark, SF_SMALL).count()
    assert sorted(facts.orders.collect()) == sorted(B.order_rows(spark, SF_SMALL).collect())
    assert len(facts.lines.inputFiles()) <= 2 * facts.buckets


def test_reopened_and_appended(spark):
    base = scratch_path(spark, "bucketed-test")
    lines, orders = B.line_rows(spark, SF_SMALL), B.order_rows(spark, SF_SMALL)
    store = lambda p: (lines.where(p), orders.where(p))
    B.store_facts(*store("order_id % 3 = 0"), base, 4)
    first = B.open_facts(spark, base)
    n = first.lines.count()
    assert 0 < n < lines.count() and first.buckets == 4
    B.append_orders(*store("order_id % 3 <> 0"), base)
    again = B.open_facts(spark, base)
    assert again.lines.count() == lines.count()
    assert sorted(B.order_summary(again).collect()) == sorted(B.order_summary(B.stored(spark, SF_SMALL)).collect())


def test_empty_and_null_keys(spark):
    base = scratch_path(spark, "bucketed-empty")
    lines, orders = B.line_rows(spark, SF_SMALL), B.order_rows(spark, SF_SMALL)
    B.store_facts(lines.where("false"), orders.where("false"), base, 4)
    facts = B.open_facts(spark, base)
    assert facts.lines.count() == 0 and B.order_summary(facts).count() == 0
    null = lines.limit(3).selectExpr("CAST(NULL AS long) AS order_id", *B.LINE_COLUMNS)
    B.append_orders(null, orders.limit(2).selectExpr("CAST(NULL AS long) AS order_id", *B.ORDER_COLUMNS), base)
    facts = B.open_facts(spark, base)
    assert facts.lines.count() == 3 and B.order_summary(facts).count() == 0


def test_bucket_count_grows_with_the_lines():
    assert B.buckets_for(0) == 8 and B.buckets_for(100 << 40) == 409_600
