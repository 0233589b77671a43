"""Plan properties that matter at scale."""

from conftest import SF_SMALL
import __spark_entry__ as E


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pushdown_and_pruning(spark):
    df = E.queries()["src_parquet"](spark, SF_SMALL)
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in txt
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double,l_shipdate" in txt


def test_fact_joins_only_what_is_needed(spark):
    txt = _plan(E.queries()["q02_subcat_extremes"](spark, SF_SMALL))
    assert "orders.parquet" not in txt and "customer.parquet" not in txt
    assert "part.parquet" in txt


def test_rank_filter_becomes_window_group_limit(spark):
    df = E.queries()["q07_top_products"](spark, SF_SMALL)
    df.collect()
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in txt


def test_order_table_never_sorts_the_lines(spark):
    from ledgerline.operators.features import order_table
    txt = _plan(order_table(spark, SF_SMALL))
    assert "SortAggregate" not in txt and "ObjectHashAggregate" not in txt and "Expand" not in txt


def test_main_category_joins_orders_only(spark):
    for name in ("fe_main_category", "join_left_equi"):
        txt = _plan(E.queries()[name](spark, SF_SMALL))
        assert "customer.parquet" not in txt and "nation.parquet" not in txt and "Expand" not in txt


def test_set_sizes_by_masks(spark):
    from pyspark.sql import functions as F

    from ledgerline.operators.features import _set_size
    rows = [(g, n) for g, ns in enumerate([[1, 1, 60], [61, 60, None, 120, 121], [], [None], list(range(1, 181)) * 2]) for n in ns]
    got = spark.createDataFrame(rows, "g int, n int").groupBy("g").agg(_set_size("n", 180).alias("a"), F.countDistinct("n").alias("b"))
    assert all(r["a"] == r["b"] for r in got.collect()) and got.count() == 4
    assert spark.createDataFrame([(1, None)], "g int, n int").groupBy("g").agg(_set_size("n", 0).alias("a")).first()["a"] == 0


def test_history_window_is_split_by_chunk(spark):
    df = E.queries()["win_prior_rows"](spark, SF_SMALL)
    txt = df._jdf.queryExecution().optimizedPlan().toString()
    # the large frame is never windowed by customer alone
    assert "_chunk" in txt


def test_shuffles_grow_with_their_rows(spark, monkeypatch):
    """Lines are dealt by order, and compared rows by all columns, into parts of bounded size."""
    from ledgerline.operators.features import order_table
    from ledgerline.operators.quality import duplicate_summary
    from ledgerline.plans import lineage
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(lineage, "PART_ROWS", n // 17)
    assert lineage.parts_for(0, spark) == 8 and lineage.parts_for(n, spark) in (17, 18)
    plan = order_table(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(order_id" in plan and f", {lineage.parts_for(n, spark)}), REPARTITION_BY_NUM" in plan
    twice = spark.range(100).union(spark.range(40))
    assert tuple(duplicate_summary(twice, 5).first()) == (140, 100, 40)


def test_history_reads_stored_orders(spark):
    """The two sides of the scan read one copy of the order table."""
    from ledgerline.operators.features import order_history, order_table
    files = order_history(order_table(spark, SF_SMALL)).inputFiles()
    assert files and all("/ledgerline-cut/orders-" in f for f in files)
