"""Library aggregates without a registered SQL form."""

import math
import random

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerline.operators.aggregates import exact_quantiles, summary_long
from ledgerline.plans.lineage import cut, drop_cut
from ledgerline.sources.fact import order_lines, order_totals, part_totals
from ledgerline.sources.io import path_exists
from pyspark.sql import functions as F


def test_summary_has_ordered_quartiles(spark):
    rows = {r["column_name"]: r for r in summary_long(order_lines(spark, SF_SMALL, ["sales", "quantity"]),
                                                      ["sales", "quantity"]).collect()}
    for r in rows.values():
        assert r["min"] <= r["p25"] <= r["p50"] <= r["p75"] <= r["max"]
    assert rows["quantity"]["n"] == order_lines(spark, SF_SMALL, ["quantity"]).count()


def test_pre_aggregated_totals_equal_line_sums(spark):
    lines = order_lines(spark, SF_SMALL, ["market", "category", "sales", "profit"])
    by_market = {r[0]: r[1] for r in lines.groupBy("market").agg(F.sum("profit")).collect()}
    o = order_totals(spark, SF_SMALL, ["market"], ["profit"]).groupBy("market").agg(F.sum("profit"))
    assert {r[0]: r[1] for r in o.collect()} == by_market
    by_cat = {r[0]: r[1] for r in lines.groupBy("category").agg(F.sum("profit")).collect()}
    p = part_totals(spark, SF_SMALL, ["category"], ["profit"]).groupBy("category").agg(F.sum("profit"))
    assert {r[0]: r[1] for r in p.collect()} == by_cat


def _nearest_rank(values, p):
    values = sorted(v for v in values if v is not None)
    return values[max(1, math.ceil(p * len(values))) - 1]


@pytest.mark.parametrize(("accuracy", "bracket_rows"), [(10_000, 100_000), (20, 5), (3, 1)])
def test_exact_quantiles(spark, accuracy, bracket_rows):
    """Half of the rows hold one value; brackets are refined, missed and shrunk to it."""
    rnd = random.Random(1)
    rows = [(7.5 if i % 2 else rnd.gauss(0, 10), None if i % 9 == 0 else rnd.randrange(50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b int")
    probs = [0.0, 0.01, 0.3, 0.5, 0.77, 0.99, 1.0]
    got = {(r["column_name"], r["p"]): r["value"] for r in exact_quantiles(
        df.withColumn("b", F.col("b").cast("double")), ["a", "b"], probs, accuracy, bracket_rows).collect()}
    assert got == {(c, p): _nearest_rank([r[i] for r in rows], p) for i, c in enumerate("ab") for p in probs}


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([(None,)], "a double"), ["a"], [0.5]).count() == 0


def test_distinct_counts_without_expand(spark):
    for name in ("agg_multi_distinct", "agg_global", "dq_structure", "dq_profile"):
        plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan, name


def test_verdict_scans_the_lines_a_few_times(spark):
    plan = E.queries()["dq_verdict"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") <= 5


def test_storage_and_files_are_given_back(spark):
    jsc = spark.sparkContext._jsc  # its persistent RDDs as a Java map
    spark.catalog.clearCache()
    want = sorted(map(tuple, E.queries()["perf_cache"](spark, SF_SMALL).collect()))
    assert len(jsc.getPersistentRDDs()) == 0
    assert sorted(map(tuple, E.queries()["perf_unpersist"](spark, SF_SMALL).collect())) == want
    assert len(jsc.getPersistentRDDs()) == 0
    orders = cut(spark.range(5))
    assert path_exists(spark, orders._cut_path)
    drop_cut(orders)
    assert not path_exists(spark, orders._cut_path)
    assert sorted(map(tuple, E.queries()["perf_lineage_cut"](spark, SF_SMALL).collect())) == want
