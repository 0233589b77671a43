"""The skew-safe ordered scan equals plain windows, with a hot key that
holds a third of the rows and spans many range partitions."""

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.plans.ordered import chunked_scan, ntile_of, ordered_scan


@pytest.fixture(scope="module")
def skewed(spark):
    rows = []
    for i in range(3000):
        # key 0 holds a third of all rows; the rest are spread over 200 keys
        k = 0 if i % 3 == 0 else 1 + (i % 200)
        v = None if i % 17 == 0 else Decimal(i % 101) / Decimal(4)
        rows.append((k, i, v, (i * 7919) % 365))
    return spark.createDataFrame(rows, "k long, o long, v decimal(10,2), d int")


SPEC = {"lag_v": ("lag", "v"), "lead_d": ("lead", "d"), "ps": ("prior_sum", "v"), "pc": ("prior_count", "v"),
        "pmin": ("prior_min", "d"), "pmax": ("prior_max", "d"), "rs": ("run_sum", "v"), "rc": ("run_count", "v"),
        "rn": ("row_number", None)}


def _expected(df, keys, order):
    w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    p = w.rowsBetween(Window.unboundedPreceding, -1)
    u = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", F.lag("v").over(w).alias("lag_v"), F.lead("d").over(w).alias("lead_d"),
                     F.sum("v").over(p).alias("ps"), F.count("v").over(p).alias("pc"),
                     F.min("d").over(p).alias("pmin"), F.max("d").over(p).alias("pmax"),
                     F.sum("v").over(u).alias("rs"), F.count("v").over(u).alias("rc"),
                     F.row_number().over(w).alias("rn"))


def _rows(df):
    cols = ["k", "o", "lag_v", "lead_d", "ps", "pc", "pmin", "pmax", "rs", "rc", "rn"]
    return sorted(tuple(None if r[c] is None else (float(r[c]) if c in ("lag_v", "ps", "rs") else int(r[c]))
                        for c in cols) for r in df.select(*cols).collect())


@pytest.mark.parametrize("ranges", [1, 7, 16])
def test_partitioned_scan_matches_window(spark, skewed, ranges):
    got = ordered_scan(skewed, ["k"], ["d", "o"], SPEC, num_ranges=ranges)
    assert _rows(got) == _rows(_expected(skewed, ["k"], ["d", "o"]))


@pytest.mark.parametrize(("chunk", "partitions"), [("d div 30", 3), ("d div 7", 16), ("0", 1)])
def test_chunked_scan_matches_window(spark, skewed, chunk, partitions):
    """A hot key with a third of the rows, a null key, chunks from one for all to many per key."""
    df = skewed.withColumn("k", F.when(F.col("k") != 5, F.col("k"))).repartition(partitions)
    got = chunked_scan(df, ["k"], ["d", "o"], F.expr(chunk), SPEC)
    exp = _expected(df, ["k"], ["d", "o"]).fillna(-1, ["k"])
    assert _rows(got.fillna(-1, ["k"])) == _rows(exp)


@pytest.mark.parametrize(("chunk", "partitions"), [("d div 30", 3), ("cast(d div 7 as string)", 4)])
def test_chunked_scan_keeps_rows_without_a_chunk(spark, skewed, chunk, partitions):
    df = skewed.withColumn("d", F.when(F.col("o") % 11 != 0, F.col("d") + 7_000)).repartition(partitions)
    got = chunked_scan(df, ["k"], ["d", "o"], F.expr(chunk), SPEC)
    exp = _expected(df, ["k"], ["d", "o"])
    assert sorted(map(str, got.collect())) == sorted(map(str, exp.collect()))


def test_chunked_scan_splits_the_hot_key_and_shuffles_the_rows_once(spark, skewed):
    rows = skewed.withColumn("wide", F.repeat(F.lit("x"), 100))
    got = chunked_scan(rows, ["k"], ["d", "o"], F.expr("d div 30"), SPEC)
    plan = got._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange" in x]
    assert not any("rangepartitioning" in x for x in exchanges)
    # the rows once; the narrow totals by chunk, by key for their windows, and back by chunk
    assert sum("hashpartitioning(_k" in x for x in exchanges) <= 4
    assert rows.select("k", F.expr("d div 30")).where("k = 0").distinct().count() > 10


def test_hot_key_really_spans_chunks(spark, skewed):
    # the range partitioner must split key 0 over several partitions
    ranged = skewed.repartitionByRange(16, "k", "d", "o").withColumn("p", F.spark_partition_id())
    assert ranged.where("k = 0").select("p").distinct().count() > 3


def test_global_scan_matches_window(spark, skewed):
    got = ordered_scan(skewed, [], [F.desc("d"), F.asc("o")], SPEC, num_ranges=9)
    exp = _expected(skewed, [], [F.desc("d"), F.asc("o")])
    assert _rows(got) == _rows(exp)


@pytest.mark.parametrize("n", [1, 9, 10, 11, 14743, 25])
def test_ntile_formula(spark, n):
    df = spark.range(1, n + 1)
    got = df.select("id", ntile_of(F.col("id"), F.lit(n), 10).alias("t"))
    exp = df.select("id", F.ntile(10).over(Window.orderBy("id")).alias("t"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_results_are_stable_after_recompute(spark, skewed):
    got = ordered_scan(skewed, ["k"], ["d", "o"], {"rn": ("row_number", None)}, num_ranges=8)
    assert sorted(got.collect()) == sorted(got.collect())


def test_dense_rank_by_matches_window(spark, skewed):
    from ledgerline.plans.ordered import dense_rank_by
    df = skewed.withColumn("v", F.col("d") % 13)  # many ties, hot key 0
    got = dense_rank_by(df, ["k"], "v", out="r", num_ranges=11)
    exp = df.withColumn("r", F.dense_rank().over(Window.partitionBy("k").orderBy(F.desc("v"))))
    key = lambda rows: sorted((r["k"], r["o"], r["r"]) for r in rows)
    assert key(got.collect()) == key(exp.collect())
