"""Sketches merge without the lines; figures of a write are those of a scan; rows and rejects are all lines."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import observed as O
from ledgerline.operators import sketches as K
from ledgerline.operators.quality import count_violations
from ledgerline.plans.lineage import cut
from ledgerline.plans.versioned import newest
from ledgerline.sources import rejects as R
from ledgerline.sources.fact import order_lines
from ledgerline.sources.fixtures import dirty_lines
from ledgerline.sources.io import scratch_path


def ranks(values, x):
    return sum(v < x for v in values) / len(values), sum(v <= x for v in values) / len(values)


def test_quantiles_of_any_range_of_months(spark):
    lines = order_lines(spark, SF_SMALL, ["order_date", "sales", "customer_id"])
    stored = cut(K.month_sketches(lines, ["sales"], ["customer_id"]))
    for first, last in (("1995-01-01", "2001-12-01"), ("1997-03-01", "1997-05-01"), ("1999-01-01", "1999-01-01")):
        months = stored.where(F.col("month").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        one = K.merged(months)
        assert all("sketch" in f or "cut" in f for f in one.inputFiles())  # the lines are not read again
        inside = lines.where(F.trunc("order_date", "month").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        values = sorted(float(r["sales"]) for r in inside.select("sales").collect())
        assert one.first()["n"] == len(values)
        for r in K.quantiles(one, "sales", [0, .1, .5, .9, 1]).collect():
            below, upto = ranks(values, r["value"])
            assert below - K.RANK_ERROR <= r["p"] <= upto + K.RANK_ERROR
        assert one.select(F.theta_sketch_estimate("d_customer_id")).first()[0] == inside.select("customer_id").distinct().count()


def test_new_lines_are_merged_alone(spark):
    lines = order_lines(spark, SF_SMALL, ["order_id", "order_date", "sales"])
    old, new = (cut(K.month_sketches(lines.where(p), ["sales"], ["order_id"])) for p in ("order_id % 3 <> 0", "order_id % 3 = 0"))
    both = K.merged(old.unionByName(new), F.col("month")).select("month", "n", F.theta_sketch_estimate("d_order_id").alias("d"))
    whole = lines.groupBy(F.trunc("order_date", "month").alias("month")).agg(F.count("*").alias("n"), F.countDistinct("order_id").alias("d"))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, whole.collect()))


def test_returning_customers_exactly_while_few(spark):
    lines = order_lines(spark, SF_SMALL, ["order_date", "customer_id"])
    got = {r["year"]: tuple(r)[1:] for r in K.returning(K.month_sketches(lines, [], ["customer_id"]), "customer_id").collect()}
    years = {}
    for r in lines.select(F.year("order_date").alias("y"), "customer_id").distinct().collect():
        years.setdefault(r["y"], set()).add(r["customer_id"])
    for y, keys in years.items():
        ever = set().union(*[v for k, v in years.items() if k < y])
        assert got[y] == (len(keys), len(keys & years.get(y - 1, set())), len(keys - ever))


def test_nulls_and_empty(spark):
    rows = spark.createDataFrame([("2020-01-05", None, None), ("2020-01-07", 3.0, 1), (None, 4.0, 2)], "d string, v double, k int") \
        .select(F.col("d").cast("date").alias("order_date"), "v", "k")
    s = cut(K.month_sketches(rows, ["v"], ["k"]))
    got = {str(r["month"]): (r["n"], r["d"]) for r in s.select("month", "n", F.theta_sketch_estimate("d_k").alias("d")).collect()}
    assert got == {"2020-01-01": (2, 1), "None": (1, 1)}
    assert K.quantiles(K.merged(s), "v", [0.5]).first()["value"] in (3.0, 4.0)
    assert K.month_sketches(rows.limit(0), ["v"], ["k"]).count() == 0


def test_figures_of_a_write_are_those_of_a_scan(spark):
    df = dirty_lines(spark, SF_SMALL)
    path = scratch_path(spark, "observed")
    found = O.write_observed(df, path, O.all_rules())
    assert found.pop("rows") == df.count() == spark.read.parquet(path).count()
    assert found == {r["rule"]: r["n_violations"] for r in count_violations(df, O.all_rules()).collect()}
    assert sum(found.values()) > 0


def test_held_back_or_published(spark):
    df, rules = dirty_lines(spark, SF_SMALL), [("discount_null", F.col("discount").isNull()), ("none", F.lit(None).cast("boolean"))]
    base = scratch_path(spark, "held")
    version, found = O.publish_if(df, base, rules, {})
    assert version is None and newest(spark, base) is None and found["discount_null"] > 0 and found["none"] == 0
    share = found["discount_null"] / found["rows"]
    assert O.publish_if(df, base, rules, {"discount_null": share})[0] == 0 == newest(spark, base)
    assert O.publish_if(df.limit(0), base, rules, {})[0] == 1


@pytest.mark.parametrize("rows", [[
    ("1,2000-01-31,1.5,2,EU", None), ("2,2000-02-30x,1.5,2,EU", "bad order_date"), ("3,2000-01-31,x,2,EU", "bad sales"),
    ("4,2000-01-31,1.5,2.5,EU", "bad quantity"), ("5,2000-01-31,1.5", "number of fields"), ("6,2000-01-31,1.5,2,EU,7", "number of fields"),
    (",2000-01-31,1.5,2,EU", "no order_id"), ("8,,,,", None), ("9,2000-01-31,1.5,2,\"a,b\"", None), ("junk", "number of fields")]])
def test_rows_and_rejects_are_all_lines(spark, rows):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([(line,) for line, _ in rows], "value string").repartition(3).write.text(path)
    good, bad = R.read_checked(spark, path, R.SCHEMA, "headless", required=("order_id",))
    got = {r["line"]: r["reject_reason"] for r in bad.collect()}
    assert sorted(got.values()) == sorted(x for _, x in rows if x)
    assert {k: v for k, v in got.items() if not k.startswith('"') and k[:1] != ","} == {
        line: x for line, x in rows if x and line[:1] != ","}
    assert sorted(str(r["order_id"]) for r in good.collect()) == sorted(line.split(",")[0] for line, x in rows if not x)
    assert good.count() + bad.count() == len(rows) and good.columns == R.SCHEMA.names


def test_no_lines(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([], "value string").write.text(path)
    good, bad = R.read_checked(spark, path, R.SCHEMA, "headless")
    assert good.count() == bad.count() == 0
