"""Quantiles and distinct counts from stored sketches that merge over any range of months.

The lines are scanned once, into one row per month: quantile sketches (KLL)
of the measures and theta sketches of the keys.  Every later question about a
range of months reads those rows only: sketches of disjoint rows merge
without loss of their error bound, theta sketches also intersect and
subtract.  A month that gets new lines is sketched from them alone and merged.

Bounds: a KLL sketch of size k has a rank error of about 1.65 % at k = 200
(99 % confidence); the default here, 800, about 0.5 %.  A theta sketch of 2**12
entries counts up to 4096 keys exactly and beyond that with a relative error of about
3 % (95 %).  Both have a size that does not grow with the rows.

Cases: null measures and keys are not counted; a month without values has no
row; an empty range gives null quantiles and a count of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import numeric as N
from ledgerline.plans import sqltext as S
from ledgerline.plans.lineage import cut
from ledgerline.plans.registry import register
from ledgerline.sources.fact import order_lines

K = 800
RANK_ERROR = 0.015
LOG_ENTRIES = 12


def month_sketches(lines: DataFrame, measures: list[str], keys: list[str], date: str = "order_date", k: int = K) -> DataFrame:
    """One row per month: n, q_<measure>, d_<key>."""
    return lines.groupBy(F.trunc(date, "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(N.dbl(m), F.lit(k)).alias(f"q_{m}") for m in measures],
        *[F.theta_sketch_agg(c, F.lit(LOG_ENTRIES)).alias(f"d_{c}") for c in keys])


def merged(sketches: DataFrame, *by: Column) -> DataFrame:
    """Sketches of the groups ``by`` of months, in the columns of ``month_sketches``."""
    cols = [c for c in sketches.columns if c[:2] in ("q_", "d_")]
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), *[
        (F.kll_merge_agg_double(c) if c.startswith("q_") else F.theta_union_agg(c)).alias(c) for c in cols])


def quantiles(sketches: DataFrame, measure: str, probabilities: list[float], *keep: str) -> DataFrame:
    """keep, p, value: the estimated quantiles of each row of sketches."""
    return sketches.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double(f"q_{measure}", F.lit(float(p))).alias("value"))
        for p in probabilities])))


def winsor_bounds(sketches: DataFrame, measure: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """lo, hi (one row) over all months of ``sketches``."""
    one = merged(sketches)
    return one.select(*[F.kll_sketch_get_quantile_double(f"q_{measure}", F.lit(p)).alias(c) for p, c in ((low, "lo"), (high, "hi"))])


def returning(sketches: DataFrame, key: str) -> DataFrame:
    """year, n_keys, n_returning (also seen in the year before), n_new (never seen before), by set operations on sketches."""
    years = merged(sketches, F.year("month").alias("year"))
    before = merged(years.alias("y").join(years.alias("b"), F.col("b.year") < F.col("y.year")).select(
        F.col("y.year").alias("year"), F.col("b.n").alias("n"), *[F.col(f"b.d_{key}").alias(f"d_{key}")]), F.col("year"))
    last = years.select((F.col("year") + 1).alias("year"), F.col(f"d_{key}").alias("last"))
    rows = years.select("year", F.col(f"d_{key}").alias("own")).join(last, "year", "left") \
        .join(before.select("year", F.col(f"d_{key}").alias("ever")), "year", "left")
    count = lambda c: F.coalesce(F.theta_sketch_estimate(c), F.lit(0)).cast("bigint")
    return rows.select("year", count(F.col("own")).alias("n_keys"),
                       count(F.theta_intersection("own", "last")).alias("n_returning"),
                       F.when(F.col("ever").isNull(), count(F.col("own")))
                       .otherwise(count(F.theta_difference("own", "ever"))).alias("n_new"))


# --------------------------------------------------------------- registered

PROBABILITIES = [0.01, 0.25, 0.5, 0.75, 0.99]


def _stored(spark, sf_dir, measures=("sales", "shipping_cost"), keys=()) -> DataFrame:
    lines = order_lines(spark, sf_dir, [*{"order_date", *measures, *keys}])
    return cut(month_sketches(lines, list(measures), list(keys)), "sketches")


@register("agg_quantile_sketch", sql=S.with_fact("""
SELECT CAST(year(order_date) AS INTEGER) AS year, p, COUNT(*) AS n, TRUE AS within
FROM fact, (VALUES (CAST(0.01 AS DOUBLE)), (0.25), (0.5), (0.75), (0.99)) v(p) GROUP BY ALL"""))
def _agg_quantile_sketch(spark, sf_dir):
    """Quantiles of sales per year from monthly sketches, and whether their true rank is within the stated error."""
    q = quantiles(merged(_stored(spark, sf_dir), F.year("month").alias("year")), "sales", PROBABILITIES, "year")
    found = cut(q, "sketch-quantiles")  # 5 rows a year
    lines = order_lines(spark, sf_dir, ["order_date", "sales"]).select(F.year("order_date").alias("year"), N.dbl("sales").alias("x"))
    ranks = lines.join(F.broadcast(found), "year").groupBy("year", "p").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") < F.col("value")).alias("below"),
        F.count_if(F.col("x") <= F.col("value")).alias("upto"))
    # a value that holds many rows has all ranks from below to upto
    return ranks.select("year", "p", "n", ((F.col("below") / F.col("n") <= F.col("p") + RANK_ERROR)
                                           & (F.col("upto") / F.col("n") >= F.col("p") - RANK_ERROR)).alias("within"))


@register("fe_winsorize_sketch", sql=S.with_fact("""
SELECT p, COUNT(*) AS n, TRUE AS within
FROM fact, (VALUES (CAST(0.01 AS DOUBLE)), (0.99)) v(p) WHERE order_date < DATE '1999-01-01' GROUP BY p"""))
def _fe_winsorize_sketch(spark, sf_dir):
    """Bounds of the training months' shipping cost from their sketches, with the true rank of each."""
    start = F.lit("1999-01-01").cast("date")
    train = _stored(spark, sf_dir).where(F.col("month") < start)
    bounds = winsor_bounds(train, "shipping_cost")  # one row
    lines = order_lines(spark, sf_dir, ["order_date", "shipping_cost"]).where(F.col("order_date") < start)
    x = N.dbl("shipping_cost")
    one = lines.crossJoin(F.broadcast(bounds)).agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(cmp(x, F.col(c))).alias(f"{c}_{name}") for c in ("lo", "hi")
        for name, cmp in (("below", lambda a, b: a < b), ("upto", lambda a, b: a <= b))])
    ok = lambda c, p: (F.col(f"{c}_below") / F.col("n") <= p + RANK_ERROR) & (F.col(f"{c}_upto") / F.col("n") >= p - RANK_ERROR)
    return one.select(F.inline(F.array(*[F.struct(F.lit(p).alias("p"), F.col("n"), ok(c, p).alias("within"))
                                         for c, p in (("lo", 0.01), ("hi", 0.99))])))


@register("agg_distinct_sketch", sql=S.with_fact("""
SELECT CAST(y.year AS INTEGER) AS year, TRUE AS keys_within, TRUE AS returning_within, TRUE AS new_within
FROM (SELECT DISTINCT year(order_date) AS year FROM fact) y"""))
def _agg_distinct_sketch(spark, sf_dir):
    """Customers per year, those of the year before among them and new ones, from monthly sketches, against exact counts."""
    found = returning(_stored(spark, sf_dir, measures=(), keys=("customer_id",)), "customer_id")
    years = order_lines(spark, sf_dir, ["order_date", "customer_id"]).where("customer_id IS NOT NULL").select(
        F.year("order_date").alias("year"), "customer_id").distinct()
    last = years.select((F.col("year") + 1).alias("year"), "customer_id", F.lit(True).alias("seen"))
    first = years.groupBy("customer_id").agg(F.min("year").alias("first"))
    exact = years.join(last, ["year", "customer_id"], "left").join(first, "customer_id").groupBy("year").agg(
        F.count(F.lit(1)).alias("e_keys"), F.count_if(F.col("seen")).alias("e_returning"),
        F.count_if(F.col("first") == F.col("year")).alias("e_new"))
    # intersections and differences have the error of the sets they are taken from
    near = lambda c, e: F.abs(F.col(c) - F.col(e)) <= 0.05 * F.col("e_keys") + 0.05 * F.col(e)
    return found.join(exact, "year").select("year", near("n_keys", "e_keys").alias("keys_within"),
                                            near("n_returning", "e_returning").alias("returning_within"),
                                            near("n_new", "e_new").alias("new_within"))
