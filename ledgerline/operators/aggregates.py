"""Aggregation operators (survey 2.4).

All of them are single ``groupBy().agg()`` plans with partial (map-side)
aggregation, so a hot group is combined per task before the shuffle.
Where the reference ran one job per statistic (correlation pairs, per-slice
loops), the library computes every statistic in one aggregation.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import numeric as N
from ledgerline.plans import sqltext as S
from ledgerline.plans.ordered import ordered_scan
from ledgerline.plans.registry import register
from ledgerline.sources.fact import fact_column, order_lines, order_lines_side, order_totals, part_totals, read_table
from ledgerline.sources.fixtures import DIRTY_CTE_SQL, dirty_lines

NUMERIC = ["sales", "profit", "quantity", "discount", "shipping_cost"]

# ----------------------------------------------------------------- library


def corr_matrix(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every pair in ONE aggregation, long form."""
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[F.corr(N.dbl(a), N.dbl(b)).alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) AS (col_a, col_b, corr)") \
        .withColumn("corr", N.rnd("corr", digits))


def describe_long(df: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    """count / mean / stddev / min / max per column, numeric and long form."""
    aggs = []
    for c in cols:
        x = N.dbl(c)
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stack = ", ".join(
        f"'{c}', CAST(`{c}__count` AS BIGINT), `{c}__mean`, `{c}__stddev`, `{c}__min`, `{c}__max`"
        for c in cols)
    out = wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, n, mean, stddev, min, max)")
    for c in ("mean", "stddev", "min", "max"):
        out = out.withColumn(c, N.rnd(c, digits))
    return out


def summary_long(df: DataFrame, cols: list[str], probs=(0.25, 0.5, 0.75), accuracy: int = 10000,
                 digits: int = 4) -> DataFrame:
    """``describe`` plus quartiles (Spark's ``summary``), numeric and long
    form, in one aggregation; quartiles come from a bounded-memory sketch."""
    base = describe_long(df, cols, digits)
    q = df.agg(*[F.percentile_approx(N.dbl(c), list(probs), accuracy).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    qs = q.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, q)").select(
        "column_name", *[N.rnd(F.col("q")[i], digits).alias(f"p{int(p * 100)}") for i, p in enumerate(probs)])
    return base.join(qs, "column_name")  # one row per column on both sides


QUANTILE_ACCURACY = 10_000
BRACKET_ROWS = 100_000


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], accuracy: int = QUANTILE_ACCURACY,
                    bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """Exact nearest-rank quantiles (value at rank max(1, ceil(p * n))): column_name, p, value.

    Nothing is sorted or written.  One sketch pass brackets all quantiles of
    all columns; a count of the rows below and inside each bracket makes the
    brackets exact, and while one holds more than ``bracket_rows`` rows of
    different values it is bracketed again.  A value repeated any number of
    times is counted, not ranked: a bracket shrinks to it.  The rows left in
    a bracket are grouped by value and their counts summed up to the rank.
    Columns without values give no row.
    """
    def around(p: float, wide: int = 1) -> list[float]:
        return [max(0.0, p - 2.0 * wide / accuracy), min(1.0, p + 2.0 * wide / accuracy)]

    grid = [q for p in probs for q in around(p)]
    first = df.agg(*[x for c in cols for x in (
        F.count(c).alias(f"n_{c}"), F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"),
        F.percentile_approx(c, grid, accuracy).alias(f"q_{c}"))]).first()
    whole = {c: (first[f"lo_{c}"], first[f"hi_{c}"]) for c in cols}
    rank = {(c, p): max(1, math.ceil(p * first[f"n_{c}"])) for c in cols for p in probs if first[f"n_{c}"]}
    bracket = {(c, p): tuple(first[f"q_{c}"][2 * i:2 * i + 2]) for c in cols for i, p in enumerate(probs) if (c, p) in rank}
    below: dict = {}
    crowded = False  # whether a bracket may hold any number of different values
    wide = dict.fromkeys(rank, 1)
    open_ones = list(rank)
    while open_ones:
        inside = {k: F.col(k[0]).between(*map(F.lit, bracket[k])) for k in open_ones}
        counts = df.agg(*[x for i, k in enumerate(open_ones) for x in (
            F.count_if(F.col(k[0]) < F.lit(bracket[k][0])).alias(f"b{i}"), F.count_if(inside[k]).alias(f"n{i}"))]).first()
        again, finer = [], []
        for i, k in enumerate(open_ones):
            lo, hi = bracket[k]
            if not counts[f"b{i}"] < rank[k] <= counts[f"b{i}"] + counts[f"n{i}"]:
                bracket[k] = whole[k[0]]  # the sketch missed: start from everything, with wider brackets
                wide[k] *= 4
                again.append(k)
            elif lo == hi or counts[f"n{i}"] <= bracket_rows:
                below[k] = counts[f"b{i}"]
            else:
                finer.append((k, (rank[k] - counts[f"b{i}"]) / counts[f"n{i}"]))
        if finer:
            sketch = df.agg(*[F.percentile_approx(F.when(inside[k], F.col(k[0])), around(f, wide[k]), accuracy).alias(f"q{i}")
                              for i, (k, f) in enumerate(finer)]).first()
            for i, (k, _) in enumerate(finer):
                if (found := tuple(sketch[f"q{i}"])) != bracket[k]:
                    bracket[k] = found
                    again.append(k)
                else:  # the sketch cannot tell its values apart: all of them are ranked, in ranges
                    crowded = True
                    below[k] = counts[f"b{open_ones.index(k)}"]
        open_ones = again
    found = list(below)
    if not found:
        return df.select(F.lit("").alias("column_name"), F.lit(0.0).alias("p"), F.col(cols[0]).alias("value")).where("false")
    # rows of a bracket by value: at most bracket_rows rows per quantile, then summed up to the rank
    pick = F.array(*[F.struct(F.lit(i).alias("i"), F.col(k[0]).alias("v")) for i, k in enumerate(found)])
    held = F.filter(pick, lambda x: F.element_at(F.array(*[F.col(k[0]).between(*map(F.lit, bracket[k])) for k in found]),
                                                 x["i"] + 1))
    values = df.select(F.explode(held).alias("x")).groupBy("x.i", "x.v").agg(F.count(F.lit(1)).alias("n"))
    wanted = df.sparkSession.createDataFrame([(i, k[0], float(k[1]), rank[k] - below[k]) for i, k in enumerate(found)],
                                             "i int, column_name string, p double, rank long")
    if crowded:
        values = ordered_scan(values, ["i"], ["v"], {"upto": ("run_sum", "n")})
    else:
        upto = F.sum("n").over(Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
        values = values.withColumn("upto", upto)
    reached = values.join(F.broadcast(wanted), "i").where(F.col("upto") >= F.col("rank"))
    return reached.groupBy("column_name", "p").agg(F.min("v").alias("value"))


def approx_quantiles(df: DataFrame, col: str, probs: list[float], accuracy: int = 10000) -> DataFrame:
    """Bounded-memory mergeable sketch (relative rank error 1 / accuracy)."""
    return df.agg(F.percentile_approx(col, list(probs), accuracy).alias("q")) \
        .select(F.posexplode("q").alias("i", "value")) \
        .withColumn("p", F.array(*[F.lit(float(p)) for p in probs])[F.col("i")]).drop("i")


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between min and max (max falls in the last bin)."""
    x = N.dbl(col)
    lo_hi = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))  # one row
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    b = F.when(width > 0, F.least(F.floor((x - F.col("lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    binned = (df.where(F.col(col).isNotNull()).crossJoin(F.broadcast(lo_hi))
              .withColumn("bin", b.cast("int"))
              .withColumn("bin_start", F.col("lo") + F.col("bin") * width))
    return (binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("bin_start").alias("bin_start"))
            .withColumn("bin_start", N.rnd("bin_start", 4)))


def mode_of(df: DataFrame, col: str) -> DataFrame:
    """Most frequent value (ties -> smallest value); a top-1 report."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col).limit(1)


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "n_null")


def pivot_sum_ratio(df: DataFrame, row: str, col: str, values: list[str], num: str, den: str) -> DataFrame:
    """row x col matrix of 100 * sum(num) / sum(den) (explicit pivot values:
    no extra job to discover them and a fixed output schema)."""
    p = df.groupBy(row).pivot(col, values).agg(
        N.rnd(N.pct(F.sum(num), F.sum(den))))
    return p


# --------------------------------------------------------------- registered


@register("agg_global", sql=S.with_fact("""
SELECT COUNT(*) AS n_lines, COUNT(DISTINCT customer_id) AS n_customers, COUNT(DISTINCT order_id) AS n_orders,
       COUNT(DISTINCT product_id) AS n_products, MIN(order_date) AS first_order, MAX(order_date) AS last_order
FROM fact"""))
def _agg_global(spark, sf_dir):
    # lines -> orders -> customers: each count is taken where its key is a row
    per_customer = order_totals(spark, sf_dir, ["customer_id", "order_date"], ["quantity"]).groupBy("customer_id").agg(
        F.sum("n_lines").alias("n_lines"), F.count(F.lit(1)).alias("n_orders"), F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"))
    per_all = per_customer.agg(F.sum("n_lines").alias("n_lines"), F.count("customer_id").alias("n_customers"),
                               F.sum("n_orders").alias("n_orders"), F.min("first_order").alias("first_order"),
                               F.max("last_order").alias("last_order"))
    products = fact_distinct(spark, sf_dir, ["product_id"]).withColumnRenamed("n_product_id", "n_products")
    return per_all.crossJoin(F.broadcast(products)).select("n_lines", "n_customers", "n_orders", "n_products", "first_order",
                                                           "last_order")


@register("agg_group_one", sql=S.with_fact(f"""
SELECT market, {S.money('SUM(sales)')} AS total_sales, {S.rnd(S.mean('profit'))} AS avg_profit,
       COUNT(*) AS n_lines FROM fact GROUP BY market"""))
def _agg_group_one(spark, sf_dir):
    return order_lines(spark, sf_dir, ["market", "sales", "profit"]).groupBy("market").agg(
        N.money(F.sum("sales")).alias("total_sales"), N.rnd(N.mean("profit")).alias("avg_profit"),
        F.count(F.lit(1)).alias("n_lines"))


@register("agg_group_multi", sql=S.with_fact(f"""
SELECT market, segment, category, {S.money('SUM(profit)')} AS total_profit, COUNT(*) AS n_lines
FROM fact GROUP BY market, segment, category"""))
def _agg_group_multi(spark, sf_dir):
    return order_lines(spark, sf_dir, ["market", "segment", "category", "profit"]) \
        .groupBy("market", "segment", "category") \
        .agg(N.money(F.sum("profit")).alias("total_profit"), F.count(F.lit(1)).alias("n_lines"))


@register("agg_group_expr", sql=S.with_fact(f"""
SELECT CAST(year(order_date) AS INTEGER) AS order_year, CAST(quarter(order_date) AS INTEGER) AS order_quarter,
       {S.money('SUM(sales)')} AS total_sales FROM fact GROUP BY 1, 2"""))
def _agg_group_expr(spark, sf_dir):
    return order_lines(spark, sf_dir, ["order_date", "sales"]) \
        .groupBy(F.year("order_date").alias("order_year"), F.quarter("order_date").alias("order_quarter")) \
        .agg(N.money(F.sum("sales")).alias("total_sales"))


@register("agg_count_distinct", sql=S.with_fact("""
SELECT category, COUNT(DISTINCT order_id) AS n_orders, COUNT(DISTINCT customer_id) AS n_customers
FROM fact GROUP BY category"""))
def _agg_count_distinct(spark, sf_dir):
    return order_lines(spark, sf_dir, ["category", "order_id", "customer_id"]).groupBy("category") \
        .agg(F.countDistinct("order_id").alias("n_orders"), F.countDistinct("customer_id").alias("n_customers"))


MULTI_DISTINCT = ["customer_id", "order_id", "product_id", "product_name", "category", "sub_category",
                  "market", "country", "segment", "ship_mode"]


def multi_distinct(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """Distinct counts of many columns, one row: each column grouped on its own
    (map-side combined, no row is multiplied), or all sketched in one pass."""
    if approx:
        return df.agg(*[F.approx_count_distinct(c).alias(f"n_{c}") for c in cols])
    out = None
    for c in cols:
        one = df.groupBy(c).agg(F.lit(1).alias("_one")).agg(F.count(c).alias(f"n_{c}"))
        out = one if out is None else out.crossJoin(F.broadcast(one))  # one row each
    return out


def fact_distinct(spark, sf_dir, cols: list[str]) -> DataFrame:
    """Exact distinct counts of fact columns without joining the lines.

    The lines give their distinct keys (orders, products, ship modes), one
    narrow scan each; attributes are counted on the rows of those keys, an
    order's on its customer's, and dimension attributes on the few
    combinations that occur.
    """
    raw = read_table(spark, sf_dir, "lineitem")
    orders = raw.select(F.col("l_orderkey").alias("order_id")).distinct() \
        .join(order_lines_side(spark, sf_dir, ["customer_id", "market", "country", "segment"]), "order_id")
    customers = orders.groupBy("customer_id", "market", "country", "segment").agg(F.count(F.lit(1)).alias("n_orders"))
    part = read_table(spark, sf_dir, "part")
    products = raw.select(F.col("l_partkey").alias("p_partkey")).distinct().join(part, "p_partkey").select(
        F.col("p_partkey").alias("product_id"), *[fact_column(c).alias(c) for c in ("product_name", "category", "sub_category")])
    sources = [(["order_id", "customer_id", "market", "country", "segment"], customers),
               (["product_id", "product_name", "category", "sub_category"], products),
               (["ship_mode"], raw.select(fact_column("ship_mode").alias("ship_mode")))]
    out = None
    for names, frame in sources:
        for c in (c for c in names if c in cols):
            if c == "order_id":
                one = frame.agg(F.sum("n_orders").alias("n_order_id"))
            elif c == "customer_id":
                one = frame.agg(F.count("customer_id").alias("n_customer_id"))
            elif c == "product_id":
                one = frame.agg(F.count("product_id").alias("n_product_id"))
            else:
                one = multi_distinct(frame, [c])
            out = one if out is None else out.crossJoin(F.broadcast(one))  # one row each
    return out.select(*[f"n_{c}" for c in cols])


@register("agg_multi_distinct", sql=S.with_fact(
    "SELECT " + ", ".join(f"COUNT(DISTINCT {c}) AS n_{c}" for c in MULTI_DISTINCT) + " FROM fact"))
def _agg_multi_distinct(spark, sf_dir):
    return fact_distinct(spark, sf_dir, MULTI_DISTINCT)


@register("agg_first", sql=S.with_fact("""
SELECT order_id, arg_min(ship_mode, (ship_date, ship_mode)) AS first_ship_mode,
       arg_min(customer_name, customer_name) AS first_customer_name
FROM fact GROUP BY order_id"""))
def _agg_first(spark, sf_dir):
    # FIRST without an order is arbitrary: the deterministic first is the
    # value of the earliest (ship_date, value), ties broken by the value
    df = order_lines(spark, sf_dir, ["order_id", "ship_mode", "ship_date", "customer_name"])
    return df.groupBy("order_id").agg(
        F.min_by("ship_mode", F.struct("ship_date", "ship_mode")).alias("first_ship_mode"),
        F.min("customer_name").alias("first_customer_name"))


@register("agg_minmax_date", sql=S.with_fact("""
SELECT order_id, MIN(order_date) AS order_date, MIN(ship_date) AS first_ship, MAX(ship_date) AS last_ship
FROM fact GROUP BY order_id"""))
def _agg_minmax_date(spark, sf_dir):
    return order_lines(spark, sf_dir, ["order_id", "order_date", "ship_date"]).groupBy("order_id") \
        .agg(F.min("order_date").alias("order_date"), F.min("ship_date").alias("first_ship"),
             F.max("ship_date").alias("last_ship"))


@register("agg_conditional_count", sql=S.with_fact("""
SELECT market, COUNT(*) FILTER (WHERE profit < 0) AS loss_lines,
       COUNT(*) FILTER (WHERE discount = 0) AS full_price_lines,
       COUNT(*) FILTER (WHERE ship_date < order_date) AS early_ship_lines
FROM fact GROUP BY market"""))
def _agg_conditional_count(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["market", "profit", "discount", "ship_date", "order_date"])
    return df.groupBy("market").agg(
        F.count_if(F.col("profit") < 0).alias("loss_lines"),
        F.count_if(F.col("discount") == 0).alias("full_price_lines"),
        F.count_if(F.col("ship_date") < F.col("order_date")).alias("early_ship_lines"))


@register("agg_ratio", sql=S.with_fact(f"""
SELECT category, {S.rnd(S.pct('SUM(profit)', 'SUM(sales)'))} AS margin_pct,
       {S.rnd(S.ratio('SUM(shipping_cost)', 'SUM(sales)'), 4)} AS shipping_ratio
FROM fact GROUP BY category"""))
def _agg_ratio(spark, sf_dir):
    return part_totals(spark, sf_dir, ["category"], ["profit", "sales", "shipping_cost"]).groupBy("category") \
        .agg(N.rnd(N.pct(F.sum("profit"), F.sum("sales"))).alias("margin_pct"),
             N.rnd(N.ratio(F.sum("shipping_cost"), F.sum("sales")), 4).alias("shipping_ratio"))


@register("agg_share_of_total", sql=S.with_fact(f"""
SELECT segment, n, {S.rnd(S.ratio('n', 'SUM(n) OVER ()'), 6)} AS share
FROM (SELECT segment, COUNT(*) AS n FROM fact GROUP BY segment) c"""))
def _agg_share_of_total(spark, sf_dir):
    per = order_lines(spark, sf_dir, ["segment"]).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    # the window runs over one row per segment (the aggregate), not over lines
    return per.withColumn("share", N.rnd(N.ratio("n", F.sum("n").over(Window.partitionBy())), 6))


@register("agg_of_agg", sql=S.with_fact(f"""
SELECT {S.rnd(S.mean('n_lines'))} AS avg_lines_per_order,
       (SELECT {S.rnd(S.mean('n_orders'))} FROM (SELECT customer_id, COUNT(DISTINCT order_id) AS n_orders
                                               FROM fact GROUP BY customer_id) c) AS avg_orders_per_customer
FROM (SELECT order_id, COUNT(*) AS n_lines FROM fact GROUP BY order_id) o"""))
def _agg_of_agg(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "customer_id"])
    per_order = df.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_lines"))
    per_cust = df.groupBy("customer_id").agg(F.countDistinct("order_id").alias("n_orders"))
    a = per_order.agg(N.rnd(N.mean("n_lines")).alias("avg_lines_per_order"))
    b = per_cust.agg(N.rnd(N.mean("n_orders")).alias("avg_orders_per_customer"))
    return a.crossJoin(b)  # two one-row aggregates


@register("agg_having", sql=S.with_fact("""
SELECT order_id, COUNT(*) AS n_lines, COUNT(DISTINCT ship_mode) AS n_ship_modes
FROM fact GROUP BY order_id HAVING COUNT(*) >= 7 AND COUNT(DISTINCT ship_mode) > 1"""))
def _agg_having(spark, sf_dir):
    return (order_lines(spark, sf_dir, ["order_id", "ship_mode"]).groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("ship_mode").alias("n_ship_modes"))
            .where((F.col("n_lines") >= 7) & (F.col("n_ship_modes") > 1)))


@register("agg_distinct", sql=S.with_fact("SELECT DISTINCT market, segment FROM fact"))
def _agg_distinct(spark, sf_dir):
    return order_lines(spark, sf_dir, ["market", "segment"]).distinct()


@register("agg_mode", sql=S.with_fact("""
SELECT ship_mode, COUNT(*) AS n FROM fact GROUP BY ship_mode ORDER BY n DESC, ship_mode LIMIT 1"""))
def _agg_mode(spark, sf_dir):
    return mode_of(order_lines(spark, sf_dir, ["ship_mode"]), "ship_mode")


@register("agg_value_counts", sql=S.with_fact("""
SELECT order_priority, COUNT(*) AS n FROM fact GROUP BY order_priority ORDER BY n DESC, order_priority"""))
def _agg_value_counts(spark, sf_dir):
    return order_lines(spark, sf_dir, ["order_priority"]).groupBy("order_priority") \
        .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "order_priority")


CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@register("agg_pivot", sql=S.with_fact(
    "SELECT market, " + ", ".join(
        f"{S.rnd(S.pct(f'SUM(profit) FILTER (WHERE category = {chr(39)}{c}{chr(39)})', f'SUM(sales) FILTER (WHERE category = {chr(39)}{c}{chr(39)})'))} AS \"{c}\""
        for c in CATEGORIES) + " FROM fact GROUP BY market"))
def _agg_pivot(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["market", "category", "profit", "sales"])
    return pivot_sum_ratio(df, "market", "category", CATEGORIES, "profit", "sales")


@register("agg_null_counts", sql=S.with_fact("""
SELECT column_name, CAST(n_null AS BIGINT) AS n_null FROM (
  SELECT SUM(CASE WHEN customer_name IS NULL THEN 1 ELSE 0 END) AS customer_name,
         SUM(CASE WHEN order_priority IS NULL THEN 1 ELSE 0 END) AS order_priority,
         SUM(CASE WHEN discount IS NULL THEN 1 ELSE 0 END) AS discount,
         SUM(CASE WHEN ship_date IS NULL THEN 1 ELSE 0 END) AS ship_date
  FROM dirty) UNPIVOT (n_null FOR column_name IN (customer_name, order_priority, discount, ship_date))""",
                                            DIRTY_CTE_SQL))
def _agg_null_counts(spark, sf_dir):
    return null_counts(dirty_lines(spark, sf_dir), ["customer_name", "order_priority", "discount", "ship_date"])


@register("agg_corr", sql=S.with_fact(f"""
SELECT {S.rnd('corr(CAST(sales AS DOUBLE), CAST(profit AS DOUBLE))', 6)} AS corr_sales_profit FROM fact"""))
def _agg_corr(spark, sf_dir):
    return order_lines(spark, sf_dir, ["sales", "profit"]).agg(
        N.rnd(F.corr(N.dbl("sales"), N.dbl("profit")), 6).alias("corr_sales_profit"))


@register("agg_corr_matrix", sql=S.with_fact(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {S.rnd(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))', 6)} AS corr FROM fact"
    for a, b in combinations(NUMERIC, 2))))
def _agg_corr_matrix(spark, sf_dir):
    return corr_matrix(order_lines(spark, sf_dir, NUMERIC), NUMERIC)


@register("agg_stddev", sql=S.with_fact(f"""
SELECT market, {S.rnd('stddev_samp(CAST(sales AS DOUBLE))', 4)} AS sales_stddev FROM fact GROUP BY market"""))
def _agg_stddev(spark, sf_dir):
    return order_lines(spark, sf_dir, ["market", "sales"]).groupBy("market") \
        .agg(N.rnd(F.stddev_samp(N.dbl("sales")), 4).alias("sales_stddev"))


@register("agg_describe", sql=S.with_fact(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS n, {S.rnd(f'avg(CAST({c} AS DOUBLE))', 4)} AS mean, "
    f"{S.rnd(f'stddev_samp(CAST({c} AS DOUBLE))', 4)} AS stddev, {S.rnd(f'min(CAST({c} AS DOUBLE))', 4)} AS min, "
    f"{S.rnd(f'max(CAST({c} AS DOUBLE))', 4)} AS max FROM fact" for c in NUMERIC)))
def _agg_describe(spark, sf_dir):
    return describe_long(order_lines(spark, sf_dir, NUMERIC), NUMERIC)


QUANTILE_PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


@register("agg_quantile", sql=S.with_fact(f"""
SELECT CAST(g.p AS DOUBLE) AS p, CAST(v.sales AS DOUBLE) AS value
FROM (SELECT sales, ROW_NUMBER() OVER (ORDER BY sales) AS rk, COUNT(*) OVER () AS n
      FROM fact WHERE sales IS NOT NULL) v
JOIN (SELECT unnest([{', '.join(str(p) for p in QUANTILE_PROBS)}]) AS p) g
  ON v.rk = GREATEST(1, CAST(ceil(g.p * v.n) AS BIGINT))"""))
def _agg_quantile(spark, sf_dir):
    q = exact_quantiles(order_lines(spark, sf_dir, ["sales"]), ["sales"], QUANTILE_PROBS)
    return q.select("p", N.dbl("value").alias("value"))


@register("agg_histogram", sql=S.with_fact(f"""
SELECT CAST(bin AS INTEGER) AS bin, COUNT(*) AS n, {S.rnd('MIN(lo + bin * w)', 4)} AS bin_start
FROM (SELECT CASE WHEN w > 0 THEN LEAST(floor((CAST(profit AS DOUBLE) - lo) / w), 49) ELSE 0 END AS bin, lo, w
      FROM fact CROSS JOIN (SELECT MIN(CAST(profit AS DOUBLE)) AS lo,
                                   (MAX(CAST(profit AS DOUBLE)) - MIN(CAST(profit AS DOUBLE))) / 50 AS w
                            FROM fact) m
      WHERE profit IS NOT NULL) b
GROUP BY 1"""))
def _agg_histogram(spark, sf_dir):
    return histogram(order_lines(spark, sf_dir, ["profit"]), "profit", 50)
