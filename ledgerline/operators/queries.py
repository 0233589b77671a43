"""The named analytical queries (q01-q10) and the EDA aggregates.

Library form: ``qNN_xxx(lines, **params) -> DataFrame`` over an order-line
frame with the fact-view columns.  Registered form: ``(spark, sf_dir)``
with the test constants of the survey, next to its DuckDB oracle text.

Every ordering that the reference leaves open (ties) gets a unique
tie-breaker, so results are deterministic and engine independent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import numeric as N
from ledgerline.functions.realtime import tier
from ledgerline.operators.aggregates import exact_quantiles
from ledgerline.plans import sqltext as S
from ledgerline.plans.lineage import cut
from ledgerline.plans.ordered import ordered_scan
from ledgerline.plans.registry import register
from ledgerline.sources.fact import order_lines, order_lines_side, order_totals, part_totals

# --------------------------------------------------------------------------
# q01: per market and year, % change against the previous present year


def q01_market_yoy(lines: DataFrame) -> DataFrame:
    yearly = (lines.where(F.col("order_date").isNotNull() & F.col("market").isNotNull())
              .groupBy("market", F.year("order_date").alias("order_year"))
              .agg(F.round(F.sum("sales"), 2).alias("ts"), F.round(F.sum("profit"), 2).alias("tp")))
    # at most one row per (market, year): the window input is bounded by the calendar
    w = Window.partitionBy("market").orderBy("order_year")
    return yearly.select(
        "market", "order_year",
        N.dbl("ts").alias("total_sales"),
        N.rnd(N.growth_pct(F.col("ts"), F.lag("ts").over(w))).alias("sales_growth_pct"),
        N.dbl("tp").alias("total_profit"),
        N.rnd(N.growth_pct(F.col("tp"), F.lag("tp").over(w))).alias("profit_growth_pct"),
    ).orderBy("market", "order_year")


Q01_SQL = S.with_fact(f"""
SELECT market, order_year, {S.dbl('ts')} AS total_sales,
       {S.rnd(S.growth_pct('ts', 'LAG(ts) OVER (PARTITION BY market ORDER BY order_year)'))} AS sales_growth_pct,
       {S.dbl('tp')} AS total_profit,
       {S.rnd(S.growth_pct('tp', 'LAG(tp) OVER (PARTITION BY market ORDER BY order_year)'))} AS profit_growth_pct
FROM yearly ORDER BY market, order_year
""", """yearly AS (
  SELECT market, CAST(year(order_date) AS INTEGER) AS order_year,
         ROUND(SUM(sales), 2) AS ts, ROUND(SUM(profit), 2) AS tp
  FROM fact WHERE order_date IS NOT NULL AND market IS NOT NULL
  GROUP BY market, year(order_date))""")


@register("q01_market_yoy", sql=Q01_SQL)
def _q01(spark, sf_dir):
    # order totals first: the lines never shuffle against orders/customers
    return q01_market_yoy(order_totals(spark, sf_dir, ["market", "order_date"], ["sales", "profit"]))


# --------------------------------------------------------------------------
# q02: five best and five worst sub-categories by profit (may overlap)


def q02_subcat_extremes(lines: DataFrame, k: int = 5) -> DataFrame:
    per = (lines.where(F.col("profit").isNotNull() & F.col("sub_category").isNotNull())
           .groupBy("sub_category").agg(N.money(F.sum("profit")).alias("total_profit")))
    top = per.orderBy(F.desc("total_profit"), "sub_category").limit(k) \
             .withColumn("group_label", F.lit("Top High"))
    low = per.orderBy(F.asc("total_profit"), "sub_category").limit(k) \
             .withColumn("group_label", F.lit("Top Low"))
    return top.unionByName(low).orderBy(F.desc("total_profit"), "sub_category", "group_label")


_Q02_BRANCH = """(SELECT sub_category, CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS total_profit, '{label}' AS group_label
  FROM fact WHERE profit IS NOT NULL AND sub_category IS NOT NULL
  GROUP BY sub_category ORDER BY total_profit {dir}, sub_category LIMIT 5)"""
Q02_SQL = S.with_fact(
    "SELECT * FROM " + _Q02_BRANCH.format(label="Top High", dir="DESC") + " t1\nUNION ALL\nSELECT * FROM "
    + _Q02_BRANCH.format(label="Top Low", dir="ASC") + " t2\nORDER BY total_profit DESC")


@register("q02_subcat_extremes", sql=Q02_SQL)
def _q02(spark, sf_dir):
    # per-product totals first: the lines never shuffle against the part table
    return q02_subcat_extremes(part_totals(spark, sf_dir, ["sub_category"], ["profit"]))


# --------------------------------------------------------------------------
# q03: month over month change (unpartitioned LAG over ~12 rows per year)


def q03_month_mom(lines: DataFrame) -> DataFrame:
    monthly = (lines.where(F.col("order_date").isNotNull())
               .groupBy(F.year("order_date").alias("order_year"),
                        F.month("order_date").alias("order_month"))
               .agg(F.round(F.sum("sales"), 2).alias("ts"), F.round(F.sum("profit"), 2).alias("tp")))
    # one row per calendar month: a single-task window is bounded by the calendar
    w = Window.orderBy("order_year", "order_month")
    return monthly.select(
        "order_year", "order_month",
        N.dbl("ts").alias("total_sales"),
        N.rnd(N.growth_pct(F.col("ts"), F.lag("ts").over(w))).alias("sales_mom_growth_pct"),
        N.dbl("tp").alias("total_profit"),
        N.rnd(N.growth_pct(F.col("tp"), F.lag("tp").over(w))).alias("profit_mom_growth_pct"),
    ).orderBy("order_year", "order_month")


Q03_SQL = S.with_fact(f"""
SELECT order_year, order_month, {S.dbl('ts')} AS total_sales,
       {S.rnd(S.growth_pct('ts', 'LAG(ts) OVER (ORDER BY order_year, order_month)'))} AS sales_mom_growth_pct,
       {S.dbl('tp')} AS total_profit,
       {S.rnd(S.growth_pct('tp', 'LAG(tp) OVER (ORDER BY order_year, order_month)'))} AS profit_mom_growth_pct
FROM monthly ORDER BY order_year, order_month
""", """monthly AS (
  SELECT CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
         ROUND(SUM(sales), 2) AS ts, ROUND(SUM(profit), 2) AS tp
  FROM fact WHERE order_date IS NOT NULL
  GROUP BY year(order_date), month(order_date))""")


@register("q03_month_mom", sql=Q03_SQL)
def _q03(spark, sf_dir):
    return q03_month_mom(order_totals(spark, sf_dir, ["order_date"], ["sales", "profit"]))


# --------------------------------------------------------------------------
# q04: Pareto of customers (running share of the grand total)


def q04_pareto(lines: DataFrame, num_ranges: int | None = None) -> DataFrame:
    per = lines.groupBy("customer_id", "customer_name").agg(F.sum("sales").alias("cs"))
    # global running sum + row number without a single-task window
    ranked = ordered_scan(per, [], [F.desc("cs"), F.asc("customer_id"), F.asc("customer_name")],
                          {"running": ("run_sum", "cs"), "customer_rank": ("row_number", None)},
                          num_ranges=num_ranges)
    # one row, read from the materialised scan output (no second pass over the lines)
    grand = ranked.agg(F.sum("cs").alias("grand_total"))
    return ranked.crossJoin(F.broadcast(grand)).select(
        "customer_id", "customer_name",
        N.money("cs").alias("total_sales"),
        N.money("running").alias("running_sales"),
        N.rnd(N.pct("running", "grand_total")).alias("cumulative_sales_pct"),
        F.col("customer_rank").cast("bigint").alias("customer_rank"),
    ).orderBy("customer_rank")


Q04_SQL = S.with_fact(f"""
SELECT customer_id, customer_name, {S.money('cs')} AS total_sales,
       {S.money('running')} AS running_sales,
       {S.rnd(S.pct('running', 'g.grand_total'))} AS cumulative_sales_pct,
       customer_rank
FROM (
  SELECT customer_id, customer_name, cs,
         SUM(cs) OVER (ORDER BY cs DESC, customer_id, customer_name
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running,
         ROW_NUMBER() OVER (ORDER BY cs DESC, customer_id, customer_name) AS customer_rank
  FROM per) r
CROSS JOIN (SELECT SUM(cs) AS grand_total FROM per) g
ORDER BY customer_rank
""", """per AS (SELECT customer_id, customer_name, SUM(sales) AS cs FROM fact
  GROUP BY customer_id, customer_name)""")


@register("q04_pareto", sql=Q04_SQL)
def _q04(spark, sf_dir):
    return q04_pareto(order_totals(spark, sf_dir, ["customer_id", "customer_name"], ["sales"]))


# --------------------------------------------------------------------------
# q05: value tier per line, top-2 ship modes per tier by line count


# Tier names in the reports, here and for the discount tiers below.
VALUE_TIERS = ("Low Value", "Medium Value", "High Value")


def value_tier(sales, low: float = 100.0, high: float = 500.0):
    return tier(sales, [(low, "<"), (high, "<")], VALUE_TIERS)


def q05_shipmode_by_value(lines: DataFrame, low: float = 100.0, high: float = 500.0,
                          k: int = 2) -> DataFrame:
    stats = (lines.withColumn("order_group", value_tier("sales", low, high))
             .groupBy("order_group", "ship_mode")
             .agg(F.count(F.lit(1)).alias("total_orders"),
                  N.rnd(N.mean("sales")).alias("avg_sales"),
                  N.rnd(N.mean("profit")).alias("avg_profit"),
                  N.rnd(N.mean("shipping_cost")).alias("avg_shipping_cost")))
    w = Window.partitionBy("order_group").orderBy(F.desc("total_orders"))
    return stats.withColumn("ranking", F.dense_rank().over(w)).where(F.col("ranking") <= k) \
        .withColumn("ranking", F.col("ranking").cast("bigint"))


def _q05_sql(low, high, k=2):
    return S.with_fact(f"""
SELECT * FROM (
  SELECT *, DENSE_RANK() OVER (PARTITION BY order_group ORDER BY total_orders DESC) AS ranking
  FROM (
    SELECT order_group, ship_mode, COUNT(*) AS total_orders,
           {S.rnd(S.mean('sales'))} AS avg_sales, {S.rnd(S.mean('profit'))} AS avg_profit,
           {S.rnd(S.mean('shipping_cost'))} AS avg_shipping_cost
    FROM (SELECT *, CASE WHEN sales < {low} THEN 'Low Value' WHEN sales < {high} THEN 'Medium Value'
                         ELSE 'High Value' END AS order_group FROM fact) g
    GROUP BY order_group, ship_mode) s) r
WHERE ranking <= {k}""")


@register("q05_shipmode_by_value", sql=_q05_sql(35000, 70000))
def _q05(spark, sf_dir):
    return q05_shipmode_by_value(
        order_lines(spark, sf_dir, ["ship_mode", "sales", "profit", "shipping_cost"]), 35000, 70000)


# --------------------------------------------------------------------------
# q06: customers grouped by number of distinct orders


def loyalty_group(n_orders, one_time_max: int = 1, regular_max: int = 5):
    n = F.col(n_orders) if isinstance(n_orders, str) else n_orders
    return (F.when(n.between(1, one_time_max), F.lit("One-time Customer"))
            .when(n.between(one_time_max + 1, regular_max), F.lit("Regular Customer"))
            .otherwise(F.lit("Loyal Customer")))


def q06_customer_loyalty(lines: DataFrame, one_time_max: int = 1, regular_max: int = 5) -> DataFrame:
    per = lines.groupBy("customer_id").agg(F.countDistinct("order_id").alias("total_orders"),
                                           F.sum("sales").alias("cs"))
    return (per.withColumn("customer_group", loyalty_group("total_orders", one_time_max, regular_max))
            .groupBy("customer_group")
            .agg(F.count(F.lit(1)).alias("total_customers"),
                 N.rnd(N.mean("total_orders")).alias("avg_orders"),
                 N.money(F.sum("cs")).alias("total_sales"),
                 N.rnd(N.mean("cs")).alias("avg_customer_sales"))
            .orderBy(F.desc("total_sales")))


def _q06_sql(a, b):
    return S.with_fact(f"""
SELECT customer_group, COUNT(*) AS total_customers, {S.rnd(S.mean('total_orders'))} AS avg_orders,
       {S.money('SUM(cs)')} AS total_sales, {S.rnd(S.mean('cs'))} AS avg_customer_sales
FROM (SELECT *, CASE WHEN total_orders BETWEEN 1 AND {a} THEN 'One-time Customer'
                     WHEN total_orders BETWEEN {a + 1} AND {b} THEN 'Regular Customer'
                     ELSE 'Loyal Customer' END AS customer_group
      FROM (SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders, SUM(sales) AS cs
            FROM fact GROUP BY customer_id) c) g
GROUP BY customer_group ORDER BY total_sales DESC""")


@register("q06_customer_loyalty", sql=_q06_sql(7, 11))
def _q06(spark, sf_dir):
    return q06_customer_loyalty(order_totals(spark, sf_dir, ["customer_id"], ["sales"]), 7, 11)


# --------------------------------------------------------------------------
# q07: top products per category (dense rank, ties kept)


def q07_top_products(lines: DataFrame, k: int = 5) -> DataFrame:
    per = (lines.groupBy("category", "product_name")
           .agg(F.countDistinct("order_id").alias("total_orders"),
                N.money(F.sum("sales")).alias("total_sales"),
                N.money(F.sum("profit")).alias("total_profit"),
                N.rnd(N.mean("profit")).alias("avg_profit")))
    # rank <= k directly on the window column: Spark plans a partial
    # WindowGroupLimit before the shuffle, so a big category ships only k ranks
    w = Window.partitionBy("category").orderBy(F.desc("total_profit"))
    return (per.withColumn("rank_profit_in_category", F.dense_rank().over(w))
            .where(F.col("rank_profit_in_category") <= k)
            .withColumn("rank_profit_in_category", F.col("rank_profit_in_category").cast("bigint"))
            .orderBy("category", "rank_profit_in_category", "product_name"))


Q07_SQL = S.with_fact(f"""
SELECT * FROM (
  SELECT *, DENSE_RANK() OVER (PARTITION BY category ORDER BY total_profit DESC) AS rank_profit_in_category
  FROM (SELECT category, product_name, COUNT(DISTINCT order_id) AS total_orders,
               {S.money('SUM(sales)')} AS total_sales, {S.money('SUM(profit)')} AS total_profit,
               {S.rnd(S.mean('profit'))} AS avg_profit
        FROM fact GROUP BY category, product_name) p) r
WHERE rank_profit_in_category <= 5
ORDER BY category, rank_profit_in_category""")


@register("q07_top_products", sql=Q07_SQL)
def _q07(spark, sf_dir):
    return q07_top_products(order_lines(spark, sf_dir, ["category", "product_name", "order_id",
                                                        "sales", "profit"]))


# --------------------------------------------------------------------------
# q08: discount tiers


def _pct_label(x: float) -> str:
    return f"{x * 100:g}"


def discount_tiers(low: float = 0.10, mid: float = 0.30) -> list[tuple[str, int]]:
    return [("No Discount", 1), (f"Low Discount (0-{_pct_label(low)}%)", 2),
            (f"Medium Discount ({_pct_label(low)}-{_pct_label(mid)}%)", 3),
            (f"High Discount (>{_pct_label(mid)}%)", 4)]


def q08_discount_impact(lines: DataFrame, low: float = 0.10, mid: float = 0.30) -> DataFrame:
    names = discount_tiers(low, mid)
    labels = [n for n, _ in names]
    group = F.when(F.col("discount") == 0, F.lit(labels[0])).otherwise(tier("discount", [low, mid], labels[1:]))
    order = F.when(F.col("discount_group") == names[0][0], 1) \
        .when(F.col("discount_group") == names[1][0], 2) \
        .when(F.col("discount_group") == names[2][0], 3).otherwise(4)
    return (lines.withColumn("discount_group", group).groupBy("discount_group")
            .agg(F.countDistinct("order_id").alias("total_orders"),
                 N.rnd(N.mean("discount")).alias("avg_discount"),
                 N.money(F.sum("sales")).alias("total_sales"),
                 N.money(F.sum("profit")).alias("total_profit"),
                 N.rnd(N.pct(F.sum("profit"), F.sum("sales"))).alias("profit_margin_pct"),
                 N.rnd(N.pct(F.count_if(F.col("profit") < 0), F.count(F.lit(1)))).alias("negative_profit_pct"))
            .withColumn("group_order", order.cast("int"))
            .orderBy("group_order"))


def _q08_sql(low, mid):
    names = [n for n, _ in discount_tiers(low, mid)]
    return S.with_fact(f"""
SELECT discount_group, COUNT(DISTINCT order_id) AS total_orders,
       {S.rnd(S.mean('discount'))} AS avg_discount,
       {S.money('SUM(sales)')} AS total_sales, {S.money('SUM(profit)')} AS total_profit,
       {S.rnd(S.pct('SUM(profit)', 'SUM(sales)'))} AS profit_margin_pct,
       {S.rnd(S.pct('SUM(CASE WHEN profit < 0 THEN 1 ELSE 0 END)', 'COUNT(*)'))} AS negative_profit_pct,
       CAST(CASE discount_group WHEN '{names[0]}' THEN 1 WHEN '{names[1]}' THEN 2
            WHEN '{names[2]}' THEN 3 ELSE 4 END AS INTEGER) AS group_order
FROM (SELECT *, CASE WHEN discount = 0 THEN '{names[0]}' WHEN discount <= {low} THEN '{names[1]}'
                     WHEN discount <= {mid} THEN '{names[2]}' ELSE '{names[3]}' END AS discount_group
      FROM fact) d
GROUP BY discount_group ORDER BY group_order""")


@register("q08_discount_impact", sql=_q08_sql(0.03, 0.06))
def _q08(spark, sf_dir):
    return q08_discount_impact(order_lines(spark, sf_dir, ["order_id", "discount", "sales", "profit"]),
                               0.03, 0.06)


# --------------------------------------------------------------------------
# q09: unprofitable orders among the top sales decile


def order_level(lines: DataFrame) -> DataFrame:
    """Order roll-up used by q09 (FIRST made deterministic with MIN).
    Works on lines or on per-order totals (one row per order)."""
    return lines.groupBy("order_id").agg(
        F.min("order_date").alias("order_date"),
        F.min("customer_name").alias("customer_name"),
        F.min("market").alias("market"),
        F.min("segment").alias("segment"),
        F.min("ship_mode").alias("ship_mode"),
        F.round(F.sum("sales"), 2).alias("os"),
        F.round(F.sum("profit"), 2).alias("op"),
        F.round(F.sum("shipping_cost"), 2).alias("osc"),
        F.sum("quantity").cast("bigint").alias("total_items"))


def in_top_tenth(orders: DataFrame) -> Column:
    """Whether an order (os: sales, order_id) is in the first of ten equal parts by sales, ties by id.

    ``orders`` is read a few times, narrowly; nothing is sorted.  The part ends
    at one value of sales, found as an exact quantile; of the orders with
    that value those with the smallest ids belong to it, up to one id.
    """
    n = orders.count()
    first = -(-n // 10)
    if not n:
        return F.lit(False)
    border = exact_quantiles(orders, ["os"], [(n - first + 0.5) / n]).first()["value"]
    counts = orders.agg(F.count_if(F.col("os") > F.lit(border)).alias("above"), F.count_if(F.col("os") == F.lit(border)).alias("at")).first()
    need = first - counts["above"]
    at = F.col("os") == F.lit(border)
    if need < counts["at"]:
        at &= F.col("order_id") <= exact_quantiles(orders.where(at), ["order_id"], [(need - 0.5) / counts["at"]]).first()["value"]
    return (F.col("os") > F.lit(border)) | at


def top_losses(orders: DataFrame, max_margin: float, k: int) -> DataFrame:
    """The first ``k`` orders (os, op: sales and profit; a cut) of the top tenth with a margin below ``max_margin``."""
    low = N.dbl("op") < F.lit(max_margin) * N.dbl("os")
    return orders.where(in_top_tenth(orders) & low).orderBy(F.desc("os"), "order_id").limit(k)


_Q09_OUT = ["order_id", "customer_name", "market", "segment", "ship_mode", "order_sales", "order_profit", "order_shipping_cost",
            "total_items"]


def _q09_named(hit: DataFrame) -> DataFrame:
    return hit.withColumns({"order_sales": N.dbl("os"), "order_profit": N.dbl("op"), "order_shipping_cost": N.dbl("osc")}) \
        .orderBy(F.desc("os"), "order_id").select(*_Q09_OUT)


def q09_loss_in_top_decile(lines: DataFrame, max_margin: float = 0.0, k: int = 10) -> DataFrame:
    """From order lines, or from totals with one row per order."""
    return _q09_named(top_losses(cut(order_level(lines), "orders"), max_margin, k))


def _q09_sql(max_margin, k=10):
    return S.with_fact(f"""
SELECT order_id, customer_name, market, segment, ship_mode,
       CAST(os AS DOUBLE) AS order_sales, CAST(op AS DOUBLE) AS order_profit,
       CAST(osc AS DOUBLE) AS order_shipping_cost, total_items
FROM (SELECT *, NTILE(10) OVER (ORDER BY os DESC, order_id) AS sales_decile
      FROM (SELECT order_id, MIN(order_date) AS order_date, MIN(customer_name) AS customer_name,
                   MIN(market) AS market, MIN(segment) AS segment, MIN(ship_mode) AS ship_mode,
                   ROUND(SUM(sales), 2) AS os, ROUND(SUM(profit), 2) AS op,
                   ROUND(SUM(shipping_cost), 2) AS osc, CAST(SUM(quantity) AS BIGINT) AS total_items
            FROM fact GROUP BY order_id) o) r
WHERE sales_decile = 1 AND CAST(op AS DOUBLE) < CAST({max_margin} AS DOUBLE) * CAST(os AS DOUBLE)
ORDER BY os DESC, order_id LIMIT {k}""")


@register("q09_loss_in_top_decile", sql=_q09_sql(0.4))
def _q09(spark, sf_dir, k: int = 10):
    # numbers per order only; what names an order is looked up for the k rows of the result
    totals = order_totals(spark, sf_dir, [], ["sales", "profit", "shipping_cost", "quantity"]).select(
        "order_id", F.round("sales", 2).alias("os"), F.round("profit", 2).alias("op"), F.round("shipping_cost", 2).alias("osc"),
        F.col("quantity").cast("bigint").alias("total_items"))
    hit = F.broadcast(cut(top_losses(cut(totals, "orders"), 0.4, k), "top-losses"))  # k rows
    modes = order_lines(spark, sf_dir, ["order_id", "ship_mode"]).join(hit.select("order_id"), "order_id", "left_semi") \
        .groupBy("order_id").agg(F.min("ship_mode").alias("ship_mode"))
    side = order_lines_side(spark, sf_dir, ["customer_name", "market", "segment"])
    return _q09_named(side.join(hit, "order_id").join(modes, "order_id"))


# --------------------------------------------------------------------------
# q10: segment x category margin with rank inside the segment

REFERENCE_SEGMENTS = ("Consumer", "Corporate", "Home Office")
TEST_SEGMENTS = ("BUILDING", "FURNITURE", "MACHINERY")


def q10_segment_category(lines: DataFrame, segments=REFERENCE_SEGMENTS) -> DataFrame:
    per = (lines.where(F.col("segment").isin(*segments) & F.col("category").isNotNull())
           .groupBy("segment", "category")
           .agg(F.countDistinct("order_id").alias("total_orders"),
                N.money(F.sum("sales")).alias("total_sales"),
                N.money(F.sum("profit")).alias("total_profit"),
                N.rnd(N.pct(F.sum("profit"), F.sum("sales"))).alias("profit_margin_pct")))
    w = Window.partitionBy("segment").orderBy(F.desc("total_profit"))
    return per.withColumn("profit_rank", F.dense_rank().over(w).cast("bigint")) \
        .orderBy("segment", "profit_rank", "category")


def _q10_sql(segments):
    seg = ", ".join(f"'{s}'" for s in segments)
    return S.with_fact(f"""
SELECT *, DENSE_RANK() OVER (PARTITION BY segment ORDER BY total_profit DESC) AS profit_rank
FROM (SELECT segment, category, COUNT(DISTINCT order_id) AS total_orders,
             {S.money('SUM(sales)')} AS total_sales, {S.money('SUM(profit)')} AS total_profit,
             {S.rnd(S.pct('SUM(profit)', 'SUM(sales)'))} AS profit_margin_pct
      FROM fact WHERE segment IN ({seg}) AND category IS NOT NULL
      GROUP BY segment, category) s
ORDER BY segment, profit_rank""")


@register("q10_segment_category", sql=_q10_sql(TEST_SEGMENTS))
def _q10(spark, sf_dir):
    return q10_segment_category(order_lines(spark, sf_dir, ["segment", "category", "order_id",
                                                            "sales", "profit"]), TEST_SEGMENTS)


# --------------------------------------------------------------------------
# EDA aggregates


def eda_by(lines: DataFrame, dim: str, with_count: bool = True) -> DataFrame:
    """Totals per dimension; works on lines or on order totals (``n_lines``)."""
    aggs = [N.money(F.sum("sales")).alias("total_sales"), N.money(F.sum("profit")).alias("total_profit")]
    if with_count:
        n = F.sum("n_lines") if "n_lines" in lines.columns else F.count(F.lit(1))
        aggs.append(n.cast("bigint").alias("transaction_count"))
    return lines.groupBy(dim).agg(*aggs).orderBy(F.desc("total_sales"), dim)


def _eda_sql(dim, with_count=True):
    cnt = ", COUNT(*) AS transaction_count" if with_count else ""
    return S.with_fact(f"""
SELECT {dim}, {S.money('SUM(sales)')} AS total_sales, {S.money('SUM(profit)')} AS total_profit{cnt}
FROM fact GROUP BY {dim} ORDER BY total_sales DESC, {dim}""")


@register("eda_market", sql=_eda_sql("market"))
def _eda_market(spark, sf_dir):
    return eda_by(order_totals(spark, sf_dir, ["market"], ["sales", "profit"]), "market")


@register("eda_category", sql=_eda_sql("category", False))
def _eda_category(spark, sf_dir):
    return eda_by(part_totals(spark, sf_dir, ["category"], ["sales", "profit"]), "category", False)


@register("eda_segment", sql=_eda_sql("segment"))
def _eda_segment(spark, sf_dir):
    return eda_by(order_totals(spark, sf_dir, ["segment"], ["sales", "profit"]), "segment")


def eda_monthly(lines: DataFrame) -> DataFrame:
    return (lines.groupBy(F.date_format("order_date", "yyyy-MM").alias("year_month"))
            .agg(N.money(F.sum("sales")).alias("monthly_sales"),
                 N.money(F.sum("profit")).alias("monthly_profit"))
            .orderBy("year_month"))


EDA_MONTHLY_SQL = S.with_fact(f"""
SELECT strftime(order_date, '%Y-%m') AS year_month, {S.money('SUM(sales)')} AS monthly_sales,
       {S.money('SUM(profit)')} AS monthly_profit
FROM fact GROUP BY 1 ORDER BY 1""")


@register("eda_monthly", sql=EDA_MONTHLY_SQL)
def _eda_monthly(spark, sf_dir):
    return eda_monthly(order_totals(spark, sf_dir, ["order_date"], ["sales", "profit"]))


def discount_bands(width: float = 0.1, bands: int = 5) -> list[tuple[str, float, float]]:
    """(label, low, high] bands after the zero band; the reference uses 0.1 x 5."""
    out = []
    for i in range(bands):
        lo, hi = round(i * width, 10), round((i + 1) * width, 10)
        out.append((f"{lo * 100:g}-{hi * 100:g}%", lo, hi))
    return out


def eda_discount_bucket(lines: DataFrame, width: float = 0.1, bands: int = 5) -> DataFrame:
    d = F.col("discount")
    spec = discount_bands(width, bands)
    bucket = F.when(d == 0, F.lit("0"))
    order = F.when(F.col("discount_bucket") == "0", F.lit(0))
    for i, (label, lo, hi) in enumerate(spec, start=1):
        bucket = bucket.when((d > F.lit(lo)) & (d <= F.lit(hi)), F.lit(label))
        order = order.when(F.col("discount_bucket") == label, F.lit(i))
    top = f">{spec[-1][2] * 100:g}%"
    bucket = bucket.otherwise(F.lit(top))
    order = order.otherwise(F.lit(len(spec) + 1))
    return (lines.withColumn("discount_bucket", bucket).groupBy("discount_bucket")
            .agg(N.rnd(N.mean("profit")).alias("avg_profit"), N.rnd(N.mean("sales")).alias("avg_sales"),
                 F.count(F.lit(1)).alias("transaction_count"))
            .withColumn("bucket_order", order.cast("int")).orderBy("bucket_order"))


def _eda_discount_sql(width, bands):
    spec = discount_bands(width, bands)
    whens = " ".join(f"WHEN discount > {lo} AND discount <= {hi} THEN '{label}'" for label, lo, hi in spec)
    orders = " ".join(f"WHEN '{label}' THEN {i}" for i, (label, _, _) in enumerate(spec, start=1))
    top = f">{spec[-1][2] * 100:g}%"
    return S.with_fact(f"""
SELECT discount_bucket, {S.rnd(S.mean('profit'))} AS avg_profit, {S.rnd(S.mean('sales'))} AS avg_sales,
       COUNT(*) AS transaction_count,
       CAST(CASE discount_bucket WHEN '0' THEN 0 {orders} ELSE {len(spec) + 1} END AS INTEGER) AS bucket_order
FROM (SELECT *, CASE WHEN discount = 0 THEN '0' {whens} ELSE '{top}' END AS discount_bucket FROM fact) b
GROUP BY discount_bucket ORDER BY bucket_order""")


@register("eda_discount_bucket", sql=_eda_discount_sql(0.02, 5))
def _eda_discount(spark, sf_dir):
    return eda_discount_bucket(order_lines(spark, sf_dir, ["discount", "sales", "profit"]), 0.02, 5)


def eda_profit_sign(lines: DataFrame) -> DataFrame:
    sign = F.when(F.col("profit") < 0, F.lit("loss")).when(F.col("profit") == 0, F.lit("break_even")) \
            .when(F.col("profit") > 0, F.lit("gain"))
    return lines.groupBy(sign.alias("profit_sign")).agg(F.count(F.lit(1)).alias("n_lines"))


EDA_SIGN_SQL = S.with_fact("""
SELECT CASE WHEN profit < 0 THEN 'loss' WHEN profit = 0 THEN 'break_even' WHEN profit > 0 THEN 'gain' END
         AS profit_sign, COUNT(*) AS n_lines
FROM fact GROUP BY 1""")


@register("eda_profit_sign", sql=EDA_SIGN_SQL)
def _eda_sign(spark, sf_dir):
    return eda_profit_sign(order_lines(spark, sf_dir, ["profit"]))
