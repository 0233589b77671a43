"""Window operators (survey 2.5).

Per-key and global ordered windows go through ``plans.ordered.ordered_scan``
so a hot customer (or the whole table) never lands in one task.  Windows
over aggregated frames whose size is bounded by a dimension (months,
markets) use a plain ``Window``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import numeric as N
from ledgerline.plans import sqltext as S
from ledgerline.plans.ordered import chunked_scan, dense_rank_by, month_of, ntile_of, ordered_scan
from ledgerline.plans.registry import register
from ledgerline.sources.fact import order_lines, order_totals, part_totals

_ORDERS_CTE = """o AS (SELECT customer_id, order_id, MIN(order_date) AS order_date, SUM(sales) AS os
  FROM fact GROUP BY customer_id, order_id)"""


def customer_orders(spark, sf_dir) -> DataFrame:
    """One row per (customer, order): date and order sales (exact decimal),
    summed per order before the order-side join."""
    return order_totals(spark, sf_dir, ["customer_id", "order_date"], ["sales"]) \
        .select("customer_id", "order_id", "order_date", F.col("sales").alias("os"))


def latest_per_key(df: DataFrame, key: str, order_cols: list[str], value_cols: list[str]) -> DataFrame:
    """Last row per key by ``order_cols`` as an aggregation (``max_by`` on a
    struct): partial aggregation keeps one candidate per task and key, so a
    hot key costs no more than a cold one."""
    packed = F.struct(*[F.col(c) for c in order_cols])
    return df.groupBy(key).agg(*[F.max_by(c, packed).alias(c) for c in value_cols])


@register("win_lag_part", sql=S.with_fact("""
SELECT customer_id, order_id, order_date,
       LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS previous_order_date
FROM o""", _ORDERS_CTE))
def _win_lag_part(spark, sf_dir):
    o = customer_orders(spark, sf_dir)
    return chunked_scan(o, ["customer_id"], ["order_date", "order_id"], month_of("order_date"),
                        {"previous_order_date": ("lag", "order_date")}) \
        .select("customer_id", "order_id", "order_date", "previous_order_date")


@register("win_lead_part", sql=S.with_fact("""
SELECT customer_id, order_id, order_date,
       LEAD(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS next_order_date
FROM o""", _ORDERS_CTE))
def _win_lead_part(spark, sf_dir):
    o = customer_orders(spark, sf_dir)
    return chunked_scan(o, ["customer_id"], ["order_date", "order_id"], month_of("order_date"),
                        {"next_order_date": ("lead", "order_date")}) \
        .select("customer_id", "order_id", "order_date", "next_order_date")


@register("win_lag_global", sql=S.with_fact(f"""
SELECT ym, {S.money('ms')} AS month_sales, {S.money('LAG(ms) OVER (ORDER BY ym)')} AS previous_month_sales
FROM (SELECT strftime(order_date, '%Y-%m') AS ym, SUM(sales) AS ms FROM fact GROUP BY 1) m"""))
def _win_lag_global(spark, sf_dir):
    m = order_lines(spark, sf_dir, ["order_date", "sales"]) \
        .groupBy(F.date_format("order_date", "yyyy-MM").alias("ym")).agg(F.sum("sales").alias("ms"))
    # one row per calendar month: bounded input for the single-task window
    w = Window.orderBy("ym")
    return m.select("ym", N.money("ms").alias("month_sales"),
                    N.money(F.lag("ms").over(w)).alias("previous_month_sales"))


@register("win_running_sum", sql=S.with_fact(f"""
SELECT customer_id, order_id, order_date,
       {S.money('SUM(os) OVER (PARTITION BY customer_id ORDER BY order_date, order_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')}
         AS running_sales
FROM o""", _ORDERS_CTE))
def _win_running_sum(spark, sf_dir):
    o = customer_orders(spark, sf_dir)
    return chunked_scan(o, ["customer_id"], ["order_date", "order_id"], month_of("order_date"), {"running": ("run_sum", "os")}) \
        .select("customer_id", "order_id", "order_date", N.money("running").alias("running_sales"))


@register("win_row_number", sql=S.with_fact("""
SELECT order_id, ROW_NUMBER() OVER (ORDER BY os DESC, order_id) AS sales_rank FROM o""", _ORDERS_CTE))
def _win_row_number(spark, sf_dir):
    o = customer_orders(spark, sf_dir)
    return ordered_scan(o, [], [F.desc("os"), F.asc("order_id")], {"sales_rank": ("row_number", None)}) \
        .select("order_id", F.col("sales_rank").cast("bigint").alias("sales_rank"))


@register("win_dense_rank", sql=S.with_fact("""
SELECT category, product_name, CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS total_profit,
       DENSE_RANK() OVER (PARTITION BY category ORDER BY ROUND(SUM(profit), 2) DESC) AS profit_rank
FROM fact GROUP BY category, product_name"""))
def _win_dense_rank(spark, sf_dir):
    per = part_totals(spark, sf_dir, ["category", "product_name"], ["profit"]) \
        .groupBy("category", "product_name").agg(N.money(F.sum("profit")).alias("total_profit"))
    # every product of a category is ranked (no limit): rank the distinct
    # (category, profit) values with the skew-safe scan instead of a window
    # that would hold a whole category in one task
    return dense_rank_by(per, ["category"], "total_profit", out="profit_rank")


def ntile_global(df: DataFrame, order_by: list, buckets: int, out: str = "ntile",
                 num_ranges: int | None = None) -> DataFrame:
    """NTILE over the whole frame, from the skew-safe global row number."""
    ranked = ordered_scan(df, [], order_by, {"_rk": ("row_number", None)}, num_ranges)
    total = ranked.agg(F.count(F.lit(1)).alias("_n"))  # one row, from the scan output
    return ranked.crossJoin(F.broadcast(total)) \
        .withColumn(out, ntile_of(F.col("_rk"), F.col("_n"), buckets)).drop("_rk", "_n")


@register("win_ntile", sql=S.with_fact("""
SELECT order_id, CAST(NTILE(10) OVER (ORDER BY os DESC, order_id) AS INTEGER) AS sales_decile FROM o""",
                                       _ORDERS_CTE))
def _win_ntile(spark, sf_dir):
    o = customer_orders(spark, sf_dir)
    return ntile_global(o, [F.desc("os"), F.asc("order_id")], 10, "sales_decile") \
        .select("order_id", "sales_decile")


@register("win_top1_per_key", sql=S.with_fact("""
SELECT customer_id, arg_max(order_id, (order_date, order_id)) AS order_id, MAX(order_date) AS order_date,
       CAST(arg_max(os, (order_date, order_id)) AS DOUBLE) AS order_sales
FROM o GROUP BY customer_id""", _ORDERS_CTE))
def _win_top1_per_key(spark, sf_dir):
    o = customer_orders(spark, sf_dir)
    last = latest_per_key(o, "customer_id", ["order_date", "order_id"], ["order_id", "order_date", "os"])
    return last.select("customer_id", "order_id", "order_date", N.dbl("os").alias("order_sales"))


@register("win_prior_rows", sql=S.with_fact(f"""
SELECT customer_id, order_id,
       COUNT(*) OVER w AS prior_orders,
       {S.money('COALESCE(SUM(os) OVER w, 0)')} AS prior_sales,
       {S.rnd('CAST(SUM(os) OVER w AS DOUBLE) / NULLIF(COUNT(os) OVER w, 0)')} AS prior_avg_sales,
       MIN(order_date) OVER w AS first_order_date
FROM o
WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""", _ORDERS_CTE))
def _win_prior_rows(spark, sf_dir):
    o = customer_orders(spark, sf_dir)
    h = chunked_scan(o, ["customer_id"], ["order_date", "order_id"], month_of("order_date"),
                     {"ps": ("prior_sum", "os"), "pc": ("prior_count", "os"),
                      "first_order_date": ("prior_min", "order_date")})
    return h.select("customer_id", "order_id", F.col("pc").cast("bigint").alias("prior_orders"),
                    N.money(F.coalesce(F.col("ps"), F.lit(0))).alias("prior_sales"),
                    N.rnd(F.try_divide(N.dbl("ps"), F.col("pc"))).alias("prior_avg_sales"),
                    "first_order_date")


@register("win_random_index", sql=S.with_fact("""
SELECT order_id, ROW_NUMBER() OVER (ORDER BY md5('42|' || CAST(order_id AS VARCHAR)), order_id) AS perm_index
FROM o""", _ORDERS_CTE))
def _win_random_index(spark, sf_dir):
    # a seeded permutation numbering: order by a hash of the key (stable on
    # recomputation, unlike rand()), numbered by the skew-safe global scan
    o = customer_orders(spark, sf_dir).withColumn("_h", F.md5(F.concat(F.lit("42|"), F.col("order_id").cast("string"))))
    return ordered_scan(o, [], ["_h", "order_id"], {"perm_index": ("row_number", None)}) \
        .select("order_id", "perm_index")
