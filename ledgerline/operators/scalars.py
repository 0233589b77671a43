"""Scalar function operators (survey 2.8): built-in expressions only."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import numeric as N
from ledgerline.functions.dates import parse_date, week_iso, week_sunday
from ledgerline.plans import sqltext as S
from ledgerline.plans.registry import register
from ledgerline.sources.fact import order_lines, read_table
from ledgerline.sources.fixtures import RAW_CTE_SQL, raw_lines

_LINE = ["order_id", "product_id", "ship_date"]


@register("fn_round", sql=S.with_fact("""
SELECT order_id, product_id, ship_date, CAST(ROUND(sales * discount, 2) AS DOUBLE) AS discount_amount_2,
       CAST(ROUND(profit, 4) AS DOUBLE) AS profit_4, CAST(ROUND(shipping_cost, 2) AS DOUBLE) AS shipping_2
FROM fact"""))
def _fn_round(spark, sf_dir):
    df = order_lines(spark, sf_dir, _LINE + ["sales", "discount", "profit", "shipping_cost"])
    return df.select(*_LINE, N.money(F.col("sales") * F.col("discount")).alias("discount_amount_2"),
                     N.money("profit", 4).alias("profit_4"), N.money("shipping_cost").alias("shipping_2"))


@register("fn_arith_guarded", sql=S.with_fact(f"""
SELECT order_id, product_id, ship_date,
       {S.rnd('CASE WHEN sales = 0 THEN 0.0 ELSE CAST(shipping_cost AS DOUBLE) / CAST(sales AS DOUBLE) END', 6)} AS shipping_ratio,
       {S.rnd('CASE WHEN quantity = 0 THEN 0.0 ELSE CAST(sales AS DOUBLE) / quantity END', 4)} AS avg_item_value,
       CAST(sales * discount AS DOUBLE) AS discount_amount,
       CAST(sales - shipping_cost AS DOUBLE) AS sales_after_shipping
FROM fact"""))
def _fn_arith_guarded(spark, sf_dir):
    df = order_lines(spark, sf_dir, _LINE + ["sales", "shipping_cost", "quantity", "discount"])
    return df.select(
        *_LINE,
        N.rnd(F.when(F.col("sales") == 0, F.lit(0.0)).otherwise(N.dbl("shipping_cost") / N.dbl("sales")), 6)
         .alias("shipping_ratio"),
        N.rnd(F.when(F.col("quantity") == 0, F.lit(0.0)).otherwise(N.dbl("sales") / F.col("quantity")), 4)
         .alias("avg_item_value"),
        N.dbl(F.col("sales") * F.col("discount")).alias("discount_amount"),
        N.dbl(F.col("sales") - F.col("shipping_cost")).alias("sales_after_shipping"))


def log_shift(c, shift: float):
    """log(x + shift); null (not an error) when x + shift <= 0."""
    x = N.dbl(c) + F.lit(shift)
    return F.when(x > 0, F.log(x))


@register("fn_log_exp", sql=S.with_fact(f"""
SELECT order_id, product_id, ship_date,
       {S.rnd('CASE WHEN CAST(profit AS DOUBLE) + 50000.0 > 0 THEN ln(CAST(profit AS DOUBLE) + 50000.0) END', 6)} AS log_profit,
       abs(exp(CASE WHEN CAST(profit AS DOUBLE) + 50000.0 > 0 THEN ln(CAST(profit AS DOUBLE) + 50000.0) END)
           - 50000.0 - CAST(profit AS DOUBLE)) < 1e-6 AS roundtrip_ok
FROM fact"""))
def _fn_log_exp(spark, sf_dir):
    df = order_lines(spark, sf_dir, _LINE + ["profit"])
    lg = log_shift("profit", 50000.0)
    # exp(log(x)) is exact only up to a few ulps (libm differs per engine),
    # so the inverse is checked against the input instead of being rounded
    back = F.exp(lg) - F.lit(50000.0)
    return df.select(*_LINE, N.rnd(lg, 6).alias("log_profit"),
                     (F.abs(back - N.dbl("profit")) < F.lit(1e-6)).alias("roundtrip_ok"))


@register("fn_abs_floor_greatest", sql=S.with_fact("""
SELECT order_id, product_id, ship_date, CAST(abs(profit) AS DOUBLE) AS abs_profit,
       CAST(floor(sales / 1000) AS BIGINT) AS sales_k, CAST(GREATEST(discount, 0.05) AS DOUBLE) AS discount_floor
FROM fact"""))
def _fn_abs_floor_greatest(spark, sf_dir):
    df = order_lines(spark, sf_dir, _LINE + ["profit", "sales", "discount"])
    return df.select(*_LINE, N.dbl(F.abs("profit")).alias("abs_profit"),
                     F.floor(F.col("sales") / 1000).cast("bigint").alias("sales_k"),
                     N.dbl(F.greatest(F.col("discount"), F.lit(0.05).cast("decimal(4,2)"))).alias("discount_floor"))


@register("fn_nullif", sql=S.with_fact(f"""
SELECT category, {S.rnd(S.pct('SUM(profit)', 'NULLIF(SUM(CASE WHEN discount = 0 THEN sales ELSE 0 END), 0)'))}
         AS margin_on_full_price
FROM fact GROUP BY category"""))
def _fn_nullif(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["category", "profit", "discount", "sales"])
    full = F.sum(F.when(F.col("discount") == 0, F.col("sales")).otherwise(F.lit(0)))
    return df.groupBy("category").agg(
        N.rnd(N.pct(F.sum("profit"), F.nullif(full, F.lit(0)))).alias("margin_on_full_price"))


@register("fn_trim", sql=S.with_fact("""
SELECT order_id, product_id, ship_date, trim('  ' || product_name || '  ') AS product_trimmed,
       length(trim('  ' || product_name || '  ')) AS trimmed_len FROM fact"""))
def _fn_trim(spark, sf_dir):
    df = order_lines(spark, sf_dir, _LINE + ["product_name"])
    padded = F.concat(F.lit("  "), F.col("product_name"), F.lit("  "))
    return df.select(*_LINE, F.trim(padded).alias("product_trimmed"),
                     F.length(F.trim(padded)).cast("bigint").alias("trimmed_len"))


def order_key(customer: str, order: str, date: str):
    """Composite key customer || order || yyyy-MM-dd (separator: two pipes)."""
    return F.concat_ws("||", F.col(customer).cast("string"), F.col(order).cast("string"),
                       F.date_format(F.col(date), "yyyy-MM-dd"))


@register("fn_concat_ws", sql=S.with_fact("""
SELECT DISTINCT concat_ws('||', CAST(customer_id AS VARCHAR), CAST(order_id AS VARCHAR),
                          strftime(order_date, '%Y-%m-%d')) AS order_key,
       concat_ws('_', market, category) AS market_category
FROM fact"""))
def _fn_concat_ws(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["customer_id", "order_id", "order_date", "market", "category"])
    return df.select(order_key("customer_id", "order_id", "order_date").alias("order_key"),
                     F.concat_ws("_", "market", "category").alias("market_category")).distinct()


@register("fn_date_format", sql=S.with_fact("""
SELECT DISTINCT order_id, strftime(order_date, '%Y-%m') AS year_month, strftime(order_date, '%Y-%m-%d') AS day
FROM fact"""))
def _fn_date_format(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "order_date"])
    return df.select("order_id", F.date_format("order_date", "yyyy-MM").alias("year_month"),
                     F.date_format("order_date", "yyyy-MM-dd").alias("day")).distinct()


@register("fn_to_date", sql=S.with_fact("""
SELECT "Order.ID" AS order_id, COALESCE(TRY_STRPTIME("Order.Date", '%Y-%m-%d')::DATE, DATE '2001-08-01')
         AS order_date
FROM raw""", RAW_CTE_SQL))
def _fn_to_date(spark, sf_dir):
    raw = raw_lines(spark, sf_dir)
    return raw.select(F.col("`Order.ID`").alias("order_id"),
                      parse_date(F.col("`Order.Date`"), "yyyy-MM-dd", default="2001-08-01").alias("order_date"))


@register("fn_date_parts", sql=S.with_fact(f"""
SELECT DISTINCT order_date, CAST(year(order_date) AS INTEGER) AS y, CAST(month(order_date) AS INTEGER) AS m,
       CAST(quarter(order_date) AS INTEGER) AS q, CAST({S.spark_dow('order_date')} AS INTEGER) AS dow,
       CAST(dayofyear(order_date) AS INTEGER) AS doy
FROM fact"""))
def _fn_date_parts(spark, sf_dir):
    d = F.col("order_date")
    return order_lines(spark, sf_dir, ["order_date"]).select(
        "order_date", F.year(d).alias("y"), F.month(d).alias("m"), F.quarter(d).alias("q"),
        F.dayofweek(d).alias("dow"), F.dayofyear(d).alias("doy")).distinct()


@register("fn_week_iso", sql=S.with_fact("""
SELECT DISTINCT order_date, CAST(weekofyear(order_date) AS INTEGER) AS week_iso FROM fact"""))
def _fn_week_iso(spark, sf_dir):
    return order_lines(spark, sf_dir, ["order_date"]).select(
        "order_date", week_iso(F.col("order_date")).alias("week_iso")).distinct()


@register("fn_week_sunday", sql=S.with_fact("""
SELECT DISTINCT order_date, weeknum AS week_sunday FROM fact"""))
def _fn_week_sunday(spark, sf_dir):
    return order_lines(spark, sf_dir, ["order_date"]).select(
        "order_date", week_sunday(F.col("order_date")).alias("week_sunday")).distinct()


@register("fn_datediff_add", sql=S.with_fact("""
SELECT order_id, product_id, ship_date, CAST(ship_date - order_date AS INTEGER) AS ship_days,
       CAST(order_date + 90 AS DATE) AS horizon_end FROM fact"""))
def _fn_datediff_add(spark, sf_dir):
    df = order_lines(spark, sf_dir, _LINE + ["order_date"])
    return df.select(*_LINE, F.datediff("ship_date", "order_date").alias("ship_days"),
                     F.date_add("order_date", 90).alias("horizon_end"))


@register("fn_now", sql=S.with_fact("""
SELECT COUNT(DISTINCT order_id) AS n_orders, CAST(1 AS BIGINT) AS n_times, TRUE AS readable, TRUE AS is_now FROM fact"""))
def _fn_now(spark, sf_dir):
    # the clock is read once per query: every row carries the same, current time
    df = order_lines(spark, sf_dir, ["order_id"]).distinct() \
        .withColumn("prediction_time", F.current_timestamp().cast("string"))
    t = F.col("prediction_time").try_cast("timestamp")
    return df.agg(F.count(F.lit(1)).alias("n_orders"), F.countDistinct("prediction_time").alias("n_times"),
                  F.bool_and(t.isNotNull()).alias("readable"),
                  F.bool_and(F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(t)) <= 1).alias("is_now"))


PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


@register("fn_from_json", sql="""
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def _fn_from_json(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", "event_type", F.from_json("props", PROPS_SCHEMA).alias("p")) \
        .select("event_id", "event_type", "p.k")


@register("fn_to_json", sql="""
SELECT CAST(event_id AS VARCHAR) AS key, CAST(to_json({'event_id': event_id, 'event_type': event_type,
       'user_id': user_id}) AS VARCHAR) AS value FROM events""")
def _fn_to_json(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").cast("string").alias("key"),
                     F.to_json(F.struct("event_id", "event_type", "user_id")).alias("value"))


@register("fn_rand", sql=S.with_fact("""
SELECT COUNT(DISTINCT order_id) AS n_orders, TRUE AS in_unit_interval, TRUE AS spread, TRUE AS seeded FROM fact"""))
def _fn_rand(spark, sf_dir):
    # values depend on the layout, so what is checked is what holds for any:
    # range, mean and spread of a uniform variable, and that the seed decides
    df = order_lines(spark, sf_dir, ["order_id"]).distinct().withColumn("r", F.rand(42)).withColumn("again", F.rand(42))
    n = F.count(F.lit(1))
    return df.agg(n.alias("n_orders"), F.bool_and((F.col("r") >= 0) & (F.col("r") < 1)).alias("in_unit_interval"),
                  ((F.abs(F.avg("r") - 0.5) < 2 / F.sqrt(n)) & (F.abs(F.var_pop("r") - 1 / 12) < 1 / F.sqrt(n))).alias("spread"),
                  F.bool_and(F.col("r") == F.col("again")).alias("seeded"))


@register("fn_flags", sql=S.with_fact("""
SELECT order_id, product_id, ship_date,
       CAST(CASE WHEN discount > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS is_discounted,
       CAST(CASE WHEN discount >= 0.06 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS high_discount
FROM fact"""))
def _fn_flags(spark, sf_dir):
    df = order_lines(spark, sf_dir, _LINE + ["discount"])
    return df.select(*_LINE, N.flag(F.col("discount") > 0).alias("is_discounted"),
                     N.flag(F.col("discount") >= F.lit(0.06)).alias("high_discount"))
