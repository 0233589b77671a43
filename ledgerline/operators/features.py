"""Feature engineering (survey 2.11): order table, leakage-safe history,
repurchase labels, censoring, class weights, winsorizing, snapshots.

History windows run on ORDER-level rows (lines of one order must not see
each other, H18) with a total order (date, order key), chunked by month
(``chunked_scan``): a customer with a third of all orders is split over
many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import numeric as N
from ledgerline.functions.realtime import ServingParams, line_features, message_features
from ledgerline.operators.aggregates import approx_quantiles, exact_quantiles
from ledgerline.operators.relational import time_split
from ledgerline.operators.scalars import order_key
from ledgerline.plans import sqltext as S
from ledgerline.plans.lineage import cut, parts_for
from ledgerline.plans.ordered import chunked_scan, month_of
from ledgerline.plans.registry import register
from ledgerline.sources.fact import fact_column, order_lines, order_lines_side, order_totals, read_table

HORIZON_DAYS = 90
# reference split dates (defaults) and the test split for our tables
REFERENCE_SPLIT = ("2013-07-01", "2014-01-01", "2014-12-31")
TEST_SPLIT = ("1999-01-01", "2000-04-01", "2001-08-01")

# ----------------------------------------------------------- order table

DIMENSION_LIMIT = 1_000_000  # more than the category pairs or ship modes of any shop


def _numbered(values: DataFrame, name: str) -> DataFrame:
    """The distinct rows of a small dimension, numbered in their order from 1, nulls last (raises beyond ``DIMENSION_LIMIT``)."""
    ids = values.distinct().withColumn(name, F.row_number().over(Window.orderBy(*[F.asc_nulls_last(c) for c in values.columns])))
    n = ids.count()
    if n >= DIMENSION_LIMIT:
        raise ValueError(f"{n} distinct values of {values.columns}")
    return ids


MASK_BITS = 60


def _set_size(number: str, most: int) -> Column:
    """How many different numbers from 1 to ``most`` (a small dimension's) a group holds, nulls aside.

    The numbers are bits of a few longs, so the aggregate stays numeric and no row is multiplied.
    """
    n = F.col(number)
    masks = [F.bit_or(F.when((n > k) & (n <= k + MASK_BITS), F.expr(f"shiftleft(CAST(1 AS bigint), CAST({number} - {k + 1} AS int))")))
             for k in range(0, max(1, most), MASK_BITS)]
    return reduce(lambda a, b: a + b, [F.coalesce(F.bit_count(m), F.lit(0)) for m in masks]).cast("bigint")


SIDE = ("customer_id", "customer_name", "order_date", "market", "country", "segment", "order_priority")


def order_table(spark, sf_dir, side=SIDE) -> DataFrame:
    """Lines -> one row per order with order columns (those in ``side``), line measures and main category.

    All line aggregates are numeric, so they hash-aggregate in place and the
    lines are never sorted: strings enter as numbers of small dimensions.
    Per (order, category pair): decimal sums, extremes and distinct products
    (a product has one pair, so these add up).  Per order: the sums of those,
    and the pair with the largest sales, ties by name, as the minimum of one
    packed number (negated cents, then the pair's number).  The lines are dealt
    by order into parts of bounded size before they are aggregated: few lines of
    an order share a pair, so nothing would shrink on the way, and well packed
    files give a task millions of lines.  Orders, customers and geography join
    once, order by order.  Lines without a ship mode,
    category or sub-category count in all but those columns.
    """
    part = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"), F.col("p_brand").alias("sub_category"),
        "p_retailprice")
    pairs = _numbered(part.select("category", "sub_category"), "pair") \
        .withColumn("cat", F.when(F.col("category").isNotNull(), F.dense_rank().over(Window.orderBy("category")))) \
        .withColumn("sub", F.when(F.col("sub_category").isNotNull(), F.dense_rank().over(Window.orderBy("sub_category"))))
    most = pairs.agg(F.max("cat").alias("cat"), F.max("sub").alias("sub")).first()
    sizes = {c: _set_size(c, most[c] or 0) if (most[c] or 0) <= 32 * MASK_BITS else F.countDistinct(c) for c in ("cat", "sub")}
    raw = read_table(spark, sf_dir, "lineitem")
    modes = _numbered(raw.select(fact_column("ship_mode").alias("ship_mode")).where("ship_mode IS NOT NULL"), "mode")
    lines = raw.select(
        F.col("l_orderkey").alias("order_id"), "l_partkey", "l_extendedprice", "l_discount", "l_quantity",
        *[fact_column(c).alias(c) for c in ("ship_mode", "ship_date", "sales", "discount", "quantity", "shipping_cost")])
    part = part.alias("p").join(F.broadcast(pairs.alias("n")), F.col("p.category").eqNullSafe(F.col("n.category")) & F.col(
        "p.sub_category").eqNullSafe(F.col("n.sub_category")), "left").select("product_id", "p_retailprice", "pair", "cat", "sub")
    lines = lines.join(F.broadcast(modes), "ship_mode", "left").join(part, F.col("l_partkey") == F.col("product_id")) \
        .withColumn("profit", fact_column("profit")).drop("l_partkey", "l_extendedprice", "l_discount", "l_quantity", "p_retailprice", "ship_mode")
    lines = lines.repartition(parts_for(raw.count(), spark), "order_id")
    per_pair = lines.groupBy("order_id", "pair", "cat", "sub").agg(
        F.min("ship_date").alias("ship_date"), F.min("mode").alias("mode"), F.sum("sales").alias("s"),
        F.sum("profit").alias("p"), F.sum("quantity").alias("q"), F.sum("discount").alias("ds"),
        F.count("discount").alias("dn"), F.max("discount").alias("dm"), F.sum("shipping_cost").alias("sc"),
        F.count(F.lit(1)).alias("n"), F.countDistinct("product_id").alias("np"))
    place = (F.col("s") * -100).cast("decimal(31,0)") * F.lit(DIMENSION_LIMIT) + F.col("pair")
    best = lambda c: F.pmod(F.min(F.when(F.col(c).isNotNull(), place)), F.lit(DIMENSION_LIMIT)).cast("int")
    per_order = per_pair.groupBy("order_id").agg(
        F.min("ship_date").alias("ship_date"), F.min("mode").alias("mode"),
        F.round(F.sum("s"), 2).alias("order_sales"), F.round(F.sum("p"), 2).alias("order_profit"),
        F.sum("q").cast("bigint").alias("order_quantity"),
        N.rnd(F.try_divide(N.dbl(F.sum("ds")), F.sum("dn")), 4).alias("order_avg_discount"),
        N.money(F.max("dm"), 4).alias("order_max_discount"), F.round(F.sum("sc"), 2).alias("order_shipping_cost"),
        F.sum("n").alias("order_line_count"), F.sum("np").alias("num_products"),
        sizes["cat"].alias("num_categories"), sizes["sub"].alias("num_sub_categories"),
        best("cat").alias("cat_pair"), best("sub").alias("sub_pair"))
    side = order_lines_side(spark, sf_dir, list(side))
    main = pairs.select(F.col("pair").alias("cat_pair"), F.col("category").alias("main_category"))
    main_sub = pairs.select(F.col("pair").alias("sub_pair"), F.col("sub_category").alias("main_sub_category"))
    return (per_order.join(side, "order_id").join(F.broadcast(modes), "mode", "left")
            .join(F.broadcast(main), "cat_pair", "left").join(F.broadcast(main_sub), "sub_pair", "left")
            .drop("mode", "cat_pair", "sub_pair").withColumns({
                "order_key": order_key("customer_id", "order_id", "order_date"),
                "ship_days": F.datediff("ship_date", "order_date"), "order_year": F.year("order_date"),
                "order_month": F.month("order_date"), "order_quarter": F.quarter("order_date"),
                "weekday_of_order": F.dayofweek("order_date")}))


_ORDER_CTE = f"""ob AS (
  SELECT concat_ws('||', CAST(customer_id AS VARCHAR), CAST(order_id AS VARCHAR), strftime(order_date, '%Y-%m-%d'))
           AS order_key, customer_id, customer_name, order_id, order_date,
         MIN(market) AS market, MIN(country) AS country, MIN(segment) AS segment, MIN(ship_mode) AS ship_mode,
         MIN(order_priority) AS order_priority, MIN(ship_date) AS ship_date,
         ROUND(SUM(sales), 2) AS order_sales, ROUND(SUM(profit), 2) AS order_profit,
         CAST(SUM(quantity) AS BIGINT) AS order_quantity, {S.rnd(S.mean('discount'), 4)} AS order_avg_discount,
         CAST(ROUND(MAX(discount), 4) AS DOUBLE) AS order_max_discount,
         ROUND(SUM(shipping_cost), 2) AS order_shipping_cost, COUNT(*) AS order_line_count,
         COUNT(DISTINCT product_id) AS num_products, COUNT(DISTINCT category) AS num_categories,
         COUNT(DISTINCT sub_category) AS num_sub_categories
  FROM fact GROUP BY ALL),
mc AS (
  SELECT order_key, arg_min(category, (-cs, category, sub_category)) AS main_category,
         arg_min(sub_category, (-cs, category, sub_category)) AS main_sub_category
  FROM (SELECT concat_ws('||', CAST(customer_id AS VARCHAR), CAST(order_id AS VARCHAR),
                         strftime(order_date, '%Y-%m-%d')) AS order_key, category, sub_category, SUM(sales) AS cs
        FROM fact GROUP BY ALL) s
  GROUP BY order_key),
od AS (SELECT ob.*, mc.main_category, mc.main_sub_category,
              CAST(ship_date - order_date AS INTEGER) AS ship_days, CAST(year(order_date) AS INTEGER) AS order_year,
              CAST(month(order_date) AS INTEGER) AS order_month, CAST(quarter(order_date) AS INTEGER) AS order_quarter,
              CAST(dayofweek(order_date) + 1 AS INTEGER) AS weekday_of_order
       FROM ob LEFT JOIN mc ON ob.order_key = mc.order_key)"""

_ROLLUP_OUT = ["order_key", "customer_id", "customer_name", "order_id", "order_date", "market", "country",
               "segment", "ship_mode", "order_priority", "ship_date", "order_sales", "order_profit",
               "order_quantity", "order_avg_discount", "order_max_discount", "order_shipping_cost",
               "order_line_count", "num_products", "num_categories", "num_sub_categories", "ship_days",
               "order_year", "order_month", "order_quarter", "weekday_of_order"]
_MONEY = ("order_sales", "order_profit", "order_shipping_cost")


def _sel_sql(cols):
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in _MONEY else c for c in cols)


def _sel(df: DataFrame, cols) -> DataFrame:
    return df.select(*[N.dbl(c).alias(c) if c in _MONEY else F.col(c) for c in cols])


@register("fe_order_rollup", sql=S.with_fact(f"SELECT {_sel_sql(_ROLLUP_OUT)} FROM od", _ORDER_CTE))
def _fe_order_rollup(spark, sf_dir):
    return _sel(order_table(spark, sf_dir), _ROLLUP_OUT)


#: What the order key is made of: orders alone, no customer or geography.
KEY_SIDE = ("customer_id", "order_date")


@register("fe_main_category", sql=S.with_fact(
    "SELECT order_key, main_category, main_sub_category FROM mc", _ORDER_CTE))
def _fe_main_category(spark, sf_dir):
    return order_table(spark, sf_dir, KEY_SIDE).select("order_key", "main_category", "main_sub_category")


@register("join_left_equi", sql=S.with_fact(
    "SELECT order_key, order_id, CAST(order_sales AS DOUBLE) AS order_sales, main_category, main_sub_category FROM od",
    _ORDER_CTE))
def _join_left_equi(spark, sf_dir):
    sales = order_totals(spark, sf_dir, ["customer_id", "order_date"], ["sales"]).select(
        order_key("customer_id", "order_id", "order_date").alias("order_key"), "order_id",
        N.money("sales").alias("order_sales"))
    # by the order's number: both sides are grouped by it already
    main = order_table(spark, sf_dir, KEY_SIDE).select("order_id", "main_category", "main_sub_category")
    return sales.join(main, "order_id", "left").select("order_key", "order_id", "order_sales", "main_category", "main_sub_category")


# -------------------------------------------------------------- history

# What each history column is made of: the prior-row aggregates of one scan,
# then totals and means of them, ratios and differences to the current order.
_PRIOR = {"sales": "order_sales", "profit": "order_profit", "total_quantity": "order_quantity",
          "discount": "discount_exact", "shipping_cost": "order_shipping_cost"}
_TOTALS = {"previous_total_sales": "sales", "previous_total_profit": "profit", "previous_total_quantity": "total_quantity"}
_MEANS = {"previous_avg_order_value": "sales", "previous_avg_profit": "profit", "previous_avg_discount": "discount",
          "previous_avg_shipping_cost": "shipping_cost"}
_DIFFERENCES = {"discount_vs_previous_avg": ("order_avg_discount", "previous_avg_discount"),
                "profit_vs_previous_avg": ("order_profit", "previous_avg_profit")}
_RATIOS = {"order_frequency_rate": ("previous_order_count", "customer_lifetime_days"),
           "sales_vs_previous_avg": ("order_sales", "previous_avg_order_value")}


def days_since(earlier: str) -> Column:
    return F.datediff("order_date", earlier).cast("double")


def order_history(orders: DataFrame, extra: dict | None = None) -> DataFrame:
    """The 17 leakage-safe history columns of each order (strictly earlier
    orders of the same customer, ordered by date then order key).  ``extra``
    adds more outputs of the same scan (e.g. the next order date).  The scan
    reads the orders twice, so they are written once (``plans.lineage.cut``)."""
    spec = {f"_{k}": ("prior_sum", c) for k, c in _PRIOR.items()} | {f"_n_{k}": ("prior_count", c) for k, c in _PRIOR.items()}
    spec |= {"_orders": ("prior_count", "order_key"), "previous_order_date": ("lag", "order_date"),
             "first_order_date_before_current": ("prior_min", "order_date")}
    # averages of averages are summed as decimals, so that no sum depends on where chunks begin
    exact = cut(orders.withColumn("discount_exact", F.col("order_avg_discount").cast("decimal(18,4)")), "orders")
    h = chunked_scan(exact, ["customer_id"], ["order_date", "order_key"], month_of("order_date"), spec | (extra or {}))
    h = h.withColumns({
        "is_first_order": N.flag(F.col("previous_order_date").isNull()),
        "days_since_previous_order": days_since("previous_order_date"),
        "customer_lifetime_days": days_since("first_order_date_before_current"),
        "previous_order_count": F.col("_orders").cast("double"),
        **{out: N.dbl(F.coalesce(f"_{k}", F.lit(0))) for out, k in _TOTALS.items()},
        **{out: F.try_divide(N.dbl(f"_{k}"), F.col(f"_n_{k}")) for out, k in _MEANS.items()}})
    h = h.withColumns({**{out: N.safe_div(a, b) for out, (a, b) in _RATIOS.items()},
                       **{out: N.dbl(a) - F.col(b) for out, (a, b) in _DIFFERENCES.items()}})
    return h.drop(*[c for c in spec if c.startswith("_")], "discount_exact")


HISTORY_OUT = ["previous_order_date", "is_first_order", "days_since_previous_order", "previous_order_count",
               "previous_total_sales", "previous_total_profit", "previous_total_quantity",
               "previous_avg_order_value", "previous_avg_profit", "previous_avg_discount",
               "previous_avg_shipping_cost", "first_order_date_before_current", "customer_lifetime_days",
               "order_frequency_rate", "sales_vs_previous_avg", "discount_vs_previous_avg",
               "profit_vs_previous_avg"]
_ROUND6 = {"previous_avg_order_value", "previous_avg_profit", "previous_avg_discount",
           "previous_avg_shipping_cost", "order_frequency_rate", "sales_vs_previous_avg",
           "discount_vs_previous_avg", "profit_vs_previous_avg"}

_HIST_CTE = """hw AS (
  SELECT *,
    LAG(order_date) OVER w0 AS previous_order_date,
    COUNT(order_key) OVER w AS c_n, SUM(order_sales) OVER w AS s_sales, SUM(order_profit) OVER w AS s_profit,
    SUM(order_quantity) OVER w AS s_qty, SUM(order_avg_discount) OVER w AS s_disc,
    COUNT(order_avg_discount) OVER w AS n_disc, SUM(order_shipping_cost) OVER w AS s_ship,
    MIN(order_date) OVER w AS first_order_date_before_current
  FROM od
  WINDOW w0 AS (PARTITION BY customer_id ORDER BY order_date, order_key),
         w AS (PARTITION BY customer_id ORDER BY order_date, order_key
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h1 AS (
  SELECT *,
    CAST(CASE WHEN previous_order_date IS NULL THEN 1.0 ELSE 0.0 END AS DOUBLE) AS is_first_order,
    CASE WHEN previous_order_date IS NOT NULL THEN CAST(order_date - previous_order_date AS DOUBLE) END
      AS days_since_previous_order,
    CAST(c_n AS DOUBLE) AS previous_order_count,
    CAST(COALESCE(s_sales, 0) AS DOUBLE) AS previous_total_sales,
    CAST(COALESCE(s_profit, 0) AS DOUBLE) AS previous_total_profit,
    CAST(COALESCE(s_qty, 0) AS DOUBLE) AS previous_total_quantity,
    CAST(s_sales AS DOUBLE) / NULLIF(c_n, 0) AS previous_avg_order_value,
    CAST(s_profit AS DOUBLE) / NULLIF(c_n, 0) AS previous_avg_profit,
    s_disc / NULLIF(n_disc, 0) AS previous_avg_discount,
    CAST(s_ship AS DOUBLE) / NULLIF(c_n, 0) AS previous_avg_shipping_cost,
    CASE WHEN first_order_date_before_current IS NOT NULL
         THEN CAST(order_date - first_order_date_before_current AS DOUBLE) END AS customer_lifetime_days
  FROM hw),
hist AS (
  SELECT *,
    CASE WHEN customer_lifetime_days > 0 THEN previous_order_count / customer_lifetime_days END
      AS order_frequency_rate,
    CASE WHEN previous_avg_order_value > 0 THEN CAST(order_sales AS DOUBLE) / previous_avg_order_value END
      AS sales_vs_previous_avg,
    CASE WHEN previous_avg_discount IS NOT NULL THEN order_avg_discount - previous_avg_discount END
      AS discount_vs_previous_avg,
    CASE WHEN previous_avg_profit IS NOT NULL THEN CAST(order_profit AS DOUBLE) - previous_avg_profit END
      AS profit_vs_previous_avg
  FROM h1)"""


def _hist_sel(df: DataFrame) -> DataFrame:
    return df.select("order_key", "customer_id",
                     *[N.rnd(c, 6).alias(c) if c in _ROUND6 else F.col(c) for c in HISTORY_OUT])


def _hist_sel_sql():
    return ", ".join(["order_key", "customer_id"] + [S.rnd(c, 6) + f" AS {c}" if c in _ROUND6 else c
                                                      for c in HISTORY_OUT])


@register("fe_order_history", sql=S.with_fact(f"SELECT {_hist_sel_sql()} FROM hist", _ORDER_CTE, _HIST_CTE))
def _fe_order_history(spark, sf_dir):
    return _hist_sel(order_history(order_table(spark, sf_dir)))


# ------------------------------------------------- labels and censoring


def repurchase_label(df: DataFrame, horizon: int = HORIZON_DAYS, split_col: str | None = "split") -> DataFrame:
    """Next order of the same customer INSIDE the same split within
    ``horizon`` days -> 1.0, else 0.0 (labels never look across splits)."""
    keys = ([split_col] if split_col else []) + ["customer_id"]
    out = chunked_scan(df, keys, ["order_date", "order_key"], month_of("order_date"),
                       {"next_order_date": ("lead", "order_date")})
    days = F.when(F.col("next_order_date").isNotNull(),
                  F.datediff("next_order_date", "order_date").cast("double"))
    return out.withColumn("days_to_next_order", days) \
        .withColumn("label", N.flag(F.col("days_to_next_order").isNotNull()
                                    & (F.col("days_to_next_order") <= horizon)))


def censor_horizon(df: DataFrame, split_dates=TEST_SPLIT, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Keep rows whose label window is fully observed inside their split
    (``<`` the next split start for train/valid, ``<=`` the end for test)."""
    vs, ts, end = (F.lit(x).cast("date") for x in split_dates)
    h = F.date_add("order_date", horizon)
    keep = (((F.col("split") == "train") & (h < vs)) | ((F.col("split") == "valid") & (h < ts))
            | ((F.col("split") == "test") & (h <= end)))
    return df.where(keep)


def labeled_orders(spark, sf_dir, split_dates=TEST_SPLIT, horizon=HORIZON_DAYS, with_history=False):
    """Order table (+ history) -> time split -> in-split label -> censoring.

    With history, the label reuses the history scan: splits are contiguous
    date ranges and the scan orders by date, so the next order inside the
    split is the customer's next order when that order is in the same split,
    and none otherwise -- one ordered scan instead of two.
    """
    orders = order_table(spark, sf_dir)
    if not with_history:
        split = time_split(orders, "order_date", *split_dates).where(F.col("split").isNotNull())
        return censor_horizon(repurchase_label(split, horizon), split_dates, horizon)
    h = order_history(orders, extra={"_next": ("lead", "order_date")})
    split = time_split(h, "order_date", *split_dates)
    vs, ts, end = (F.lit(x).cast("date") for x in split_dates)
    n = F.col("_next")
    next_split = F.when(n < vs, "train").when(n < ts, "valid").when(n <= end, "test")
    labeled = (split.where(F.col("split").isNotNull())
               .withColumn("next_order_date", F.when(next_split == F.col("split"), n))
               .drop("_next"))
    days = F.when(F.col("next_order_date").isNotNull(),
                  F.datediff("next_order_date", "order_date").cast("double"))
    labeled = labeled.withColumn("days_to_next_order", days) \
        .withColumn("label", N.flag(F.col("days_to_next_order").isNotNull()
                                    & (F.col("days_to_next_order") <= horizon)))
    return censor_horizon(labeled, split_dates, horizon)


def split_cte(source: str = "od") -> str:
    """DuckDB text: time split, in-split labels and censoring over ``source``."""
    return _SPLIT_CTE_T.replace("__SRC__", source)


_SPLIT_CTE_T = """sp AS (
  SELECT *, CASE WHEN order_date < DATE '1999-01-01' THEN 'train' WHEN order_date < DATE '2000-04-01' THEN 'valid'
                 WHEN order_date <= DATE '2001-08-01' THEN 'test' END AS split
  FROM __SRC__),
lab AS (
  SELECT *, CASE WHEN next_order_date IS NOT NULL THEN CAST(next_order_date - order_date AS DOUBLE) END
              AS days_to_next_order
  FROM (SELECT *, LEAD(order_date) OVER (PARTITION BY split, customer_id ORDER BY order_date, order_key)
                    AS next_order_date
        FROM sp WHERE split IS NOT NULL) x),
lab2 AS (SELECT *, CAST(CASE WHEN days_to_next_order IS NOT NULL AND days_to_next_order <= 90 THEN 1.0
                              ELSE 0.0 END AS DOUBLE) AS label FROM lab),
cens AS (SELECT * FROM lab2 WHERE (split = 'train' AND order_date + 90 < DATE '1999-01-01')
                                 OR (split = 'valid' AND order_date + 90 < DATE '2000-04-01')
                                 OR (split = 'test' AND order_date + 90 <= DATE '2001-08-01'))"""
_SPLIT_CTE = split_cte("od")


@register("fe_repurchase_label", sql=S.with_fact(
    "SELECT order_key, split, next_order_date, days_to_next_order, label FROM lab2", _ORDER_CTE, _SPLIT_CTE))
def _fe_repurchase_label(spark, sf_dir):
    orders = order_table(spark, sf_dir)
    split = time_split(orders, "order_date", *TEST_SPLIT).where(F.col("split").isNotNull())
    return repurchase_label(split).select("order_key", "split", "next_order_date", "days_to_next_order", "label")


@register("fe_censor_horizon", sql=S.with_fact(
    "SELECT order_key, split, label FROM cens", _ORDER_CTE, _SPLIT_CTE))
def _fe_censor_horizon(spark, sf_dir):
    return labeled_orders(spark, sf_dir).select("order_key", "split", "label")


def label_distribution(df: DataFrame) -> DataFrame:
    per = df.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))
    tot = df.groupBy("split").agg(F.count(F.lit(1)).alias("split_n"))  # one row per split
    return per.join(F.broadcast(tot), "split").withColumn("ratio", N.rnd(N.ratio("n", "split_n"), 6)) \
        .drop("split_n")


@register("fe_label_dist", sql=S.with_fact(f"""
SELECT split, label, COUNT(*) AS n,
       {S.rnd(S.ratio('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY split)'), 6)} AS ratio
FROM cens GROUP BY split, label""", _ORDER_CTE, _SPLIT_CTE))
def _fe_label_dist(spark, sf_dir):
    return label_distribution(labeled_orders(spark, sf_dir))


def class_weights(train: DataFrame, label: str = "label") -> DataFrame:
    """n / (k * n_c) from the training split: one row per class."""
    per = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = per.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k"))  # one row
    return per.crossJoin(F.broadcast(tot)).select(
        label, N.rnd(F.col("n") / (F.col("k") * F.col("n_c")), 6).alias("class_weight"))


def apply_class_weights(df: DataFrame, weights: DataFrame, label: str = "label") -> DataFrame:
    # one row per class: a fixed-size broadcast
    return df.join(F.broadcast(weights), label, "left")


@register("fe_class_weight", sql=S.with_fact(f"""
SELECT c.order_key, c.split, c.label, w.class_weight FROM cens c
JOIN (SELECT label, {S.rnd('CAST(t.n AS DOUBLE) / (t.k * n_c)', 6)} AS class_weight
      FROM (SELECT label, COUNT(*) AS n_c FROM cens WHERE split = 'train' GROUP BY label) p,
           (SELECT COUNT(*) AS n, COUNT(DISTINCT label) AS k FROM cens WHERE split = 'train') t) w
  ON c.label = w.label""", _ORDER_CTE, _SPLIT_CTE))
def _fe_class_weight(spark, sf_dir):
    lab = labeled_orders(spark, sf_dir)
    w = class_weights(lab.where(F.col("split") == "train"))
    return apply_class_weights(lab, w).select("order_key", "split", "label", "class_weight")


# ------------------------------------------------- line-level (ML2) features

TEST_CLAMP = {"sales": (2000.0, 100000.0), "shipping_cost": (0.0, 7000.0)}


def winsor_fit(df: DataFrame, cols: list[str], lo: float = 0.01, hi: float = 0.99,
               exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """(column, p_lo, p_hi) per column: exact nearest-rank quantiles of all
    columns at once, or a bounded-memory sketch when ``exact=False`` (a 1 %
    sketch may return min/max, H15)."""
    if exact:
        q = exact_quantiles(df.select(*[N.dbl(c).alias(c) for c in cols]), cols, [lo, hi])
    else:
        q = reduce(DataFrame.unionByName, [approx_quantiles(df, c, [lo, hi], accuracy).select(
            F.lit(c).alias("column_name"), "p", N.dbl("value").alias("value")) for c in cols])
    return q.groupBy("column_name").agg(F.max(F.when(F.col("p") == lo, F.col("value"))).alias("p_lo"),
                                        F.max(F.when(F.col("p") == hi, F.col("value"))).alias("p_hi"))


def winsorize(df: DataFrame, fit: DataFrame, cols: list[str], suffix: str = "_capped") -> DataFrame:
    """Clamp each column to its fitted (p_lo, p_hi); the fit has one row per
    column, so joining it is a fixed-size broadcast."""
    wide = fit.groupBy().pivot("column_name", cols).agg(F.first("p_lo").alias("lo"), F.first("p_hi").alias("hi"))
    out = df.crossJoin(F.broadcast(wide))
    for c in cols:
        x = N.dbl(c)
        out = out.withColumn(c + suffix, F.when(x < F.col(f"{c}_lo"), F.col(f"{c}_lo"))
                             .when(x > F.col(f"{c}_hi"), F.col(f"{c}_hi")).otherwise(x))
    return out.drop(*[f"{c}_{b}" for c in cols for b in ("lo", "hi")])


def _exact_q_sql(col, p):
    return (f"(SELECT CAST({col} AS DOUBLE) FROM (SELECT {col}, ROW_NUMBER() OVER (ORDER BY {col}) AS rk, "
            f"COUNT(*) OVER () AS n FROM fact WHERE {col} IS NOT NULL) q "
            f"WHERE rk = GREATEST(1, CAST(ceil({p} * n) AS BIGINT)))")


@register("fe_winsorize_fit", sql=S.with_fact(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {_exact_q_sql(c, 0.01)} AS p_lo, {_exact_q_sql(c, 0.99)} AS p_hi"
    for c in ("sales", "shipping_cost"))))
def _fe_winsorize_fit(spark, sf_dir):
    return winsor_fit(order_lines(spark, sf_dir, ["sales", "shipping_cost"]), ["sales", "shipping_cost"])


@register("fe_winsorize", sql=S.with_fact(f"""
SELECT order_id, product_id, ship_date,
       CASE WHEN CAST(sales AS DOUBLE) < {_exact_q_sql('sales', 0.01)} THEN {_exact_q_sql('sales', 0.01)}
            WHEN CAST(sales AS DOUBLE) > {_exact_q_sql('sales', 0.99)} THEN {_exact_q_sql('sales', 0.99)}
            ELSE CAST(sales AS DOUBLE) END AS sales_capped
FROM fact"""))
def _fe_winsorize(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "product_id", "ship_date", "sales"])
    fit = winsor_fit(df, ["sales"])
    return winsorize(df, fit, ["sales"]).select("order_id", "product_id", "ship_date", "sales_capped")


def clamp_fixed(df: DataFrame, bounds: dict[str, tuple[float, float]], suffix: str = "_capped") -> DataFrame:
    for c, (lo, hi) in bounds.items():
        df = df.withColumn(c + suffix, N.clamp(N.dbl(c), lo, hi))
    return df


@register("fe_winsorize_fixed", sql=S.with_fact("""
SELECT order_id, product_id, ship_date,
       CASE WHEN CAST(sales AS DOUBLE) < 2000.0 THEN 2000.0 WHEN CAST(sales AS DOUBLE) > 100000.0 THEN 100000.0
            ELSE CAST(sales AS DOUBLE) END AS sales_capped,
       CASE WHEN CAST(shipping_cost AS DOUBLE) < 0.0 THEN 0.0 WHEN CAST(shipping_cost AS DOUBLE) > 7000.0 THEN 7000.0
            ELSE CAST(shipping_cost AS DOUBLE) END AS shipping_cost_capped
FROM fact"""))
def _fe_winsorize_fixed(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "product_id", "ship_date", "sales", "shipping_cost"])
    return clamp_fixed(df, TEST_CLAMP).select("order_id", "product_id", "ship_date", "sales_capped",
                                              "shipping_cost_capped")


_CAPPED_SQL = """CASE WHEN CAST(sales AS DOUBLE) < 2000.0 THEN 2000.0 WHEN CAST(sales AS DOUBLE) > 100000.0
                  THEN 100000.0 ELSE CAST(sales AS DOUBLE) END"""
_SHIPC_SQL = """CASE WHEN CAST(shipping_cost AS DOUBLE) < 0.0 THEN 0.0 WHEN CAST(shipping_cost AS DOUBLE) > 7000.0
                 THEN 7000.0 ELSE CAST(shipping_cost AS DOUBLE) END"""


@register("fe_ratios", sql=S.with_fact(f"""
SELECT order_id, product_id, ship_date,
       {S.rnd(f'({_CAPPED_SQL}) * CAST(discount AS DOUBLE)', 4)} AS discount_amount,
       {S.rnd(f'CASE WHEN ({_CAPPED_SQL}) = 0 THEN 0.0 ELSE ({_SHIPC_SQL}) / ({_CAPPED_SQL}) END', 6)} AS shipping_ratio,
       {S.rnd(f'CASE WHEN quantity = 0 THEN 0.0 ELSE ({_CAPPED_SQL}) / quantity END', 4)} AS avg_item_value,
       CAST(ship_date - order_date AS INTEGER) AS delivery_days,
       CAST(CASE WHEN discount > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS is_discounted,
       CAST(CASE WHEN discount >= 0.06 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS high_discount
FROM fact"""))
def _fe_ratios(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "product_id", "ship_date", "order_date", "sales",
                                     "shipping_cost", "quantity", "discount", "market", "category"])
    r = line_features(df, TEST_SERVING).withColumn("delivery_days", F.col("delivery_days").cast("int"))
    return r.select("order_id", "product_id", "ship_date", N.rnd("discount_amount", 4).alias("discount_amount"),
                    N.rnd("shipping_ratio", 6).alias("shipping_ratio"),
                    N.rnd("avg_item_value", 4).alias("avg_item_value"), "delivery_days", "is_discounted",
                    "high_discount")


@register("fe_market_category", sql=S.with_fact("""
SELECT market, category, concat_ws('_', market, category) AS market_category, COUNT(*) AS n_lines
FROM fact GROUP BY ALL"""))
def _fe_market_category(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["market", "category"])
    return df.groupBy("market", "category", F.concat_ws("_", "market", "category").alias("market_category")) \
        .agg(F.count(F.lit(1)).alias("n_lines"))


def fit_log_shift(df: DataFrame, target: str = "profit") -> DataFrame:
    """Shift that makes log(target + shift) defined for every training row:
    1 - min(target) (one row).  The reference's fixed 3000 would drop rows."""
    return df.agg((F.lit(1) - F.min(N.dbl(target))).alias("shift"))


@register("fe_log_target", sql=S.with_fact(f"""
SELECT order_id, product_id, ship_date, {S.rnd('ln(CAST(profit AS DOUBLE) + s.shift)', 6)} AS log_profit
FROM fact, (SELECT 1 - MIN(CAST(profit AS DOUBLE)) AS shift FROM fact) s"""))
def _fe_log_target(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "product_id", "ship_date", "profit"])
    shift = fit_log_shift(df)  # one row
    return df.crossJoin(F.broadcast(shift)).select(
        "order_id", "product_id", "ship_date",
        N.rnd(F.log(N.dbl("profit") + F.col("shift")), 6).alias("log_profit"))


def customer_history(orders: DataFrame, sales: str = "sales_capped", profit: str = "profit") -> DataFrame:
    """ML2 cumulative history at order level: prior sales, profit, margin."""
    h = chunked_scan(orders, ["customer_id"], ["order_date", "order_id"], month_of("order_date"),
                     {"_s": ("prior_sum", sales), "_p": ("prior_sum", profit)})
    hs = N.dbl(F.coalesce(F.col("_s"), F.lit(0)))
    hp = N.dbl(F.coalesce(F.col("_p"), F.lit(0)))
    return h.withColumn("cust_hist_sales", hs).withColumn("cust_hist_profit", hp) \
        .withColumn("cust_hist_margin", F.when(F.col("cust_hist_sales") == 0, F.lit(0.0))
                    .otherwise(F.col("cust_hist_profit") / F.col("cust_hist_sales"))).drop("_s", "_p")


def _capped_orders(spark, sf_dir) -> DataFrame:
    df = order_lines(spark, sf_dir, ["customer_id", "order_id", "order_date", "sales", "profit"])
    return capped_orders(df, *TEST_CLAMP["sales"])


def capped_orders(lines: DataFrame, lo: float, hi: float) -> DataFrame:
    """Capped sales and profit per order, summed as decimals (no sum depends on the partitioning)."""
    low, high = (F.lit(str(x)).cast("decimal(18,2)") for x in (lo, hi))
    x = F.col("sales")
    capped = F.when(x < low, low).when(x > high, high).otherwise(x)
    return lines.groupBy("customer_id", "order_id", "order_date").agg(
        F.sum(capped).alias("sales_capped"), F.sum("profit").alias("profit"))


def order_sums(spark, sf_dir, lo: float, hi: float) -> DataFrame:
    """Capped sales and profit per order, summed before the orders join: the lines never meet the orders."""
    low, high = (F.lit(str(x)).cast("decimal(18,2)") for x in (lo, hi))
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_quantity")
    x = fact_column("sales")
    per = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.sum(F.when(x < low, low).when(x > high, high).otherwise(x)).alias("sales_capped"),
        F.sum(fact_column("profit")).alias("profit"))
    return per.join(order_lines_side(spark, sf_dir, ["customer_id", "order_date"]), "order_id")


_CUST_HIST_CTE = f"""co AS (SELECT customer_id, order_id, order_date, SUM({_CAPPED_SQL}) AS sales_capped,
                          SUM(profit) AS profit FROM fact GROUP BY ALL),
ch AS (SELECT customer_id, order_id, order_date,
              CAST(COALESCE(SUM(sales_capped) OVER w, 0) AS DOUBLE) AS cust_hist_sales,
              CAST(COALESCE(SUM(profit) OVER w, 0) AS DOUBLE) AS cust_hist_profit
       FROM co WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chm AS (SELECT *, CASE WHEN cust_hist_sales = 0 THEN 0.0 ELSE cust_hist_profit / cust_hist_sales END
                    AS cust_hist_margin FROM ch)"""


@register("fe_customer_history", sql=S.with_fact(f"""
SELECT customer_id, order_id, {S.rnd('cust_hist_sales', 4)} AS cust_hist_sales,
       {S.rnd('cust_hist_profit', 4)} AS cust_hist_profit, {S.rnd('cust_hist_margin', 6)} AS cust_hist_margin
FROM chm""", _CUST_HIST_CTE))
def _fe_customer_history(spark, sf_dir):
    h = customer_history(_capped_orders(spark, sf_dir))
    return h.select("customer_id", "order_id", N.rnd("cust_hist_sales", 4).alias("cust_hist_sales"),
                    N.rnd("cust_hist_profit", 4).alias("cust_hist_profit"),
                    N.rnd("cust_hist_margin", 6).alias("cust_hist_margin"))


def customer_snapshot(history: DataFrame, inclusive: bool = False) -> DataFrame:
    """Latest history row per customer (an aggregation: skew-safe).

    The reference keeps the history *before* the last order, so the last
    order itself is missing from the snapshot (H17); ``inclusive=True``
    adds it.
    """
    cols = ["cust_hist_sales", "cust_hist_profit"]
    if inclusive:
        history = history.withColumn("cust_hist_sales", F.col("cust_hist_sales") + N.dbl("sales_capped")) \
            .withColumn("cust_hist_profit", F.col("cust_hist_profit") + N.dbl("profit"))
    packed = F.struct("order_date", "order_id")
    snap = history.groupBy("customer_id").agg(*[F.max_by(c, packed).alias(c) for c in cols])
    return snap.withColumn("cust_hist_margin", F.when(F.col("cust_hist_sales") == 0, F.lit(0.0))
                           .otherwise(F.col("cust_hist_profit") / F.col("cust_hist_sales")))


@register("fe_customer_snapshot", sql=S.with_fact(f"""
SELECT customer_id, {S.rnd('arg_max(cust_hist_sales, (order_date, order_id))', 4)} AS cust_hist_sales,
       {S.rnd('arg_max(cust_hist_profit, (order_date, order_id))', 4)} AS cust_hist_profit,
       {S.rnd('CASE WHEN arg_max(cust_hist_sales, (order_date, order_id)) = 0 THEN 0.0 ELSE arg_max(cust_hist_profit, (order_date, order_id)) / arg_max(cust_hist_sales, (order_date, order_id)) END', 6)} AS cust_hist_margin
FROM chm GROUP BY customer_id""", _CUST_HIST_CTE))
def _fe_customer_snapshot(spark, sf_dir):
    snap = customer_snapshot(customer_history(_capped_orders(spark, sf_dir)))
    return snap.select("customer_id", N.rnd("cust_hist_sales", 4).alias("cust_hist_sales"),
                       N.rnd("cust_hist_profit", 4).alias("cust_hist_profit"),
                       N.rnd("cust_hist_margin", 6).alias("cust_hist_margin"))


# ----------------------------------------------------- scoring-time replica

TEST_SERVING = ServingParams(sales_lo=2000.0, sales_hi=100000.0, ship_lo=0.0, ship_hi=7000.0,
                             high_discount=0.06)


def order_requests(spark, sf_dir) -> DataFrame:
    """Order requests as the stream carries them (text date, reference names),
    one per order line of the fact view."""
    df = order_lines(spark, sf_dir, ["order_id", "customer_id", "order_date", "category", "sub_category",
                                     "sales", "discount", "quantity", "shipping_cost", "market", "product_id",
                                     "ship_date"])
    return df.select(F.col("order_id").cast("string").alias("Order_ID"),
                     F.col("customer_id").cast("string").alias("Customer_ID"),
                     F.date_format("order_date", "yyyy-MM-dd").alias("Order_Date"),
                     F.col("category").alias("Category"), F.col("sub_category").alias("Sub_Category"),
                     N.dbl("sales").alias("Sales"), N.dbl("discount").alias("Discount"),
                     F.col("quantity").alias("Quantity"), N.dbl("shipping_cost").alias("Shipping_Cost"),
                     F.col("market").alias("Market"), "product_id", "ship_date")


@register("fe_realtime", sql=S.with_fact(f"""
SELECT CAST(order_id AS VARCHAR) AS "Order_ID", product_id, ship_date,
       CAST(year(order_date) AS INTEGER) AS "Year", CAST(weekofyear(order_date) AS INTEGER) AS weeknum,
       {S.rnd(f'({_CAPPED_SQL}) * CAST(discount AS DOUBLE)', 4)} AS discount_amount,
       {S.rnd(f'CASE WHEN ({_CAPPED_SQL}) = 0 THEN 0.0 ELSE ({_SHIPC_SQL}) / ({_CAPPED_SQL}) END', 6)} AS shipping_ratio,
       {S.rnd(f'CASE WHEN quantity = 0 THEN 0.0 ELSE ({_CAPPED_SQL}) / quantity END', 4)} AS avg_item_value,
       CAST(4.0 AS DOUBLE) AS delivery_days,
       CAST(CASE WHEN discount >= 0.06 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS high_discount,
       concat_ws('_', market, category) AS "Market_Category", 'Consumer' AS "Segment"
FROM fact"""))
def _fe_realtime(spark, sf_dir):
    f = message_features(order_requests(spark, sf_dir), TEST_SERVING)
    return f.select(F.col("order_id").alias("Order_ID"), "product_id", "ship_date", F.col("year").alias("Year"), "weeknum",
                    N.rnd("discount_amount", 4).alias("discount_amount"),
                    N.rnd("shipping_ratio", 6).alias("shipping_ratio"),
                    N.rnd("avg_item_value", 4).alias("avg_item_value"), "delivery_days", "high_discount",
                    F.col("market_category").alias("Market_Category"), F.col("segment").alias("Segment"))
