"""Single-operator building blocks: projections, filters, null handling,
cleaning, joins, sorting / top-k / sampling / splits and set operations.

Each library function is a plain DataFrame transformation.  The registered
wrappers run it over the fact view (or the dirty / raw views derived from
it) and carry the DuckDB oracle text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import numeric as N
from ledgerline.plans import sqltext as S
from ledgerline.plans.ordered import ordered_scan
from ledgerline.plans.registry import register
from ledgerline.sources.fact import order_lines, part_totals, read_table
from ledgerline.sources.fixtures import DIRTY_CTE_SQL, RAW_CTE_SQL, dirty_lines, raw_lines

# ----------------------------------------------------------------- library


def with_default(df: DataFrame, column: str, value, dtype: str = "string") -> DataFrame:
    """Add ``column`` with ``value`` if missing, else replace its nulls."""
    if column not in df.columns:
        return df.withColumn(column, F.lit(value).cast(dtype))
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value).cast(dtype)))


def blank_or_null(c: str) -> Column:
    """Null, or text that is empty after trimming."""
    return F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")


def dotted_to_underscore(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def positive_rows(sales: str = "sales", quantity: str = "quantity") -> Column:
    """Sales > 0 and quantity > 0; never null, so its negation is the exact complement."""
    return F.coalesce((F.col(sales) > 0) & (F.col(quantity) > 0), F.lit(False))


def split_positive(df: DataFrame, sales: str = "sales", quantity: str = "quantity"):
    """(kept, removed): rows with sales > 0 and quantity > 0, and the rest."""
    keep = positive_rows(sales, quantity)
    return df.where(keep), df.where(~keep)


def top_and_bottom(df: DataFrame, value: str, key: str, k: int = 5) -> DataFrame:
    top = df.orderBy(F.desc(value), key).limit(k).withColumn("group_label", F.lit("Top High"))
    low = df.orderBy(F.asc(value), key).limit(k).withColumn("group_label", F.lit("Top Low"))
    return top.unionByName(low)


def time_split(df: DataFrame, date_col: str, valid_start: str, test_start: str, end: str) -> DataFrame:
    """Label rows train / valid / test by date; rows after ``end`` get no label."""
    d = F.col(date_col)
    label = (F.when(d < F.lit(valid_start).cast("date"), "train")
             .when(d < F.lit(test_start).cast("date"), "valid")
             .when(d <= F.lit(end).cast("date"), "test"))
    return df.withColumn("split", label)


def hash_unit(cols, seed: int = 42) -> Column:
    """A number in [0, 1) from the MD5 of the row's key: the same on every
    engine, cluster size and file layout."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_unit_sql(cols, seed: int = 42) -> str:
    text = " || '|' || ".join([f"'{seed}'", *[f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols]])
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS UBIGINT)::DOUBLE / 4294967296.0)"


def hash_split(df: DataFrame, key, weights=(0.8, 0.2), seed: int = 42) -> DataFrame:
    """Split by a hash of the key column(s): stable under recomputation,
    unlike ``randomSplit`` on a reshuffled input."""
    u = hash_unit([key] if isinstance(key, str) else key, seed)
    total = float(sum(weights))
    label = None
    edge = 0.0
    for i, w in enumerate(weights):
        edge += w / total
        cond = u < F.lit(edge)
        label = F.when(cond, F.lit(i)) if label is None else label.when(cond, F.lit(i))
    return df.withColumn("split_id", label.otherwise(F.lit(len(weights) - 1)))


def hash_sample(df: DataFrame, key_cols: list[str], fraction: float, seed: int = 42) -> DataFrame:
    """Reproducible Bernoulli-like sample keyed on a hash of the row key."""
    return df.where(hash_unit(key_cols, seed) < F.lit(fraction))


def sample_keep_outliers(df: DataFrame, value: str, threshold: float, fraction: float, key_cols: list[str],
                         seed: int = 42) -> DataFrame:
    """All rows with |value| > threshold plus a hash sample of the rest (a null value is no outlier)."""
    extreme = F.coalesce(F.abs(F.col(value)) > F.lit(threshold), F.lit(False))
    return df.where(extreme | (hash_unit(key_cols, seed) < F.lit(fraction)))


# ------------------------------------------------------- 2.2 projections

LINE_COLS = ["order_id", "customer_id", "category", "sub_category", "sales", "discount"]


@register("proj_select_alias", sql=S.with_fact("""
SELECT order_id AS order_key, customer_id, category, sub_category AS subcat,
       CAST(sales AS DOUBLE) AS sales, CAST(ROUND(sales * (1 - discount), 2) AS DOUBLE) AS net_sales
FROM fact"""))
def _proj_select_alias(spark, sf_dir):
    df = order_lines(spark, sf_dir, LINE_COLS)
    return (df.select(F.col("order_id").alias("order_key"), "customer_id", "category", "sub_category",
                      N.dbl("sales").alias("sales"),
                      N.money(F.col("sales") * (F.lit(1) - F.col("discount"))).alias("net_sales"),
                      "discount")
            .withColumnRenamed("sub_category", "subcat").drop("discount"))


@register("proj_star_plus", sql=S.with_fact(f"""
SELECT order_id, customer_id, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit,
       {S.rnd(S.ratio('profit', 'sales'), 4)} AS margin
FROM fact"""))
def _proj_star_plus(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "customer_id", "sales", "profit"])
    packed = df.select(F.struct("*").alias("data"))  # envelope, as a parsed message
    return packed.select("data.*").select(
        "*", N.rnd(N.ratio("profit", "sales"), 4).alias("margin")) \
        .withColumn("sales", N.dbl("sales")).withColumn("profit", N.dbl("profit"))


# ----------------------------------------------------------- 2.2 filters


@register("filter_and_or", sql=S.with_fact("""
SELECT order_id, product_id, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit
FROM fact
WHERE (sales > 50000 AND profit < 0) OR (discount IS NULL OR discount >= 0.09)"""))
def _filter_and_or(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "product_id", "sales", "profit", "discount"])
    cond = ((F.col("sales") > 50000) & (F.col("profit") < 0)) | \
           (F.col("discount").isNull() | (F.col("discount") >= F.lit(0.09)))
    return df.where(cond).select("order_id", "product_id", N.dbl("sales").alias("sales"),
                                 N.dbl("profit").alias("profit"))


@register("filter_not_null", sql=S.with_fact("""
SELECT market, COUNT(*) AS n_lines FROM dirty
WHERE ship_date IS NOT NULL AND discount IS NOT NULL AND order_priority IS NOT NULL
GROUP BY market""", DIRTY_CTE_SQL))
def _filter_not_null(spark, sf_dir):
    df = dirty_lines(spark, sf_dir)
    return (df.where(F.col("ship_date").isNotNull() & F.col("discount").isNotNull()
                     & F.col("order_priority").isNotNull())
            .groupBy("market").agg(F.count(F.lit(1)).alias("n_lines")))


@register("filter_in", sql=S.with_fact("""
SELECT segment, COUNT(*) AS n_lines, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales
FROM fact WHERE segment IN ('BUILDING', 'FURNITURE', 'MACHINERY') GROUP BY segment"""))
def _filter_in(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["segment", "sales"])
    return (df.where(F.col("segment").isin("BUILDING", "FURNITURE", "MACHINERY"))
            .groupBy("segment").agg(F.count(F.lit(1)).alias("n_lines"),
                                    N.money(F.sum("sales")).alias("total_sales")))


@register("filter_between", sql=S.with_fact("""
SELECT CASE WHEN quantity BETWEEN 1 AND 10 THEN 'small' WHEN quantity BETWEEN 11 AND 30 THEN 'medium'
            ELSE 'large' END AS size_band, COUNT(*) AS n_lines
FROM fact GROUP BY 1"""))
def _filter_between(spark, sf_dir):
    q = F.col("quantity")
    band = F.when(q.between(1, 10), "small").when(q.between(11, 30), "medium").otherwise("large")
    return order_lines(spark, sf_dir, ["quantity"]).groupBy(band.alias("size_band")) \
        .agg(F.count(F.lit(1)).alias("n_lines"))


@register("filter_equal_value", sql=S.with_fact("""
SELECT COUNT(*) AS n_lines, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales,
       CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS total_profit
FROM fact WHERE category = 'PROMO'"""))
def _filter_equal_value(spark, sf_dir):
    df = part_totals(spark, sf_dir, ["category"], ["sales", "profit"])
    return df.where(F.col("category") == "PROMO").agg(
        F.sum("n_lines").cast("bigint").alias("n_lines"), N.money(F.sum("sales")).alias("total_sales"),
        N.money(F.sum("profit")).alias("total_profit"))


@register("case_searched", sql=S.with_fact("""
SELECT CASE WHEN sales < 35000 THEN 'Low Value' WHEN sales < 70000 THEN 'Medium Value'
            ELSE 'High Value' END AS value_tier,
       CASE WHEN discount = 0 THEN 'none' WHEN discount <= 0.03 THEN 'low' WHEN discount <= 0.06 THEN 'medium'
            ELSE 'high' END AS discount_tier,
       COUNT(*) AS n_lines
FROM dirty GROUP BY 1, 2""", DIRTY_CTE_SQL))
def _case_searched(spark, sf_dir):
    from ledgerline.operators.queries import value_tier
    df = dirty_lines(spark, sf_dir)
    d = F.col("discount")
    dt = F.when(d == 0, "none").when(d <= F.lit(0.03), "low").when(d <= F.lit(0.06), "medium") \
          .otherwise("high")
    return df.groupBy(value_tier("sales", 35000, 70000).alias("value_tier"), dt.alias("discount_tier")) \
        .agg(F.count(F.lit(1)).alias("n_lines"))


PRIORITY_ORDER = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("case_simple", sql=S.with_fact("""
SELECT order_priority, COUNT(DISTINCT order_id) AS n_orders,
       CAST(CASE order_priority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
            WHEN '4-NOT SPECIFIED' THEN 4 ELSE 5 END AS INTEGER) AS priority_rank
FROM fact GROUP BY order_priority ORDER BY priority_rank"""))
def _case_simple(spark, sf_dir):
    p = F.col("order_priority")
    rank = F.when(p == PRIORITY_ORDER[0], 1)
    for i, v in enumerate(PRIORITY_ORDER[1:-1], start=2):
        rank = rank.when(p == v, i)
    rank = rank.otherwise(len(PRIORITY_ORDER))
    return (order_lines(spark, sf_dir, ["order_priority", "order_id"]).groupBy("order_priority")
            .agg(F.countDistinct("order_id").alias("n_orders"))
            .withColumn("priority_rank", rank.cast("int")).orderBy("priority_rank"))


# ------------------------------------------------------- 2.2 null handling


def _orders_with_lines(spark, sf_dir):
    """Every order, with line totals; orders without a line get nulls."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    lines = order_lines(spark, sf_dir, ["order_id", "sales"]).groupBy("order_id") \
        .agg(F.sum("sales").alias("order_sales"), F.count(F.lit(1)).alias("n_lines"),
             F.min("sales").cast("string").alias("min_line"))
    return orders.join(lines, orders["o_orderkey"] == lines["order_id"], "left")


_ORDERS_LINES_SQL = """ol AS (
  SELECT o.o_orderkey, o.o_orderpriority, l.order_sales, l.n_lines, l.min_line
  FROM orders o LEFT JOIN (SELECT order_id, SUM(sales) AS order_sales, COUNT(*) AS n_lines,
                                  CAST(MIN(sales) AS VARCHAR) AS min_line
                           FROM fact GROUP BY order_id) l ON o.o_orderkey = l.order_id)"""


@register("null_coalesce", sql=S.with_fact("""
SELECT o_orderkey AS order_id, CAST(COALESCE(order_sales, 0) AS DOUBLE) AS order_sales,
       'Consumer' AS segment FROM ol""", _ORDERS_LINES_SQL))
def _null_coalesce(spark, sf_dir):
    df = _orders_with_lines(spark, sf_dir)
    out = df.select(F.col("o_orderkey").alias("order_id"),
                    F.coalesce(F.col("order_sales"), F.lit(0)).cast("double").alias("order_sales"))
    return with_default(out, "segment", "Consumer")


@register("null_fill", sql=S.with_fact("""
SELECT o_orderkey AS order_id, COALESCE(CAST(order_sales AS DOUBLE), 0.0) AS order_sales,
       COALESCE(n_lines, 0) AS n_lines, COALESCE(min_line, 'Unknown') AS min_line FROM ol""",
                                        _ORDERS_LINES_SQL))
def _null_fill(spark, sf_dir):
    df = _orders_with_lines(spark, sf_dir).select(
        F.col("o_orderkey").alias("order_id"), N.dbl("order_sales").alias("order_sales"), "n_lines",
        "min_line")
    return df.na.fill({"order_sales": 0.0, "n_lines": 0}).fillna("Unknown", subset=["min_line"])


@register("null_drop", sql=S.with_fact("""
SELECT o_orderkey AS order_id, CAST(order_sales AS DOUBLE) AS order_sales, n_lines FROM ol
WHERE order_sales IS NOT NULL AND n_lines IS NOT NULL""", _ORDERS_LINES_SQL))
def _null_drop(spark, sf_dir):
    df = _orders_with_lines(spark, sf_dir).select(
        F.col("o_orderkey").alias("order_id"), N.dbl("order_sales").alias("order_sales"), "n_lines")
    return df.dropna(subset=["order_sales", "n_lines"])


@register("null_typed_literal", sql=S.with_fact("""
SELECT order_id, product_id, ship_date, order_date,
       CASE WHEN ship_date >= order_date THEN CAST(ship_date - order_date AS DOUBLE) ELSE CAST(NULL AS DOUBLE) END
         AS ship_days
FROM fact"""))
def _null_typed_literal(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "product_id", "ship_date", "order_date"])
    return df.withColumn("ship_days", F.when(F.col("ship_date") >= F.col("order_date"),
                                             F.datediff("ship_date", "order_date").cast("double"))
                         .otherwise(F.lit(None).cast("double")))


@register("blank_or_null", sql=S.with_fact("""
SELECT column_name, CAST(n_missing AS BIGINT) AS n_missing FROM (
  SELECT SUM(CASE WHEN customer_name IS NULL OR trim(customer_name) = '' THEN 1 ELSE 0 END) AS customer_name,
         SUM(CASE WHEN order_priority IS NULL OR trim(order_priority) = '' THEN 1 ELSE 0 END) AS order_priority,
         SUM(CASE WHEN category IS NULL OR trim(category) = '' THEN 1 ELSE 0 END) AS category,
         SUM(CASE WHEN discount IS NULL OR trim(CAST(discount AS VARCHAR)) = '' THEN 1 ELSE 0 END) AS discount
  FROM dirty) UNPIVOT (n_missing FOR column_name IN (customer_name, order_priority, category, discount))
""", DIRTY_CTE_SQL))
def _blank_or_null(spark, sf_dir):
    df = dirty_lines(spark, sf_dir)
    cols = ["customer_name", "order_priority", "category", "discount"]
    wide = df.agg(*[F.sum(blank_or_null(c).cast("bigint")).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "n_missing")


@register("cast_types", sql=S.with_fact("""
SELECT CAST(order_id AS VARCHAR) AS order_key, CAST(quantity AS DOUBLE) AS quantity_d,
       strftime(order_date, '%Y-%m-%d') AS order_day, CAST(sales AS DOUBLE) AS sales_d,
       CAST(CAST(strftime(order_date, '%Y-%m-%d') AS DATE) AS DATE) AS order_date_back
FROM fact"""))
def _cast_types(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "quantity", "order_date", "sales"])
    return df.select(F.col("order_id").cast("string").alias("order_key"),
                     F.col("quantity").cast("double").alias("quantity_d"),
                     F.col("order_date").cast("string").alias("order_day"),
                     F.col("sales").cast("double").alias("sales_d"),
                     F.col("order_date").cast("string").cast("date").alias("order_date_back"))


def coerce_raw(raw: DataFrame) -> DataFrame:
    """Typed columns from text; unreadable values become null, then dropped."""
    typed = raw.select(
        F.col("`Order.ID`").try_cast("bigint").alias("order_id"),
        F.col("`Order.Date`").try_cast("date").alias("order_date"),
        F.col("Sales").try_cast("double").alias("sales"),
        F.col("Quantity").try_cast("int").alias("quantity"))
    return typed.dropna()


@register("coerce_types", sql=S.with_fact("""
SELECT * FROM (SELECT TRY_CAST("Order.ID" AS BIGINT) AS order_id, TRY_CAST("Order.Date" AS DATE) AS order_date,
                      TRY_CAST("Sales" AS DOUBLE) AS sales, TRY_CAST("Quantity" AS INTEGER) AS quantity
               FROM raw) t
WHERE order_id IS NOT NULL AND order_date IS NOT NULL AND sales IS NOT NULL AND quantity IS NOT NULL""",
                                          RAW_CTE_SQL))
def _coerce_types(spark, sf_dir):
    return coerce_raw(raw_lines(spark, sf_dir))


@register("clean_rename", sql=S.with_fact("""
SELECT "Order.ID" AS "Order_ID", "Order.Date" AS "Order_Date", "Ship.Date" AS "Ship_Date",
       "Shipping.Cost" AS "Shipping_Cost", "Customer.Name" AS "Customer_Name", "Market"
FROM raw""", RAW_CTE_SQL))
def _clean_rename(spark, sf_dir):
    raw = raw_lines(spark, sf_dir).select("`Order.ID`", "`Order.Date`", "`Ship.Date`", "`Shipping.Cost`",
                                          "`Customer.Name`", "Market")
    return dotted_to_underscore(raw)


@register("clean_positive_sales", sql=S.with_fact("""
SELECT CAST(SUM(CASE WHEN COALESCE(sales > 0 AND quantity > 0, FALSE) THEN 1 ELSE 0 END) AS BIGINT) AS kept_rows,
       CAST(SUM(CASE WHEN COALESCE(sales > 0 AND quantity > 0, FALSE) THEN 0 ELSE 1 END) AS BIGINT) AS removed_rows,
       CAST(SUM(CASE WHEN COALESCE(sales > 0 AND quantity > 0, FALSE) THEN 0 ELSE sales END) AS DOUBLE)
         AS removed_sales
FROM dirty""", DIRTY_CTE_SQL))
def _clean_positive_sales(spark, sf_dir):
    keep = positive_rows()
    return dirty_lines(spark, sf_dir).agg(
        F.count_if(keep).alias("kept_rows"), F.count_if(~keep).alias("removed_rows"),
        N.dbl(F.sum(F.when(~keep, F.col("sales")))).alias("removed_sales"))


@register("clean_drop_columns", sql=S.with_fact("""
SELECT "Order.ID", "Customer.Name", "Order.Date", "Ship.Date", "Sales", "Quantity", "Shipping.Cost", "Market"
FROM raw""", RAW_CTE_SQL))
def _clean_drop_columns(spark, sf_dir):
    return raw_lines(spark, sf_dir).drop("Row_ID", "Market2", "Records")


# ---------------------------------------------------------------- 2.3 joins


@register("join_cross_scalar", sql=S.with_fact(f"""
SELECT market, {S.money('ms')} AS market_sales, {S.rnd(S.pct('ms', 'g.grand_total'))} AS share_pct
FROM (SELECT market, SUM(sales) AS ms FROM fact GROUP BY market) m
CROSS JOIN (SELECT SUM(sales) AS grand_total FROM fact) g"""))
def _join_cross_scalar(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["market", "sales"])
    per = df.groupBy("market").agg(F.sum("sales").alias("ms"))
    grand = per.agg(F.sum("ms").alias("grand_total"))  # exactly one row
    return per.crossJoin(F.broadcast(grand)).select(
        "market", N.money("ms").alias("market_sales"), N.rnd(N.pct("ms", "grand_total")).alias("share_pct"))


def positional_join(left: DataFrame, left_order: list, right: DataFrame, right_order: list,
                    num_ranges: int | None = None) -> DataFrame:
    """Pair the i-th row of ``left`` with the i-th row of ``right``.

    Both sides get a global row number from the skew-safe ordered scan; the
    pairing is then an ordinary equi-join on that number.
    """
    a = ordered_scan(left, [], left_order, {"_pos": ("row_number", None)}, num_ranges)
    b = ordered_scan(right, [], right_order, {"_pos": ("row_number", None)}, num_ranges)
    return a.join(b, "_pos").withColumnRenamed("_pos", "position")


@register("join_positional", sql=S.with_fact("""
SELECT a.position, a.order_id AS order_id_by_date, b.order_id AS order_id_by_sales,
       CAST(b.os AS DOUBLE) AS paired_sales
FROM (SELECT order_id, ROW_NUMBER() OVER (ORDER BY od, order_id) AS position FROM o) a
JOIN (SELECT order_id, os, ROW_NUMBER() OVER (ORDER BY os DESC, order_id) AS position FROM o) b
  ON a.position = b.position""", """o AS (SELECT order_id, MIN(order_date) AS od, SUM(sales) AS os
  FROM fact GROUP BY order_id)"""))
def _join_positional(spark, sf_dir):
    o = order_lines(spark, sf_dir, ["order_id", "order_date", "sales"]).groupBy("order_id") \
        .agg(F.min("order_date").alias("od"), F.sum("sales").alias("os"))
    a = o.select(F.col("order_id").alias("order_id_by_date"), "od")
    b = o.select(F.col("order_id").alias("order_id_by_sales"), "os")
    out = positional_join(a, ["od", "order_id_by_date"], b, [F.desc("os"), F.asc("order_id_by_sales")])
    return out.select(F.col("position").cast("bigint").alias("position"), "order_id_by_date",
                      "order_id_by_sales", N.dbl("os").alias("paired_sales"))


# ---------------------------------------------------- 2.6 sort, top-k, sample


@register("sort_multi", sql=S.with_fact("""
SELECT market, segment, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales FROM fact
GROUP BY market, segment ORDER BY market ASC, total_sales DESC, segment"""))
def _sort_multi(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["market", "segment", "sales"])
    return df.groupBy("market", "segment").agg(N.money(F.sum("sales")).alias("total_sales")) \
        .orderBy(F.asc("market"), F.desc("total_sales"), "segment")


@register("sort_custom_order", sql=S.with_fact("""
SELECT discount_tier, COUNT(*) AS n_lines,
       CAST(CASE discount_tier WHEN 'none' THEN 1 WHEN 'low' THEN 2 WHEN 'medium' THEN 3 ELSE 4 END AS INTEGER)
         AS tier_rank
FROM (SELECT CASE WHEN discount = 0 THEN 'none' WHEN discount <= 0.03 THEN 'low'
                  WHEN discount <= 0.06 THEN 'medium' ELSE 'high' END AS discount_tier FROM fact) t
GROUP BY discount_tier ORDER BY tier_rank"""))
def _sort_custom_order(spark, sf_dir):
    d = F.col("discount")
    tier = F.when(d == 0, "none").when(d <= F.lit(0.03), "low").when(d <= F.lit(0.06), "medium") \
            .otherwise("high")
    t = F.col("discount_tier")
    rank = F.when(t == "none", 1).when(t == "low", 2).when(t == "medium", 3).otherwise(4)
    return (order_lines(spark, sf_dir, ["discount"]).groupBy(tier.alias("discount_tier"))
            .agg(F.count(F.lit(1)).alias("n_lines")).withColumn("tier_rank", rank.cast("int"))
            .orderBy("tier_rank"))


@register("topk_global", sql=S.with_fact("""
SELECT order_id, product_id, ship_date, CAST(profit AS DOUBLE) AS profit, CAST(sales AS DOUBLE) AS sales
FROM fact ORDER BY profit DESC, order_id, product_id, ship_date, sales LIMIT 10"""))
def _topk_global(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "product_id", "ship_date", "profit", "sales"])
    # sort + limit -> TakeOrderedAndProject: each task keeps its own top 10
    return df.orderBy(F.desc("profit"), "order_id", "product_id", "ship_date", "sales").limit(10) \
        .select("order_id", "product_id", "ship_date", N.dbl("profit").alias("profit"),
                N.dbl("sales").alias("sales"))


@register("topk_subquery", sql=S.with_fact("""
SELECT * FROM (SELECT product_name, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales, 'Top High' AS group_label
               FROM fact GROUP BY product_name ORDER BY total_sales DESC, product_name LIMIT 5) a
UNION ALL
SELECT * FROM (SELECT product_name, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales, 'Top Low' AS group_label
               FROM fact GROUP BY product_name ORDER BY total_sales ASC, product_name LIMIT 5) b"""))
def _topk_subquery(spark, sf_dir):
    per = part_totals(spark, sf_dir, ["product_name"], ["sales"]).groupBy("product_name") \
        .agg(N.money(F.sum("sales")).alias("total_sales"))
    return top_and_bottom(per, "total_sales", "product_name", 5)


@register("topk_per_group", sql=S.with_fact("""
SELECT * FROM (SELECT market, country, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales,
                      DENSE_RANK() OVER (PARTITION BY market ORDER BY ROUND(SUM(sales), 2) DESC) AS rnk
               FROM fact GROUP BY market, country) t WHERE rnk <= 3"""))
def _topk_per_group(spark, sf_dir):
    per = order_lines(spark, sf_dir, ["market", "country", "sales"]).groupBy("market", "country") \
        .agg(N.money(F.sum("sales")).alias("total_sales"))
    w = Window.partitionBy("market").orderBy(F.desc("total_sales"))
    return per.withColumn("rnk", F.dense_rank().over(w)).where(F.col("rnk") <= 3) \
        .withColumn("rnk", F.col("rnk").cast("bigint"))


_LINE_KEY = ["order_id", "product_id", "ship_date"]


@register("sample_fraction", sql=S.with_fact(f"""
SELECT order_id, product_id, ship_date, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit
FROM fact WHERE {hash_unit_sql(_LINE_KEY)} < 0.1"""))
def _sample_fraction(spark, sf_dir):
    df = order_lines(spark, sf_dir, [*_LINE_KEY, "sales", "profit"])
    return hash_sample(df, _LINE_KEY, 0.1).withColumn("sales", N.dbl("sales")).withColumn("profit", N.dbl("profit"))


@register("sample_keep_outliers", sql=S.with_fact(f"""
SELECT order_id, product_id, ship_date, CAST(profit AS DOUBLE) AS profit
FROM fact WHERE abs(CAST(profit AS DOUBLE)) > 40000 OR {hash_unit_sql(_LINE_KEY)} < 0.05"""))
def _sample_keep_outliers(spark, sf_dir):
    df = order_lines(spark, sf_dir, [*_LINE_KEY, "profit"]).withColumn("profit", N.dbl("profit"))
    return sample_keep_outliers(df, "profit", 40000.0, 0.05, _LINE_KEY)


@register("split_random", sql=S.with_fact(f"""
SELECT CASE WHEN {hash_unit_sql(["order_id"])} < 0.8 THEN 0 ELSE 1 END AS split_id, COUNT(*) AS "count"
FROM (SELECT DISTINCT order_id FROM fact) o GROUP BY 1"""))
def _split_random(spark, sf_dir):
    orders = order_lines(spark, sf_dir, ["order_id", "sales"]).groupBy("order_id") \
        .agg(F.sum("sales").alias("order_sales"))
    return hash_split(orders, "order_id", (0.8, 0.2)).groupBy("split_id").count()


@register("split_time", sql=S.with_fact("""
SELECT split, COUNT(*) AS n_orders FROM (
  SELECT CASE WHEN od < DATE '1999-01-01' THEN 'train' WHEN od < DATE '2000-04-01' THEN 'valid'
              WHEN od <= DATE '2001-08-01' THEN 'test' END AS split
  FROM (SELECT order_id, MIN(order_date) AS od FROM fact GROUP BY order_id) o) s
GROUP BY split"""))
def _split_time(spark, sf_dir):
    o = order_lines(spark, sf_dir, ["order_id", "order_date"]).groupBy("order_id") \
        .agg(F.min("order_date").alias("od"))
    return time_split(o, "od", "1999-01-01", "2000-04-01", "2001-08-01").groupBy("split") \
        .agg(F.count(F.lit(1)).alias("n_orders"))


# ------------------------------------------------------------------ 2.7 sets


@register("set_union_all", sql=S.with_fact("""
SELECT 'market' AS dim, market AS value, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales FROM fact GROUP BY market
UNION ALL
SELECT 'segment' AS dim, segment AS value, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales FROM fact GROUP BY segment"""))
def _set_union_all(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["market", "segment", "sales"])
    a = df.groupBy(F.lit("market").alias("dim"), F.col("market").alias("value")) \
        .agg(N.money(F.sum("sales")).alias("total_sales"))
    b = df.groupBy(F.lit("segment").alias("dim"), F.col("segment").alias("value")) \
        .agg(N.money(F.sum("sales")).alias("total_sales"))
    return a.unionByName(b)


@register("set_union_df", sql=S.with_fact("""
SELECT order_id, CAST(profit AS DOUBLE) AS profit, 'loss' AS kind FROM fact WHERE profit < -40000
UNION ALL
SELECT order_id, CAST(profit AS DOUBLE) AS profit, 'gain' AS kind FROM fact WHERE profit > 40000"""))
def _set_union_df(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "profit"]).withColumn("profit", N.dbl("profit"))
    losses = df.where(F.col("profit") < -40000).select("order_id", "profit", F.lit("loss").alias("kind"))
    gains = df.where(F.col("profit") > 40000).select(F.lit("gain").alias("kind"), "profit", "order_id")
    return losses.unionByName(gains)  # by name: column order differs on purpose
