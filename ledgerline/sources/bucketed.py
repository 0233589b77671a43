"""Orders and order lines stored in buckets of the order key.

Both tables are hashed to the same number of buckets by the order key when
they are written, so joins of the two, and groups and windows by the order,
read bucket beside bucket: no Exchange, however many queries follow.  One
shuffle is paid at write time and each bucket is one file per write.

The tables lie under a folder of their own, with their layout (number of
buckets) beside them, and are put into the session's catalog by ``open_facts``;
any session that sees the folder can open them.  ``append_orders`` adds orders
and their lines to the same buckets.

Cases: null order keys share a bucket and join with nothing; an empty table
has no files and opens with its schema; names in the catalog are unique per
open, so several layouts live side by side.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions import numeric as N
from ledgerline.plans import sqltext as S
from ledgerline.plans.registry import register
from ledgerline.sources.fact import fact_column, read_table
from ledgerline.sources.io import scratch_path

KEY = "order_id"
LINE_COLUMNS = ["product_id", "ship_date", "ship_mode", "sales", "discount", "quantity", "shipping_cost"]
ORDER_COLUMNS = ["customer_id", "order_date", "order_priority"]
#: Bytes of lines that one bucket should hold: a task reads a bucket.
BUCKET_BYTES = 256 << 20


@dataclass
class Facts:
    lines: DataFrame
    orders: DataFrame
    buckets: int


def buckets_for(bytes_of_lines: int) -> int:
    return max(8, -(-bytes_of_lines // BUCKET_BYTES))


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias(KEY), *[fact_column(c).alias(c) for c in LINE_COLUMNS])


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(KEY), *[fact_column(c).alias(c) for c in ORDER_COLUMNS])


def _names(base: str) -> dict[str, str]:
    return {t: f"{base.rstrip('/')}/{t}" for t in ("lines", "orders")}


def _write(df: DataFrame, path: str, buckets: int, mode: str) -> None:
    """Write ``df`` to the bucketed table at ``path``; one task writes a bucket, so each write adds one file to it."""
    name = f"ledgerline_{uuid.uuid4().hex}"
    if mode == "append":
        _create(df.sparkSession, name, df, path, buckets)
        df.repartition(buckets, KEY).write.insertInto(name)
    else:
        df.repartition(buckets, KEY).write.mode(mode).format("parquet").option("path", path) \
            .bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # an external table: its files stay


def _create(spark: SparkSession, name: str, like: DataFrame, path: str, buckets: int) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")


def store_facts(lines: DataFrame, orders: DataFrame, base: str, buckets: int) -> None:
    """Write both tables and their layout under ``base``."""
    spark = lines.sparkSession
    for name, df in (("lines", lines), ("orders", orders)):
        _write(df, _names(base)[name], buckets, "overwrite")
    spark.createDataFrame([(buckets, lines.schema.json(), orders.schema.json())], "buckets int, lines string, orders string") \
        .write.mode("overwrite").parquet(f"{base.rstrip('/')}/layout")


def _layout(spark: SparkSession, base: str):
    from pyspark.sql import types as T
    import json
    row = spark.read.parquet(f"{base.rstrip('/')}/layout").first()
    return row["buckets"], {t: T.StructType.fromJson(json.loads(row[t])) for t in ("lines", "orders")}


def append_orders(lines: DataFrame, orders: DataFrame, base: str) -> None:
    """Add orders and their lines, in the columns of the stored tables."""
    spark = lines.sparkSession
    buckets, schemas = _layout(spark, base)
    for name, df in (("lines", lines), ("orders", orders)):
        _write(df.select(*schemas[name].names), _names(base)[name], buckets, "append")


def open_facts(spark: SparkSession, base: str) -> Facts:
    """The stored tables as bucketed frames."""
    buckets, schemas = _layout(spark, base)
    out = {}
    for t, path in _names(base).items():
        name = f"ledgerline_{t}_{uuid.uuid4().hex}"
        _create(spark, name, spark.createDataFrame([], schemas[t]), path, buckets)
        out[t] = spark.table(name)
    return Facts(out["lines"], out["orders"], buckets)


def order_summary(facts: Facts) -> DataFrame:
    """Every order with the sums of its lines: grouped and joined within buckets."""
    per = facts.lines.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("sales").alias("s"), F.sum("quantity").alias("quantity"),
        F.max("discount").alias("d"), F.min("ship_date").alias("first_ship"))
    return facts.orders.join(per, KEY).select(
        KEY, "customer_id", "order_date", "n_lines", N.money("s").alias("sales"), F.col("quantity").cast("bigint").alias("quantity"),
        N.money("d", 4).alias("max_discount"), F.datediff("first_ship", "order_date").alias("ship_days"))


def line_shares(facts: Facts) -> DataFrame:
    """Every line with its order's date, its rank by sales within the order and its share of the order's sales."""
    of_order = Window.partitionBy(KEY)
    ranked = facts.lines.withColumn("rank", F.row_number().over(of_order.orderBy(
        F.desc("sales"), "product_id", "ship_date", "quantity", "shipping_cost"))).withColumn("total", F.sum("sales").over(of_order))
    return ranked.join(facts.orders.select(KEY, "order_date"), KEY).select(
        KEY, "product_id", "order_date", "rank", N.money("sales").alias("sales"),
        N.rnd(N.pct("sales", "total"), 6).alias("share_pct"))


def ship_priority(facts: Facts) -> DataFrame:
    """Lines, sales and orders per order priority and ship mode: lines meet their orders in the bucket, then group."""
    both = facts.lines.join(facts.orders.select(KEY, "order_priority"), KEY)
    # orders are counted within the bucket first, so the shuffle moves groups, not order keys
    per_order = both.groupBy(KEY, "order_priority", "ship_mode").agg(F.count(F.lit(1)).alias("n"), F.sum("sales").alias("s"))
    return per_order.groupBy("order_priority", "ship_mode").agg(
        F.sum("n").alias("n_lines"), F.count(F.lit(1)).alias("n_orders"), N.money(F.sum("s")).alias("sales"))


# --------------------------------------------------------------- registered


def stored(spark: SparkSession, sf_dir: str) -> Facts:
    """The facts of the given tables, written in buckets: the first half of the orders, then the rest appended."""
    base = scratch_path(spark, "bucketed")
    lines, orders = line_rows(spark, sf_dir), order_rows(spark, sf_dir)
    buckets = buckets_for(100 * lines.count())
    early = F.col(KEY) % 2 == 0
    store_facts(lines.where(early), orders.where(early), base, buckets)
    append_orders(lines.where(~early), orders.where(~early), base)
    return open_facts(spark, base)


@register("src_bucketed_orders", sql=S.with_fact(f"""
SELECT order_id, customer_id, order_date, COUNT(*) AS n_lines, {S.money('SUM(sales)')} AS sales,
       CAST(SUM(quantity) AS BIGINT) AS quantity, CAST(ROUND(MAX(discount), 4) AS DOUBLE) AS max_discount,
       CAST(MIN(ship_date) - order_date AS INTEGER) AS ship_days
FROM fact GROUP BY order_id, customer_id, order_date"""))
def _src_bucketed_orders(spark, sf_dir):
    return order_summary(stored(spark, sf_dir))


@register("src_bucketed_window", sql=S.with_fact(f"""
SELECT order_id, product_id, order_date,
       CAST(row_number() OVER (PARTITION BY order_id ORDER BY sales DESC, product_id, ship_date, quantity, shipping_cost) AS INTEGER)
         AS rank,
       {S.money('sales')} AS sales, {S.rnd(S.pct('sales', 'SUM(sales) OVER (PARTITION BY order_id)'), 6)} AS share_pct
FROM fact"""))
def _src_bucketed_window(spark, sf_dir):
    return line_shares(stored(spark, sf_dir))


@register("src_bucketed_join", sql=S.with_fact(f"""
SELECT order_priority, ship_mode, COUNT(*) AS n_lines, COUNT(DISTINCT order_id) AS n_orders, {S.money('SUM(sales)')} AS sales
FROM fact GROUP BY order_priority, ship_mode"""))
def _src_bucketed_join(spark, sf_dir):
    return ship_priority(stored(spark, sf_dir))
