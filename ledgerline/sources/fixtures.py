"""Deterministic dirty and raw-text views derived from the fact view.

The test tables are clean, so cleaning and data-quality operators would
only ever see zeros.  These views inject blanks, nulls, zero sales, bad
text and duplicated rows with fixed rules on key values (no randomness), in
Spark and, identically, in DuckDB text for the oracle.  Every row of the
fact view is kept; duplicates are added, never removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.fact import FACT_COLUMNS, order_lines


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = order_lines(spark, sf_dir)
    q = F.col("quantity")
    dirty = base.select(
        *[{
            "customer_name": F.when(F.col("customer_id") % 97 == 0, F.lit("  "))
                              .otherwise(F.col("customer_name")),
            "order_priority": F.when(F.col("order_id") % 89 == 0, F.lit(None).cast("string"))
                               .otherwise(F.col("order_priority")),
            "discount": F.when(q == 13, F.lit(None).cast("decimal(4,2)")).otherwise(F.col("discount")),
            "sales": F.when(q == 7, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("sales")),
            "ship_date": F.when(q == 29, F.lit(None).cast("date")).otherwise(F.col("ship_date")),
            "category": F.when(F.col("product_id") % 61 == 0, F.lit("")).otherwise(F.col("category")),
        }.get(c, F.col(c)).alias(c) for c in FACT_COLUMNS])
    # rows of every 50th product appear twice: one scan, exploded into copies
    copies = F.when(F.col("product_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return dirty.withColumn("_copy", F.explode(copies)).drop("_copy")


DIRTY_CTE_SQL = """dirty_base AS (
  SELECT customer_id,
         CASE WHEN customer_id % 97 = 0 THEN '  ' ELSE customer_name END AS customer_name,
         segment, country, market, order_id, order_date,
         CASE WHEN order_id % 89 = 0 THEN NULL ELSE order_priority END AS order_priority,
         CASE WHEN quantity = 29 THEN NULL ELSE ship_date END AS ship_date,
         ship_mode, product_id, product_name,
         CASE WHEN product_id % 61 = 0 THEN '' ELSE category END AS category,
         sub_category,
         CASE WHEN quantity = 7 THEN CAST(0 AS DECIMAL(18,2)) ELSE sales END AS sales,
         CASE WHEN quantity = 13 THEN NULL ELSE discount END AS discount,
         quantity, profit, shipping_cost, year, weeknum
  FROM fact),
dirty AS (SELECT * FROM dirty_base UNION ALL SELECT * FROM dirty_base WHERE product_id % 50 = 0)"""


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text-typed lines with dotted names, as a raw export would look."""
    base = order_lines(spark, sf_dir, ["order_id", "customer_name", "market", "order_date",
                                       "ship_date", "sales", "quantity", "shipping_cost"])
    q = F.col("quantity")
    return base.select(
        F.col("order_id").cast("string").alias("Row_ID"),
        F.col("order_id").cast("string").alias("Order.ID"),
        F.col("customer_name").alias("Customer.Name"),
        F.when(q == 23, F.lit("not-a-date")).otherwise(F.date_format("order_date", "yyyy-MM-dd"))
         .alias("Order.Date"),
        F.date_format("ship_date", "yyyy-MM-dd").alias("Ship.Date"),
        F.when(q == 17, F.lit("n/a")).otherwise(F.col("sales").cast("string")).alias("Sales"),
        F.when(q == 41, F.lit("x")).otherwise(q.cast("string")).alias("Quantity"),
        F.col("shipping_cost").cast("string").alias("Shipping.Cost"),
        F.col("market").alias("Market"),
        F.col("market").alias("Market2"),
        F.lit(1).alias("Records"),
    )


RAW_CTE_SQL = """raw AS (
  SELECT CAST(order_id AS VARCHAR) AS "Row_ID", CAST(order_id AS VARCHAR) AS "Order.ID",
         customer_name AS "Customer.Name",
         CASE WHEN quantity = 23 THEN 'not-a-date' ELSE strftime(order_date, '%Y-%m-%d') END AS "Order.Date",
         strftime(ship_date, '%Y-%m-%d') AS "Ship.Date",
         CASE WHEN quantity = 17 THEN 'n/a' ELSE CAST(sales AS VARCHAR) END AS "Sales",
         CASE WHEN quantity = 41 THEN 'x' ELSE CAST(quantity AS VARCHAR) END AS "Quantity",
         CAST(shipping_cost AS VARCHAR) AS "Shipping.Cost",
         market AS "Market", market AS "Market2", 1 AS "Records"
  FROM fact)"""
