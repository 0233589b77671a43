"""The order-line fact view over the star-schema test tables.

The reference works on one denormalised order-line table.  Here the same
24-column shape is derived from ``lineitem`` and its dimensions.  Money is
kept as DECIMAL so that sums do not depend on partition order; operators
cast to DOUBLE only in their final projection.

Join pruning: every dimension join is an inner foreign-key join that loses
no line (checked at every test scale), so ``order_lines`` joins only the
tables that the requested columns need.  Catalyst never removes an inner
join by itself, and at scale each avoided join is a full shuffle of the
line table.  Join order: customer (with its geography) is joined to
``orders`` before the lines join that order side, so the customer join
shuffles order-sized rather than line-sized data.  ``nation`` and ``region`` are fixed-size reference tables
(25 and 5 rows by the TPC-H definition) and are broadcast explicitly; every
other side is left to AQE, which broadcasts only after measuring it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import week_sunday
from ledgerline.session import table_path

# column -> tables it needs besides lineitem
_NEEDS = {
    "customer_id": {"orders"},
    "customer_name": {"orders", "customer"},
    "segment": {"orders", "customer"},
    "country": {"orders", "customer", "nation"},
    "market": {"orders", "customer", "nation", "region"},
    "order_id": set(),
    "order_date": {"orders"},
    "order_priority": {"orders"},
    "ship_date": set(),
    "ship_mode": set(),
    "product_id": set(),
    "product_name": {"part"},
    "category": {"part"},
    "sub_category": {"part"},
    "sales": set(),
    "discount": set(),
    "quantity": set(),
    "profit": {"part"},
    "shipping_cost": set(),
    "year": {"orders"},
    "weeknum": {"orders"},
}

FACT_COLUMNS = list(_NEEDS)


def _sales() -> Column:
    return F.col("l_extendedprice").cast("decimal(18,2)")


def _discount() -> Column:
    return F.col("l_discount").cast("decimal(4,2)")


def _quantity() -> Column:
    return F.col("l_quantity").cast("int")


def _order_date() -> Column:
    return F.col("o_orderdate").cast("date")


def fact_column(name: str) -> Column:
    """A column of the fact view as an expression over the star-schema tables."""
    if name == "customer_id":
        return F.col("o_custkey")
    if name == "customer_name":
        return F.col("c_name")
    if name == "segment":
        return F.col("c_mktsegment")
    if name == "country":
        return F.col("n_name")
    if name == "market":
        return F.col("r_name")
    if name == "order_id":
        return F.col("l_orderkey")
    if name == "order_date":
        return _order_date()
    if name == "order_priority":
        return F.col("o_orderpriority")
    if name == "ship_date":
        return F.col("l_shipdate").cast("date")
    if name == "ship_mode":
        return F.concat(F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus"))
    if name == "product_id":
        return F.col("l_partkey")
    if name == "product_name":
        return F.col("p_name")
    if name == "category":
        return F.col("p_type")
    if name == "sub_category":
        return F.col("p_brand")
    if name == "sales":
        return _sales()
    if name == "discount":
        return _discount()
    if name == "quantity":
        return _quantity()
    if name == "profit":
        return (_sales() * (F.lit(1) - _discount())
                - _quantity() * F.col("p_retailprice").cast("decimal(10,2)")
                ).cast("decimal(18,4)")
    if name == "shipping_cost":
        return (_sales() * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,4)")
    if name == "year":
        return F.year(_order_date())
    if name == "weeknum":
        return week_sunday(_order_date())
    raise KeyError(name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def order_lines(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    """Order-line fact frame with only ``columns`` (default: all)."""
    cols = list(columns) if columns else FACT_COLUMNS
    need: set[str] = set()
    for c in cols:
        need |= _NEEDS[c]

    df = read_table(spark, sf_dir, "lineitem")
    if "orders" in need:
        # order side first: customer attributes join the orders table (a
        # quarter of the lines), then the lines join the order side once
        side = read_table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        if "customer" in need:
            cust = read_table(spark, sf_dir, "customer").select(
                "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
            if "nation" in need:
                geo = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
                if "region" in need:
                    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
                    geo = geo.join(F.broadcast(region), geo["n_regionkey"] == region["r_regionkey"])
                cust = cust.join(F.broadcast(geo), cust["c_nationkey"] == geo["n_nationkey"])
            side = side.join(cust, side["o_custkey"] == cust["c_custkey"])
        df = df.join(side, df["l_orderkey"] == side["o_orderkey"])
    if "part" in need:
        part = read_table(spark, sf_dir, "part").select(
            "p_partkey", "p_name", "p_type", "p_brand", "p_retailprice")
        df = df.join(part, df["l_partkey"] == part["p_partkey"])
    return df.select(*[fact_column(c).alias(c) for c in cols])


_ORDER_SIDE = {"customer_id", "customer_name", "segment", "country", "market", "order_date",
               "order_priority", "year", "weeknum"}
_ADDITIVE = {"sales", "profit", "shipping_cost", "quantity"}


_LINE_ONLY = {"ship_mode", "ship_date", "product_id"}


def order_totals(spark: SparkSession, sf_dir: str, order_cols, measures=("sales",), line_mins=()) -> DataFrame:
    """One row per order: order-side columns plus line measures summed per
    order (``n_lines`` = line count), aggregated BEFORE the order-side join.

    The per-order aggregation combines map-side, and its output is already
    partitioned by order key, so the join shuffles only the order side; the
    lines are never shuffled against orders or customers.  Sums are exact
    (DECIMAL), so re-aggregating these totals equals aggregating the lines.
    Orders without lines are absent, exactly as in the inner-joined fact view.
    ``line_mins`` adds the per-order minimum of line-level columns.
    """
    order_cols = list(order_cols)
    bad = [c for c in order_cols if c not in _ORDER_SIDE] + [m for m in measures if m not in _ADDITIVE] \
        + [c for c in line_mins if c not in _LINE_ONLY]
    if bad:
        raise ValueError(f"not order-side columns / additive measures / line columns: {bad}")
    li = read_table(spark, sf_dir, "lineitem")
    if "profit" in measures:
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
        li = li.join(part, li["l_partkey"] == part["p_partkey"])
    # text columns are grouped first (text is fine as a hash key), so a
    # minimum of text, which needs a sort, is taken over few rows per order
    per_order = li.groupBy(F.col("l_orderkey").alias("order_id"), *[fact_column(c).alias(c) for c in line_mins]).agg(
        *[F.sum(fact_column(m)).alias(m) for m in measures], F.count(F.lit(1)).alias("n_lines"))
    if line_mins:
        per_order = per_order.groupBy("order_id").agg(
            *[F.sum(m).alias(m) for m in (*measures, "n_lines")], *[F.min(c).alias(c) for c in line_mins])
    if not order_cols:
        return per_order
    side = order_lines_side(spark, sf_dir, order_cols)
    return per_order.join(side, "order_id")


_PART_SIDE = {"product_name", "category", "sub_category"}


def part_totals(spark: SparkSession, sf_dir: str, part_cols, measures=("sales",)) -> DataFrame:
    """One row per product: product columns plus line measures summed per
    product BEFORE the join with ``part`` (``n_lines`` = line count).

    Profit is decomposable: the sum over a product's lines of
    sales * (1 - discount) - quantity * price equals
    sum(sales * (1 - discount)) - price * sum(quantity), exactly in DECIMAL,
    so the lines never shuffle against the part table -- they are combined
    per part key map-side and only part-sized rows are joined.
    """
    part_cols = list(part_cols)
    bad = [c for c in part_cols if c not in _PART_SIDE] + [m for m in measures if m not in _ADDITIVE]
    if bad:
        raise ValueError(f"not product columns / additive measures: {bad}")
    li = read_table(spark, sf_dir, "lineitem")
    aggs = [F.count(F.lit(1)).alias("n_lines")]
    for m in measures:
        if m == "profit":
            aggs += [F.sum(_sales() * (F.lit(1) - _discount())).alias("_net"), F.sum(_quantity()).alias("_qty")]
        else:
            aggs.append(F.sum(fact_column(m)).alias(m))
    per_part = li.groupBy(F.col("l_partkey").alias("product_id")).agg(*aggs)
    part = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), "p_retailprice", *[fact_column(c).alias(c) for c in part_cols])
    out = per_part.join(part, "product_id")
    if "profit" in measures:
        out = out.withColumn("profit", (F.col("_net") - F.col("_qty") * F.col("p_retailprice")
                                        .cast("decimal(10,2)")).cast("decimal(28,4)"))
    return out.drop("_net", "_qty", "p_retailprice")


def order_lines_side(spark: SparkSession, sf_dir: str, order_cols) -> DataFrame:
    """The order side of the fact view (orders + customer + geography)."""
    need: set[str] = set()
    for c in order_cols:
        need |= _NEEDS[c]
    side = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    if "customer" in need:
        cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
        if "nation" in need:
            geo = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
            if "region" in need:
                region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
                geo = geo.join(F.broadcast(region), geo["n_regionkey"] == region["r_regionkey"])
            cust = cust.join(F.broadcast(geo), cust["c_nationkey"] == geo["n_nationkey"])
        side = side.join(cust, side["o_custkey"] == cust["c_custkey"])
    return side.select(F.col("o_orderkey").alias("order_id"), *[fact_column(c).alias(c) for c in order_cols])


# DuckDB text of the same view, used by the oracle SQL of every registered
# query (tables are the driver's pre-registered views).
FACT_CTE_SQL = """fact AS (
  SELECT
    o.o_custkey AS customer_id,
    c.c_name AS customer_name,
    c.c_mktsegment AS segment,
    n.n_name AS country,
    r.r_name AS market,
    l.l_orderkey AS order_id,
    CAST(o.o_orderdate AS DATE) AS order_date,
    o.o_orderpriority AS order_priority,
    CAST(l.l_shipdate AS DATE) AS ship_date,
    l.l_returnflag || '-' || l.l_linestatus AS ship_mode,
    l.l_partkey AS product_id,
    p.p_name AS product_name,
    p.p_type AS category,
    p.p_brand AS sub_category,
    CAST(l.l_extendedprice AS DECIMAL(18,2)) AS sales,
    CAST(l.l_discount AS DECIMAL(4,2)) AS discount,
    CAST(l.l_quantity AS INTEGER) AS quantity,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
         - CAST(l.l_quantity AS INTEGER) * CAST(p.p_retailprice AS DECIMAL(10,2))
         AS DECIMAL(18,4)) AS profit,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(4,2))
         AS DECIMAL(18,4)) AS shipping_cost,
    CAST(year(CAST(o.o_orderdate AS DATE)) AS INTEGER) AS year,
    CAST(floor((dayofyear(CAST(o.o_orderdate AS DATE))
                + dayofweek(date_trunc('year', CAST(o.o_orderdate AS DATE))) + 1 - 2) / 7) + 1
         AS INTEGER) AS weeknum
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""
