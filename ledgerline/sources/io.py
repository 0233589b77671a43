"""Readers and writers (survey 2.1).

All scratch output goes under the session's reliable checkpoint directory
(``spark.checkpoint.dir`` on a cluster: a shared folder), never a
machine-local temporary folder.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import numeric as N
from ledgerline.plans import sqltext as S
from ledgerline.plans.registry import register
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.fact import order_lines, read_table

# ----------------------------------------------------------------- library

# The two CSV profiles of the reference: a fast one (one line per record,
# splittable) and a quoted one (multi-line fields: not splittable).
CSV_PROFILES = {
    "fast": {"header": "true", "dateFormat": "yyyy-MM-dd"},
    "quoted": {"header": "true", "dateFormat": "yyyy-MM-dd", "multiLine": "true", "quote": '"',
               "escape": '"', "mode": "PERMISSIVE"},
    "headless": {"dateFormat": "yyyy-MM-dd"},
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, profile: str = "fast") -> DataFrame:
    """CSV with an explicit schema (never inferred); bad fields become null."""
    return spark.read.options(**CSV_PROFILES[profile]).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, profile: str = "fast", mode: str = "overwrite") -> None:
    opts = {k: v for k, v in CSV_PROFILES[profile].items() if k in ("header", "dateFormat", "quote", "escape")}
    df.write.mode(mode).options(**opts).csv(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerline-io/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a temp view and return the catalog's view of it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet at ``path``, or a typed empty frame if there is no such path.
    Any other failure (permissions, corrupt files) is raised: an empty
    snapshot in its place would silently change every result."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def collect_small(df: DataFrame, max_rows: int = 10_000) -> list:
    """Collect a reduced frame to the driver, refusing unbounded results."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; refusing to collect it")
    return rows


def kafka_payload(df: DataFrame, key_col: str) -> DataFrame:
    """Kafka record shape: key = id text, value = JSON of the row."""
    return df.select(F.col(key_col).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def write_kafka(payload: DataFrame, servers: str, topic: str) -> None:
    """Publish a payload frame (needs the Kafka connector on the classpath).
    Errors propagate: a failed publish fails the batch (at-least-once)."""
    payload.write.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("topic", topic).save()


# --------------------------------------------------------------- registered

_CSV_COLS = ["order_id", "order_date", "customer_name", "sales", "quantity"]
CSV_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("order_date", T.DateType()),
    T.StructField("customer_name", T.StringType()), T.StructField("sales", T.DoubleType()),
    T.StructField("quantity", T.IntegerType())])
_CSV_SQL = S.with_fact("""
SELECT order_id, order_date, customer_name, CAST(sales AS DOUBLE) AS sales, quantity FROM fact""")


@register("src_csv_fast", sql=_CSV_SQL)
def _src_csv_fast(spark, sf_dir):
    df = order_lines(spark, sf_dir, _CSV_COLS).withColumn("sales", N.dbl("sales"))
    path = scratch_path(spark, "csv-fast")
    write_csv(df, path, "fast")
    return read_csv(spark, path, CSV_SCHEMA, "fast")


QUOTED_SCHEMA = T.StructType([T.StructField("order_id", T.LongType()),
                              T.StructField("product_id", T.LongType()),
                              T.StructField("label", T.StringType())])


@register("src_csv_quoted", sql=S.with_fact("""
SELECT order_id, product_id, customer_name || ', "' || product_name || '"' || chr(10) || market AS label
FROM fact"""))
def _src_csv_quoted(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "product_id", "customer_name", "product_name", "market"])
    # a text field with a comma, quotes and a line break, as a raw export has
    label = F.concat(F.col("customer_name"), F.lit(', "'), F.col("product_name"), F.lit('"'),
                     F.lit("\n"), F.col("market"))
    path = scratch_path(spark, "csv-quoted")
    write_csv(df.select("order_id", "product_id", label.alias("label")), path, "quoted")
    return read_csv(spark, path, QUOTED_SCHEMA, "quoted")


@register("src_view", sql=S.with_fact("""
SELECT market, COUNT(*) AS n_lines, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales FROM fact GROUP BY market"""))
def _src_view(spark, sf_dir):
    name = f"superstore_{uuid.uuid4().hex[:8]}"
    register_view(order_lines(spark, sf_dir, ["market", "sales"]), name)
    return spark.sql(f"SELECT market, COUNT(*) AS n_lines, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales "
                     f"FROM {name} GROUP BY market")


@register("src_parquet", sql="""
SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01'""")
def _src_parquet(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    # the filter and the 3-column projection reach the scan (PushedFilters, ReadSchema)
    return li.where(F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz")) \
        .select("l_orderkey", "l_partkey", "l_extendedprice")


_MARKET_SQL = S.with_fact("""
SELECT market, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales, COUNT(*) AS n_lines FROM fact GROUP BY market""")


def _market_totals(spark, sf_dir):
    return order_lines(spark, sf_dir, ["market", "sales"]).groupBy("market") \
        .agg(N.money(F.sum("sales")).alias("total_sales"), F.count(F.lit(1)).alias("n_lines"))


@register("snk_parquet_overwrite", sql=_MARKET_SQL)
def _snk_parquet_overwrite(spark, sf_dir):
    path = scratch_path(spark, "overwrite")
    df = _market_totals(spark, sf_dir)
    write_parquet(df, path, "overwrite")
    write_parquet(df, path, "overwrite")  # replaced, not doubled
    return spark.read.parquet(path)


@register("snk_parquet_append", sql=S.with_fact("""
SELECT order_id, product_id, order_date, CAST(sales AS DOUBLE) AS sales FROM fact"""))
def _snk_parquet_append(spark, sf_dir):
    path = scratch_path(spark, "append")
    df = order_lines(spark, sf_dir, ["order_id", "product_id", "order_date", "sales"]) \
        .withColumn("sales", N.dbl("sales"))
    cut = F.lit("1998-06-01").cast("date")
    # two batches covering the whole table, appended one after the other
    write_parquet(df.where(F.col("order_date") < cut), path, "append")
    write_parquet(df.where(~(F.col("order_date") < cut)), path, "append")
    return spark.read.parquet(path)


@register("snk_kafka", sql=S.with_fact("""
SELECT CAST(order_id AS VARCHAR) AS key,
       CAST(to_json({'order_id': order_id, 'customer_id': customer_id, 'category': category,
                     'sub_category': sub_category, 'quantity': quantity}) AS VARCHAR) AS value
FROM fact"""))
def _snk_kafka(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "customer_id", "category", "sub_category", "quantity"])
    return kafka_payload(df, "order_id")


@register("src_range", sql=S.with_fact(f"""
SELECT m.month_start, {S.money('COALESCE(SUM(f.sales), 0)')} AS month_sales
FROM (SELECT CAST(d AS DATE) AS month_start
      FROM (SELECT MIN(date_trunc('month', order_date)) AS lo, MAX(date_trunc('month', order_date)) AS hi FROM fact) b,
           generate_series(b.lo, b.hi, INTERVAL 1 MONTH) g(d)) m
LEFT JOIN fact f ON date_trunc('month', f.order_date) = m.month_start
GROUP BY m.month_start"""))
def _src_range(spark, sf_dir):
    lines = order_lines(spark, sf_dir, ["order_date", "sales"])
    monthly = lines.groupBy(F.trunc("order_date", "month").alias("month_start")) \
        .agg(F.sum("sales").alias("ms"))
    bounds = monthly.agg(F.min("month_start").alias("lo"), F.max("month_start").alias("hi"))
    # one row with the bounds becomes the whole calendar between them
    cal = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    return cal.join(monthly, "month_start", "left") \
        .select("month_start", N.money(F.coalesce(F.col("ms"), F.lit(0))).alias("month_sales"))


SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("cust_hist_sales", T.DoubleType()),
    T.StructField("cust_hist_profit", T.DoubleType()), T.StructField("cust_hist_margin", T.DoubleType())])


@register("src_empty_fallback", sql="""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(0 AS DOUBLE) AS cust_hist_sales,
       CAST(0 AS DOUBLE) AS cust_hist_profit, CAST(0 AS DOUBLE) AS cust_hist_margin FROM orders""")
def _src_empty_fallback(spark, sf_dir):
    missing = scratch_path(spark, "no-snapshot")  # never written
    snap = read_or_empty(spark, missing, SNAPSHOT_SCHEMA)
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"),
                                                         F.col("o_custkey").alias("customer_id"))
    return orders.join(snap, "customer_id", "left") \
        .na.fill({"cust_hist_sales": 0.0, "cust_hist_profit": 0.0, "cust_hist_margin": 0.0})


@register("snk_collect", sql=_MARKET_SQL)
def _snk_collect(spark, sf_dir):
    agg = _market_totals(spark, sf_dir)
    rows = collect_small(agg, 1000)  # reduced frame only, size-checked
    return spark.createDataFrame(rows, agg.schema)


@register("snk_report_csv", sql=_MARKET_SQL)
def _snk_report_csv(spark, sf_dir):
    agg = _market_totals(spark, sf_dir)
    path = scratch_path(spark, "report")
    write_csv(agg.repartition(1), path, "fast")  # one file of the finished report; the aggregation stays parallel
    schema = T.StructType([T.StructField("market", T.StringType()), T.StructField("total_sales", T.DoubleType()),
                           T.StructField("n_lines", T.LongType())])
    return read_csv(spark, path, schema, "fast")
