"""Order scoring on Structured Streaming (survey 2.12).

Stream: order requests (JSON in a ``value`` column: Kafka in production,
files in tests) -> typed rows -> left join with the customer snapshot
(unknown customers get 0.0) -> serving features -> model -> risk tier ->
``foreachBatch`` dual sink.

Nothing is dropped: messages that cannot be read, lack an id or lack a
number the model needs go to ``rejects`` with the reason, so audit rows plus
rejects are the input.

The sinks are restart-safe: each micro-batch is persisted once, its audit
rows and rejects are written to ``batch_id=N`` with overwrite (a replayed
batch replaces its own output instead of appending a copy), and a publish
error fails the batch so the checkpoint does not advance past it.

Every function here also works on a batch frame; the registered queries
use that "batch replay" form, which is what the streaming job computes per
micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import numeric as N
from ledgerline.functions.realtime import MESSAGE_NAMES, ServingParams, message_features, risk_tier
from ledgerline.plans import sqltext as S
from ledgerline.plans.lineage import dealt
from ledgerline.plans.registry import register
from ledgerline.sources.fact import order_lines
from ledgerline.sources.io import SNAPSHOT_SCHEMA, kafka_payload, path_exists, read_or_empty, scratch_path, write_kafka

# The wire format of order messages, the audit columns and the
# names in the published record.
ORDER_SCHEMA = T.StructType([
    T.StructField("Order_ID", T.StringType()), T.StructField("Customer_ID", T.StringType()),
    T.StructField("Order_Date", T.StringType()), T.StructField("Category", T.StringType()),
    T.StructField("Sub_Category", T.StringType()), T.StructField("Sales", T.DoubleType()),
    T.StructField("Discount", T.DoubleType()), T.StructField("Quantity", T.IntegerType()),
    T.StructField("Shipping_Cost", T.DoubleType()), T.StructField("Market", T.StringType()),
    T.StructField("Publish_Time", T.DoubleType())])

SNAPSHOT_COLS = ["cust_hist_sales", "cust_hist_profit", "cust_hist_margin"]

AUDIT_COLS = ["Order_ID", "Customer_ID", "Order_Date", "Category", "Sub_Category", "Sales", "Discount", "Quantity",
              "Shipping_Cost", "Market", "cust_hist_sales", "cust_hist_profit", "cust_hist_margin",
              "prediction_usd", "risk_level", "prediction_time"]


PUBLISHED = {"Order_ID": "order_id", "Customer_ID": "customer_id", "Category": "category",
             "Sub_Category": "sub_category", "Sales": "sales", "Discount": "discount",
             "prediction_usd": "prediction_usd", "risk_level": "risk_level", "prediction_time": "prediction_time",
             "Publish_Time": "publish_time"}
REQUIRED_NUMBERS = ("Sales", "Discount", "Quantity", "Shipping_Cost")

# ----------------------------------------------------------------- source

def order_source(spark: SparkSession, fmt: str, options: dict, path: str | None = None,
                 streaming: bool = True) -> DataFrame:
    """Raw order messages with a string ``value`` column.

    ``fmt='kafka'`` subscribes to a topic (connector jar required); file
    formats (``json`` lines with a ``value`` field, ``text``, ``parquet``)
    stand in for it in tests.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        raw = reader.format("kafka").options(**options).load()
        return raw.selectExpr("CAST(value AS STRING) AS value")
    if fmt == "text":
        return reader.options(**options).text(path)
    schema = T.StructType([T.StructField("value", T.StringType())])
    return reader.format(fmt).schema(schema).options(**options).load(path)


def route(raw: DataFrame, value_col: str = "value", required=REQUIRED_NUMBERS) -> DataFrame:
    """Every message with its typed columns, its text and ``reject_reason`` (null if it can be scored)."""
    # inline(array(struct)) expands the parsed struct through a Generate
    # node: no filter on its columns can be pushed below it, so each message
    # is parsed once (a plain ``select("data.*")`` lets the optimizer copy the
    # parse into a pushed-down filter, parsing every message 3 times)
    parsed = raw.select(F.col(value_col).alias("message"), F.inline(F.array(F.from_json(F.col(value_col), ORDER_SCHEMA))))
    columns = [F.col(f.name) for f in ORDER_SCHEMA.fields]
    unreadable = F.forall(F.array(*[c.isNull() for c in columns]), lambda x: x)
    reason = F.when(unreadable, F.lit("unreadable")) \
        .when(F.col("Order_ID").isNull() | F.col("Customer_ID").isNull(), F.lit("no order or customer id"))
    for c in required:
        reason = reason.when(F.col(c).isNull(), F.lit(f"no {c}"))
    return parsed.withColumn("reject_reason", reason)


def parse_orders(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """The typed orders that have an order and a customer id."""
    return route(raw, value_col, required=()).where("reject_reason IS NULL").drop("message", "reject_reason")


def enrich(orders: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Left join with the customer snapshot, unknown customers -> 0.0.

    The snapshot has one row per customer, so it grows with the customer
    base: no broadcast is forced; AQE broadcasts it per micro-batch only
    when its measured size is under the threshold, else it shuffles."""
    snap = snapshot.select(F.col("customer_id").cast("string").alias("Customer_ID"), *SNAPSHOT_COLS)
    return orders.join(snap, "Customer_ID", "left").na.fill({c: 0.0 for c in SNAPSHOT_COLS})


def score(features: DataFrame, model, tiers=(100.0, 500.0), explicit_null_tier: bool = False) -> DataFrame:
    """Model (which ends in prediction_usd) -> risk tier -> prediction time."""
    return model.transform(features) \
        .withColumn("risk_level", risk_tier("prediction_usd", *tiers, explicit_null=explicit_null_tier)) \
        .withColumn("prediction_time", F.current_timestamp().cast("string"))


def reject_invalid(df: DataFrame, required=REQUIRED_NUMBERS):
    """(valid, rejects) of parsed orders: the rejects lack a number that the model needs."""
    ok = F.forall(F.array(*[F.col(c).isNotNull() for c in required]), lambda x: x)
    return df.where(ok), df.where(~ok)


def publish_payload(batch: DataFrame) -> DataFrame:
    """The JSON record the dashboard consumes (lower-case names)."""
    return kafka_payload(batch.select(*[F.col(c).alias(name) for c, name in PUBLISHED.items()]), "order_id")


def scoring_sink(snapshot: DataFrame, model, audit_path: str, reject_path: str,
                 publish: Callable[[DataFrame, int], None], params: ServingParams, tiers):
    """foreachBatch function over routed messages: audit, published JSON and rejects, each idempotent per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            rejects = batch.where("reject_reason IS NOT NULL").select("message", "reject_reason")
            rejects.write.mode("overwrite").parquet(f"{reject_path}/batch_id={batch_id}")
            orders = batch.where("reject_reason IS NULL").drop("message", "reject_reason")
            scored = score_orders(orders, snapshot, model, params, tiers).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                scored.select(*AUDIT_COLS).write.mode("overwrite").parquet(f"{audit_path}/batch_id={batch_id}")
                publish(publish_payload(scored), batch_id)  # errors propagate: the batch is retried
            finally:
                scored.unpersist()
        finally:
            batch.unpersist()
    return write


def file_publisher(path: str) -> Callable[[DataFrame, int], None]:
    """Test stand-in for the Kafka writer: one JSON folder per batch (overwrite)."""
    def publish(payload: DataFrame, batch_id: int) -> None:
        payload.write.mode("overwrite").json(f"{path}/batch_id={batch_id}")
    return publish


def kafka_publisher(servers: str, topic: str) -> Callable[[DataFrame, int], None]:
    return lambda payload, batch_id: write_kafka(payload, servers, topic)


def score_orders(orders: DataFrame, snapshot: DataFrame, model, params: ServingParams, tiers) -> DataFrame:
    """Enriched, scored orders under the names of the messages."""
    columns = [f.name for f in ORDER_SCHEMA.fields]
    features = message_features(enrich(orders, snapshot), params)
    scored = score(features, model, tiers)
    return scored.select(*[F.col(MESSAGE_NAMES.get(c, c)).alias(c) for c in columns], *SNAPSHOT_COLS, "prediction_usd", "risk_level",
                         "prediction_time")


def start_scoring(spark: SparkSession, raw: DataFrame, snapshot: DataFrame, model, base_path: str,
                  publish: Callable[[DataFrame, int], None], params: ServingParams = ServingParams(),
                  tiers=(100.0, 500.0), available_now: bool = False):
    """Wire the whole scoring stream under ``base_path`` (audit, rejects, checkpoint) and start it."""
    sink = scoring_sink(snapshot, model, f"{base_path}/audit", f"{base_path}/rejects", publish, params, tiers)
    writer = route(raw).writeStream.foreachBatch(sink).option("checkpointLocation", f"{base_path}/checkpoint")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


# ------------------------------------------------------ batch-replay forms


def order_messages(spark, sf_dir) -> DataFrame:
    """One JSON message per fact line, as a producer would publish it.  A
    fixed rule blanks the customer id of some messages (quantity 13) and
    replaces others with junk text (quantity 41), so the parser's guard
    has work to do; publish time is the order date in epoch seconds."""
    df = order_lines(spark, sf_dir, ["order_id", "customer_id", "order_date", "category", "sub_category",
                                     "sales", "discount", "quantity", "shipping_cost", "market"])
    msg = df.select(F.col("order_id").cast("string").alias("Order_ID"),
                    F.when(F.col("quantity") == 13, F.lit(None).cast("string"))
                     .otherwise(F.col("customer_id").cast("string")).alias("Customer_ID"),
                    F.date_format("order_date", "yyyy-MM-dd").alias("Order_Date"),
                    F.col("category").alias("Category"), F.col("sub_category").alias("Sub_Category"),
                    N.dbl("sales").alias("Sales"), N.dbl("discount").alias("Discount"),
                    F.col("quantity").alias("Quantity"), N.dbl("shipping_cost").alias("Shipping_Cost"),
                    F.col("market").alias("Market"),
                    (F.datediff("order_date", F.lit("1970-01-01").cast("date")) * F.lit(86400.0)).alias("Publish_Time"))
    return msg.select(F.when(F.col("Quantity") == 41, F.lit("not json at all"))
                      .otherwise(F.to_json(F.struct("*"))).alias("value"))


_PARSED_SQL = """msgs AS (
  SELECT CAST(order_id AS VARCHAR) AS "Order_ID",
         CASE WHEN quantity = 13 THEN NULL ELSE CAST(customer_id AS VARCHAR) END AS "Customer_ID",
         strftime(order_date, '%Y-%m-%d') AS "Order_Date", category AS "Category", sub_category AS "Sub_Category",
         CAST(sales AS DOUBLE) AS "Sales", CAST(discount AS DOUBLE) AS "Discount", quantity AS "Quantity",
         CAST(shipping_cost AS DOUBLE) AS "Shipping_Cost", market AS "Market",
         CAST(order_date - DATE '1970-01-01' AS DOUBLE) * 86400.0 AS "Publish_Time"
  FROM fact WHERE quantity <> 41),
parsed AS (SELECT * FROM msgs WHERE "Order_ID" IS NOT NULL AND "Customer_ID" IS NOT NULL)"""


@register("st_parse_orders", sql=S.with_fact("SELECT * FROM parsed", _PARSED_SQL))
def _st_parse_orders(spark, sf_dir):
    return parse_orders(order_messages(spark, sf_dir))


def _snapshot(spark, sf_dir) -> DataFrame:
    from ledgerline.operators.features import TEST_CLAMP, order_sums
    from ledgerline.operators.snapshot import snapshot_of, state_of
    return snapshot_of(state_of(order_sums(spark, sf_dir, *TEST_CLAMP["sales"])))


def stored_snapshot(spark, sf_dir, path: str) -> DataFrame:
    """The customer snapshot as an artefact: written once, then only loaded (each micro-batch reads the copy)."""
    if not path_exists(spark, path):
        _snapshot(spark, sf_dir).write.parquet(path)
    return read_or_empty(spark, path, SNAPSHOT_SCHEMA)


def _enrich_sql() -> str:
    from ledgerline.operators.features import _CUST_HIST_CTE
    snap = """snap AS (SELECT CAST(customer_id AS VARCHAR) AS cid,
        arg_max(cust_hist_sales, (order_date, order_id)) AS hs, arg_max(cust_hist_profit, (order_date, order_id)) AS hp
      FROM chm GROUP BY customer_id)"""
    body = f"""SELECT p."Order_ID", p."Customer_ID", p."Sales",
       {S.rnd('COALESCE(s.hs, 0.0)', 4)} AS cust_hist_sales, {S.rnd('COALESCE(s.hp, 0.0)', 4)} AS cust_hist_profit,
       {S.rnd('COALESCE(CASE WHEN s.hs = 0 THEN 0.0 ELSE s.hp / s.hs END, 0.0)', 6)} AS cust_hist_margin
FROM parsed p LEFT JOIN snap s ON p."Customer_ID" = s.cid"""
    return S.with_fact(body, _PARSED_SQL, _CUST_HIST_CTE, snap)


def _enriched(spark, sf_dir) -> DataFrame:
    e = enrich(parse_orders(order_messages(spark, sf_dir)), _snapshot(spark, sf_dir))
    return e.select("Order_ID", "Customer_ID", "Sales", N.rnd("cust_hist_sales", 4).alias("cust_hist_sales"),
                    N.rnd("cust_hist_profit", 4).alias("cust_hist_profit"),
                    N.rnd("cust_hist_margin", 6).alias("cust_hist_margin"))


@register("st_enrich", sql=_enrich_sql())
def _st_enrich(spark, sf_dir):
    return _enriched(spark, sf_dir)


@register("join_stream_static", sql=_enrich_sql())
def _join_stream_static(spark, sf_dir):
    return _enriched(spark, sf_dir)


TEST_TIERS = (10000.0, 50000.0)

# audit-table stand-in: every parsed message scored with the fixed rule
# prediction = 0.3 * sales - 10000 (no model needed to check the reports)
_AUDIT_SQL = _PARSED_SQL + """,
audit AS (SELECT *, CAST(CAST("Sales" AS DECIMAL(18,2)) * 0.3 - 10000 AS DOUBLE) AS prediction_usd FROM parsed),
audit_t AS (SELECT *, CASE WHEN prediction_usd < 0.0 THEN 'LOSS RISK'
                          WHEN prediction_usd >= 0.0 AND prediction_usd <= 10000 THEN 'LOW PROFIT'
                          WHEN prediction_usd > 10000 AND prediction_usd <= 50000 THEN 'MEDIUM PROFIT'
                          ELSE 'HIGH PROFIT OPPORTUNITY' END AS risk_level FROM audit)"""


def rule_audit(spark, sf_dir) -> DataFrame:
    p = parse_orders(order_messages(spark, sf_dir))
    pred = N.dbl(F.col("Sales").cast("decimal(18,2)") * F.lit(0.3).cast("decimal(2,1)") - F.lit(10000))
    return p.withColumn("prediction_usd", pred).withColumn("risk_level", risk_tier("prediction_usd", *TEST_TIERS))


@register("st_risk_tier", sql=S.with_fact(
    'SELECT "Order_ID", "Customer_ID", "Sales", prediction_usd, risk_level FROM audit_t', _AUDIT_SQL))
def _st_risk_tier(spark, sf_dir):
    return rule_audit(spark, sf_dir).select("Order_ID", "Customer_ID", "Sales", "prediction_usd", "risk_level")


def kpis(audit: DataFrame, high: float = 500.0) -> DataFrame:
    """Dashboard KPIs over recent results, one aggregation."""
    p = F.col("prediction_usd")
    return audit.agg(F.count(F.lit(1)).alias("orders"), N.rnd(F.avg(p), 2).alias("avg_predicted_profit"),
                     F.count_if(p < 0).alias("loss_orders"),
                     N.rnd(F.count_if(p < 0) * 100.0 / F.count(F.lit(1)), 2).alias("loss_pct"),
                     F.count_if(p > F.lit(high)).alias("high_profit_orders"))


@register("st_kpi", sql=S.with_fact(f"""
SELECT COUNT(*) AS orders, {S.rnd('avg(prediction_usd)', 2)} AS avg_predicted_profit,
       COUNT(*) FILTER (WHERE prediction_usd < 0) AS loss_orders,
       {S.rnd('(COUNT(*) FILTER (WHERE prediction_usd < 0)) * 100.0 / COUNT(*)', 2)} AS loss_pct,
       COUNT(*) FILTER (WHERE prediction_usd > 50000.0) AS high_profit_orders
FROM audit_t""", _AUDIT_SQL))
def _st_kpi(spark, sf_dir):
    return kpis(rule_audit(spark, sf_dir), high=TEST_TIERS[1])


@register("st_risk_counts", sql=S.with_fact("SELECT risk_level, COUNT(*) AS n FROM audit_t GROUP BY risk_level",
                                            _AUDIT_SQL))
def _st_risk_counts(spark, sf_dir):
    return rule_audit(spark, sf_dir).groupBy("risk_level").agg(F.count(F.lit(1)).alias("n"))


@register("st_latest_n", sql=S.with_fact("""
SELECT "Order_ID", "Customer_ID", "Sales", "Publish_Time", prediction_usd FROM audit_t
ORDER BY "Publish_Time" DESC, "Order_ID" DESC, "Sales" DESC, prediction_usd DESC, "Customer_ID" DESC LIMIT 100""",
                                         _AUDIT_SQL))
def _st_latest_n(spark, sf_dir):
    a = rule_audit(spark, sf_dir)
    # a top-100 report: each task keeps its own newest 100 (TakeOrderedAndProject)
    return a.orderBy(F.desc("Publish_Time"), F.desc("Order_ID"), F.desc("Sales"), F.desc("prediction_usd"),
                     F.desc("Customer_ID")).limit(100) \
        .select("Order_ID", "Customer_ID", "Sales", "Publish_Time", "prediction_usd")


@register("st_profit_trend", sql=S.with_fact(f"""
SELECT "Order_Date" AS day, {S.rnd('avg(prediction_usd)', 2)} AS avg_predicted_profit, COUNT(*) AS n
FROM audit_t GROUP BY 1 ORDER BY 1""", _AUDIT_SQL))
def _st_profit_trend(spark, sf_dir):
    return rule_audit(spark, sf_dir).groupBy(F.col("Order_Date").alias("day")) \
        .agg(N.rnd(F.avg("prediction_usd"), 2).alias("avg_predicted_profit"), F.count(F.lit(1)).alias("n")) \
        .orderBy("day")


def latency_class(now_epoch, publish_col: str = "Publish_Time", live_seconds: float = 600.0):
    """now - publish time: 0 <= s < live -> LIVE, other values -> HISTORY, missing -> N/A."""
    lat = F.lit(now_epoch) - F.col(publish_col) if not hasattr(now_epoch, "alias") else now_epoch - F.col(publish_col)
    return (F.when(F.col(publish_col).isNull(), F.lit("N/A"))
            .when((lat >= 0) & (lat < F.lit(live_seconds)), F.lit("LIVE")).otherwise(F.lit("HISTORY")))


@register("st_latency", sql=S.with_fact("""
SELECT CASE WHEN "Publish_Time" IS NULL THEN 'N/A'
            WHEN m.now - "Publish_Time" >= 0 AND m.now - "Publish_Time" < 600.0 THEN 'LIVE' ELSE 'HISTORY' END
         AS latency_class, COUNT(*) AS n
FROM audit_t, (SELECT MAX("Publish_Time") + 300.0 AS now FROM audit_t) m GROUP BY 1""", _AUDIT_SQL))
def _st_latency(spark, sf_dir):
    a = rule_audit(spark, sf_dir)
    # "now" is pinned to the newest publish time + 300 s so the result is reproducible
    now = a.agg((F.max("Publish_Time") + F.lit(300.0)).alias("now"))  # one row
    return a.crossJoin(F.broadcast(now)).groupBy(latency_class(F.col("now")).alias("latency_class")) \
        .agg(F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------- stream-run forms


def profit_model(spark, sf_dir):
    """The served model: the full profit pipeline (all categories, the interaction, the fitted shift), saved and reloaded."""
    from ledgerline.operators.models import load_model, profit_forest, save_model
    path = scratch_path(spark, "profit-model")
    save_model(profit_forest(spark, sf_dir), path)
    return load_model(spark, path)


@register("st_score")
def _st_score(spark, sf_dir):
    from ledgerline.operators.features import TEST_SERVING
    snapshot = stored_snapshot(spark, sf_dir, scratch_path(spark, "snapshot"))
    orders, _ = reject_invalid(parse_orders(dealt(order_messages(spark, sf_dir))))  # scoring is heavy per row
    s = score_orders(orders, snapshot, profit_model(spark, sf_dir), TEST_SERVING, TEST_TIERS)
    return s.select("Order_ID", "Customer_ID", "prediction_usd", "risk_level", "prediction_time")


INBOX_FILES = 6
#: Messages in a packed file.
MESSAGE_FILE_ROWS = 500_000


def run_stream(spark, sf_dir, base: str, runs: int = 1, publish=None, model=None) -> None:
    """The scoring stream over all messages, ``INBOX_FILES`` files in micro-batches of two, ``runs`` times."""
    from ledgerline.operators.features import TEST_SERVING
    model = model or profit_model(spark, sf_dir)
    inbox = f"{base}/inbox"
    if not path_exists(spark, inbox):
        order_messages(spark, sf_dir).repartition(INBOX_FILES).write.json(inbox)
    snapshot = stored_snapshot(spark, sf_dir, f"{base}/snapshot")
    for _ in range(runs):  # a second run with the same checkpoint must add nothing
        raw = order_source(spark, "json", {"maxFilesPerTrigger": "2"}, inbox)
        q = start_scoring(spark, raw, snapshot, model, base, publish or file_publisher(f"{base}/published"), TEST_SERVING,
                          tiers=TEST_TIERS, available_now=True)
        q.awaitTermination()


@register("st_foreach_batch_dual", sql=_enrich_sql())
def _st_foreach_batch_dual(spark, sf_dir):
    """Ids and enrichment of every audit row (the model's numbers are checked in the tests)."""
    base = scratch_path(spark, "stream")
    run_stream(spark, sf_dir, base)
    return spark.read.parquet(f"{base}/audit").select(
        "Order_ID", "Customer_ID", "Sales", N.rnd("cust_hist_sales", 4).alias("cust_hist_sales"),
        N.rnd("cust_hist_profit", 4).alias("cust_hist_profit"), N.rnd("cust_hist_margin", 6).alias("cust_hist_margin"))


@register("st_checkpoint", sql=S.with_fact("""
SELECT 'audit' AS sink, COUNT(*) AS n, TRUE AS several_batches FROM parsed
UNION ALL SELECT 'published', COUNT(*), TRUE FROM parsed
UNION ALL SELECT 'rejects', COUNT(*), TRUE FROM fact WHERE quantity IN (13, 41)""", _PARSED_SQL))
def _st_checkpoint(spark, sf_dir):
    """Rows in each sink after two runs with one checkpoint, over several micro-batches."""
    base = scratch_path(spark, "restart")
    run_stream(spark, sf_dir, base, runs=2)
    sinks = {"audit": spark.read.parquet(f"{base}/audit"), "published": spark.read.json(f"{base}/published"),
             "rejects": spark.read.parquet(f"{base}/rejects")}
    counts = [df.agg(F.lit(name).alias("sink"), F.count(F.lit(1)).alias("n"),
                     (F.countDistinct("batch_id") > 1).alias("several_batches")) for name, df in sinks.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@register("src_kafka", sql=S.with_fact("SELECT * FROM parsed", _PARSED_SQL))
def _src_kafka(spark, sf_dir):
    # the Kafka connector is not on this classpath: the same source function
    # reads the identical message shape from files (batch read here)
    inbox = scratch_path(spark, "inbox")
    # messages repeat their field names: packed, they take a fraction of the disk; a packed file is read by one task, so it is bounded
    order_messages(spark, sf_dir).write.mode("overwrite").option("maxRecordsPerFile", MESSAGE_FILE_ROWS).json(inbox, compression="gzip")
    return parse_orders(order_source(spark, "json", {}, inbox, streaming=False))
