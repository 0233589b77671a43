"""File-fed stream: equal to the batch replay, nothing lost, nothing doubled, also when publishing fails."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators.features import TEST_SERVING
from ledgerline.operators.models import fit_profit, rf_regressor, split_profit
from ledgerline.sources.io import scratch_path
from ledgerline.streaming import scorer as ST


@pytest.fixture(scope="module")
def model(spark):
    train, _, shift = split_profit(spark, SF_SMALL)
    return fit_profit(train, rf_regressor(num_trees=5, depth=4), shift)


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def check_sinks(spark, base, model):
    """Audit, published records and rejects hold each message once, with the numbers of a batch replay."""
    cols = ["Order_ID", "Customer_ID", "Sales", "prediction_usd", "risk_level"]
    orders, invalid = ST.reject_invalid(ST.parse_orders(ST.order_messages(spark, SF_SMALL)))
    batch = ST.score_orders(orders, ST._snapshot(spark, SF_SMALL), model, TEST_SERVING, ST.TEST_TIERS)
    audit = spark.read.parquet(f"{base}/audit")
    assert rows(audit, cols) == rows(batch, cols)
    assert audit.select("batch_id").distinct().count() >= 2
    published = spark.read.json(f"{base}/published")
    assert published.count() == audit.count()
    assert published.where(F.get_json_object("value", "$.risk_level").isNull()).count() == 0
    rejects = spark.read.parquet(f"{base}/rejects")
    assert audit.count() + rejects.count() == ST.order_messages(spark, SF_SMALL).count()
    reasons = {r["reject_reason"]: r["n"] for r in rejects.groupBy("reject_reason").agg(F.count("*").alias("n")).collect()}
    assert set(reasons) == {"unreadable", "no order or customer id"} and invalid.count() == 0


def test_restart_is_idempotent(spark, model):
    base = scratch_path(spark, "stream-test")
    ST.run_stream(spark, SF_SMALL, base, runs=2, model=model)
    check_sinks(spark, base, model)


def test_failed_publish_loses_and_doubles_nothing(spark, model):
    """The publisher fails once, after the audit of its batch is written; the restarted stream repeats that batch."""
    base = scratch_path(spark, "stream-crash")
    publish, failed = ST.file_publisher(f"{base}/published"), []

    def fails_once(payload, batch_id):
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("the broker is away")
        publish(payload, batch_id)

    with pytest.raises(StreamingQueryException):
        ST.run_stream(spark, SF_SMALL, base, model=model, publish=fails_once)
    assert failed and spark.read.parquet(f"{base}/audit").where("batch_id = 1").count() > 0
    ST.run_stream(spark, SF_SMALL, base, model=model, publish=fails_once)
    check_sinks(spark, base, model)


def test_reject_reasons(spark):
    msgs = spark.createDataFrame([
        ('{"Order_ID": "1", "Customer_ID": "7", "Sales": 1.0, "Discount": 0.0, "Quantity": 1, "Shipping_Cost": 0.5}',),
        ('{"Order_ID": "2", "Customer_ID": "7", "Sales": null, "Discount": 0.0, "Quantity": 1, "Shipping_Cost": 0.5}',),
        ("junk",), (None,), ('{"Order_ID": "3", "Customer_ID": null}',)], "value string")
    got = sorted((str(r["message"])[:20], r["reject_reason"]) for r in ST.route(msgs).collect())
    assert sorted(str(r) for _, r in got) == ["None", "no Sales", "no order or customer id", "unreadable", "unreadable"]
