"""What lies on disk while a query runs: packed, written once, and given back."""

import os

from conftest import SF_SMALL
from ledgerline.operators import models as M
from ledgerline.operators import observed as O
from ledgerline.plans import versioned as V
from ledgerline.sources.io import path_exists, scratch_path
from ledgerline.streaming import scorer as ST
from ledgerline.streaming import stateful as SF


def files(folder: str) -> list[str]:
    return sorted(f for d, _, names in os.walk(folder.removeprefix("file:")) for f in names if f.startswith("part-"))


def test_messages_wait_in_packed_files_of_bounded_rows(spark, monkeypatch):
    inbox = scratch_path(spark, "packed-inbox")
    monkeypatch.setattr(ST, "scratch_path", lambda *_: inbox)
    monkeypatch.setattr(ST, "MESSAGE_FILE_ROWS", 1000)
    got = ST._src_kafka(spark, SF_SMALL).count()
    found = files(inbox)
    assert all(f.endswith(".json.gz") for f in found) and max(spark.read.json(f"{inbox}/{f}").count() for f in found) <= 1000
    assert got == ST.parse_orders(ST.order_messages(spark, SF_SMALL)).count() > 1000


def test_delivered_slices_are_packed(spark):
    base = scratch_path(spark, "packed-slices")
    slices = [spark.range(5).selectExpr("cast(id AS string) AS value"), spark.range(5, 9).selectExpr("cast(id AS string) AS value")]
    SF.deliver(spark, slices, f"{base}/inbox", lambda s: s.writeStream.format("parquet").option("path", f"{base}/out")
               .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    assert files(f"{base}/inbox") and all(".zstd." in f for f in files(f"{base}/inbox"))
    assert spark.read.parquet(f"{base}/out").count() == 9


def test_a_published_table_is_the_staged_one(spark, monkeypatch):
    staged, base, seen = scratch_path(spark, "staged-once"), scratch_path(spark, "published-once"), []
    monkeypatch.setattr(O, "scratch_path", lambda *_: staged)
    write = O.write_observed

    def observed(*args):
        found = write(*args)
        seen.append(files(staged))
        return found
    monkeypatch.setattr(O, "write_observed", observed)
    for k in range(4):
        assert O.publish_if(spark.range(k + 3, numPartitions=2), base, [], {}) == (k, {"rows": k + 3})
        assert files(f"{base}/version={k}") == seen[-1] and not path_exists(spark, staged)
    assert V.versions(spark, base) == [2, 3] and V.read_version(spark, base, 3).count() == 6
    os.makedirs(f"{base.removeprefix('file:')}/version=4/left-by-a-writer-that-died")
    assert O.publish_if(spark.range(2), base, [], {})[0] == 4 == V.newest(spark, base)
    assert V.read_version(spark, base, 4).count() == 2


def test_lines_of_the_training_frame_are_given_back(spark, monkeypatch):
    made, lines = [], M.profit_lines
    monkeypatch.setattr(M, "profit_lines", lambda *a: made.append(lines(*a)) or made[-1])
    train, test, _ = M.split_profit(spark, SF_SMALL)
    assert len(made) == 1 and not path_exists(spark, made[0]._cut_path)
    assert train.count() > 3 * test.count() > 0
    assert all(".zstd." in f for f in train.inputFiles())
