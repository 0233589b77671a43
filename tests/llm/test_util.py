"""What bounds the memory of Python workers."""

import pyarrow as pa
import pytest

from ledgerline.llm import tokens, util


def test_few_rows_are_sent_at_once_and_the_setting_returns(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    with pytest.raises(KeyError), util.few_rows_at_once(spark, 10):
        got = [r["n"] for r in spark.range(0, 95, 1, 1).mapInArrow(sizes, "n long").collect()]
        assert max(got) == 10 and sum(got) == 95
        raise KeyError
    assert spark.conf.get(name) == was


def test_a_worker_cache_is_dropped_and_made_again():
    made = []
    make = lambda: made.append(1) or {"n": len(made)}
    assert util.worker_cache("test", make) is util.worker_cache("test", make)
    util.forget_worker_cache()
    util.forget_worker_cache()
    assert util.worker_cache("test", make) == {"n": 2}
    util.forget_worker_cache()


def test_memory_goes_back_after_the_last_rows(monkeypatch):
    given = []
    monkeypatch.setattr(util, "give_back_memory", lambda: given.append(1))
    parts = util.row_groups(iter([pa.record_batch({"x": list(range(7))})]), 3)
    assert [p.num_rows for p in parts] == [3, 3, 1] and given == [1]


def test_a_worker_keeps_few_words():
    assert tokens.MAX_WORDS <= 200_000
