"""Operator 1: exact code lengths against a step-by-step coder, and accuracy on the held-out fold."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from ledgerline.llm import langid

SCHEMA = "doc_id long, text string, lang string, lang_pred string, SCORE double"


def counts(texts):
    out = {}
    for t in texts:
        for i in range(len(t)):
            for k in range(1, min(i + 1, langid.ORDER + 1) + 1):
                g = t[i - k + 1:i + 1]
                out[g] = out.get(g, 0) + 1
    return out


def code_length(count, text):
    """Bits of a text, coded byte by byte in the longest known context, escaping to shorter ones."""
    bits = 0.0
    for i in range(len(text)):
        for k in range(min(langid.ORDER, i), -2, -1):
            if k < 0:
                bits += 8
                break
            after = {g[-1]: n for g, n in count.items() if len(g) == k + 1 and g[:-1] == text[i - k:i]}
            if not after:
                continue
            n, kinds = sum(after.values()), len(after)
            if text[i] in after:
                bits += math.log2((n + kinds) / after[text[i]])
                break
            bits += math.log2((n + kinds) / kinds)
    return bits


TRAIN = {"a": [b"the cat sat on the mat", b"hello there world"], "b": [b"le chat est sur le tapis", "été là".encode()],
         "c": [b"zz"]}


def model():
    langs = sorted(TRAIN)
    rows = [(i, len(g) * int(langid._TAG) + int.from_bytes(g, "big"), n)
            for i, x in enumerate(langs) for g, n in counts(TRAIN[x]).items()]
    return langid.build(langs, *(np.array(c) for c in zip(*rows, strict=True)))


@pytest.mark.parametrize("block", [1 << 20, 7])
def test_code_lengths_are_exact(monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK_BYTES", block)
    texts = [b"the chat on there", b"xyz!!", b"\xff\x00", b"t", b"", b"hello hello le tapis", b"the mat" * 9, "été sur là".encode()]
    got = model().lengths(texts)
    for text, row in zip(texts, got, strict=True):
        assert row == pytest.approx([code_length(counts(TRAIN[x]), text) for x in sorted(TRAIN)], abs=1e-9)


def test_counting_on_spark(spark):
    df = spark.createDataFrame([(x, t.decode()) for x, ts in TRAIN.items() for t in ts], "lang string, text string")
    got = {(r["lang"], r["string"]): r["n"] for r in langid.count_strings(df.repartition(3)).collect()}
    assert got == {(x, len(g) * int(langid._TAG) + int.from_bytes(g, "big")): n for x in TRAIN for g, n in counts(TRAIN[x]).items()}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    found = langid.identify(docs, langid.train(langid.labelled_rows(docs)))
    held = found.where(langid.held_out(F.col("doc_id")))
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count() > 0
    assert found.where("score < 0 OR score > 1").count() == 0


def test_odd_rows(spark):
    rows = [(1, "the cat the cat the cat", "en"), (2, "le chat le chat le chat", "fr"), (3, None, "en"), (4, "", "fr"), (5, "123 .,!", None),
            (6, "the cat", None), (6, "the cat", None), (None, "le chat", "fr"), (7, "the cat " * 200_000, "en"), (8, "Ω", "en")]
    docs = spark.createDataFrame([(i, t, x, "mine", 0.5) for i, t, x in rows], SCHEMA)
    m = langid.train(docs.select("lang", "text"), segments=8, segment_chars=64)
    got = langid.identify(docs.drop("lang_pred", "SCORE"), m).orderBy("doc_id").collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert [by[i][0]["lang_pred"] for i in (1, 2, 3, 4, 5, 6, 7)] == ["en", "fr", "und", "und", "und", "en", "en"]
    assert all(r["score"] == 0 for i in (3, 4, 5) for r in by[i]) and len(by[6]) == 2 and by[None][0]["lang_pred"] == "fr"
    kept = langid.accepted(docs, m)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "6", "6", "7", "8", "None"]


def test_what_no_model_codes_is_rejected(spark):
    rng = np.random.default_rng(0)
    noise = "".join(chr(c) for c in rng.integers(0x4E00, 0x9FFF, 400))
    docs = spark.createDataFrame([(1, "the cat sat on the mat " * 20, "en"), (2, noise, None)], "doc_id long, text string, lang string")
    kept = langid.accepted(docs, langid.train(docs.select("lang", "text")))
    assert [r["doc_id"] for r in kept.collect()] == [1]


def test_nothing_learned_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, "1", None)], "doc_id long, text string, lang string")
    assert langid.train(docs.select("lang", "text")) is None
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}
    assert [r["doc_id"] for r in langid.accepted(docs, None).collect()] == [1]
    empty = docs.where("false")
    assert langid.identify(empty, langid.train(empty.select("lang", "text"))).count() == 0


def test_sample_is_bounded_and_skips_repeats(spark):
    docs = spark.range(4000).select(F.concat(F.lit("text "), F.col("id") % 500).alias("text"), F.lit("x").alias("lang"))
    _, chosen = langid.sample(docs, 64, 100)
    texts = [r["text"] for r in chosen.collect()]
    assert 0 < len(texts) <= 64 and len(set(texts)) == len(texts)


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    docs = spark.range(5).select(F.lit("abc").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError):
        langid.train(docs)


@pytest.mark.parametrize("n", [1, 200])
def test_counted_rows_do_not_depend_on_partitions(spark, n):
    docs = spark.range(3000).select(F.concat_ws(" ", F.lit("word"), F.col("id"), F.repeat(F.lit("more text "), 20)).alias("text"),
                                    F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("lang")).repartition(n)
    _, chosen = langid.sample(docs, 256, 64)
    assert chosen.rdd.getNumPartitions() <= 8
    seen = spark.sparkContext.accumulator(0)
    raw = langid.strings

    def counted(block, starts, k):
        seen.add(1)
        return raw(block, starts, k)
    langid.strings = counted
    try:
        rows = langid.count_strings(chosen).collect()
    finally:
        langid.strings = raw
    assert rows and seen.value <= 8 * 2 * (langid.ORDER + 1)  # per task and language, not per batch or partition of docs


def test_sample_shrinks_with_languages():
    for languages in (1, 2, 4, 5, 50, 200):
        share, chars = langid.sample_size(languages, langid.SAMPLE_SEGMENTS, langid.SEGMENT_CHARS)
        assert share * chars * languages * max(4, languages) <= 4 * langid.SAMPLE_SEGMENTS * langid.SEGMENT_CHARS
        assert share * chars > 400
