"""Operator 10 and the token ids: against the tokenizer itself and a plain best-fit decreasing."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import packing, tokens

PATH = tokens.tokenizer_path()
TOKENIZER = Tokenizer.from_file(PATH)
ODD = list("aAbBhHeE éÉ'’.,;:!?*%$#&()\"1٣߀ \n\t\r\x0b\x0c\x1c\x85\xa0 　̸̱́<|>_-ßẞİıſΣςσǅ中文한각하😀ﬁ") + [
    "<|endoftext|>", "<|startoftext|>", "'s", "'S", "'ll", "<|ENDOFTEXT|>"]
CACHE = tokens.WordIds(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=14).map("".join) | st.text(max_size=12))
def test_word_by_word_ids_are_the_tokenizers(text):
    got = np.frombuffer(tokens.encode(CACHE, text.encode("utf-8", "surrogatepass"), 1), "<u4").tolist() \
        if not any(0xD800 <= ord(c) < 0xE000 for c in text) else ids_of("")
    assert got == (ids_of(text) if not any(0xD800 <= ord(c) < 0xE000 for c in text) else ids_of(""))


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_WORDS", 3)
    small = tokens.WordIds(PATH)
    text = "The the, cat. The dog! the Cat dog a b c d the"
    for _ in range(3):
        assert np.frombuffer(tokens.encode(small, text.encode(), 1), "<u4").tolist() == ids_of(text)
        assert len(small) <= 4


def best_fit_decreasing(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(bins) if r >= n]
        at = min(fits, key=bins.__getitem__) if fits else len(bins)
        if at == len(bins):
            bins.append(capacity)
        bins[at] -= n
    return sorted(bins)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 37, 100])
    lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 200))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    fill, places = {}, {}
    for n, rank, count, first, offset in packing.plan_best_fit(histogram, capacity).tolist():
        places.setdefault(n, []).append((rank, count))
        for i in range(count):
            fill.setdefault(first + i, []).append((offset, n))
    for parts in fill.values():
        assert [x for x, _ in sorted(parts)] == np.cumsum([0, *[n for _, n in sorted(parts)][:-1]]).tolist()
    assert sorted(capacity - sum(n for _, n in p) for p in fill.values()) == best_fit_decreasing(lengths, capacity)
    for n, runs in places.items():
        assert sum(c for _, c in runs) == histogram[n]
        assert [r for r, _ in sorted(runs)] == np.cumsum([0, *[c for _, c in sorted(runs)][:-1]]).tolist()


def test_pack(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choices(["The", "cat", "sat.", "été", "x1"], k=rnd.choice([1, 5, 30, 31, 90])))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n"), (7, rows[7][1]), (7, rows[7][1]), (None, "no id"), (200, "word " * 5000)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, id long, LENGTH string")
    got = packing.pack(df, capacity=64).toPandas()
    expected = []
    for i, t in rows:
        ids = ids_of(t)
        expected += [(i, k, at, len(ids[at:at + 64]), zlib.crc32(np.array(ids[at:at + 64], "<u4").tobytes()))
                     for k, at in enumerate(range(0, len(ids), 64))]
    key = lambda r: tuple(-1 if x is None or x != x else int(x) for x in r)
    assert sorted(map(key, got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False))) == sorted(map(key, expected))
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert part["offset"].tolist() == (part["length"].cumsum() - part["length"]).tolist() and part["length"].sum() <= 64
    filled = got.groupby("sequence_id")["length"].sum()
    assert sorted(64 - filled) == best_fit_decreasing([r[3] for r in expected], 64)


def test_one_length_for_all(spark):
    df = spark.createDataFrame([(i, "same words") for i in range(500)], "doc_id long, text string")
    got = packing.pack(df, capacity=10).toPandas()  # 3 ids each: 3 to a sequence
    assert got["sequence_id"].nunique() == 167 and not got.duplicated(["sequence_id", "offset"]).any()


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), max_size=14).map("".join) | st.none(), max_size=8))
def test_words_learned_together_have_the_tokenizers_ids(texts):
    fresh = tokens.WordIds.__new__(tokens.WordIds)
    fresh.tokenizer, fresh.older = TOKENIZER, {}
    got = tokens.encode_all(fresh, [x if x is None else x.encode() for x in texts], 1)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [ids_of(x) for x in texts]


def test_new_words_take_few_calls():
    calls = []

    class Counted:
        def encode(self, text, **settings):
            calls.append(text)
            return TOKENIZER.encode(text, **settings)

    fresh = tokens.WordIds(PATH)
    fresh.tokenizer = Counted()
    words = [f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}qué" for k in range(2000)]
    texts = [" ".join(words[k:k + 20]) for k in range(0, 2000, 20)]
    got = list(tokens.encode_all(fresh, [x.encode() for x in texts], 1))
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [ids_of(x) for x in texts]
    assert len(calls) <= 10
