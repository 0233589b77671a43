"""Operator 13 against dictionaries of counts, and its sequences against plain arrays."""

import math
import mmap
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import lmscore as L
from ledgerline.llm.eliasfano import Sequence, Trie, build_trie, encode

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = L.pieces
SCHEMA = "doc_id long, text string, learn boolean, row int, score string"


def tokens_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [None]


def expected(rows, strength=L.STRENGTH):
    c, pairs = Counter(), Counter()
    for _, text, learn, *_ in rows:
        if learn:
            t = tokens_of(text)
            c.update(t)
            pairs.update(zip(["<start>", *t[:-1]], t, strict=True))
    n, kinds = sum(c.values()), len(c)
    p1 = {w: (c[w] + .5) / (n + .5 * (kinds + 1)) for w in {w for _, text, *_ in rows for w in tokens_of(text)}}
    context = dict(c) | {"<start>": c[None]}
    out = []
    for doc_id, text, *_ in rows:
        t = tokens_of(text)
        base = sum(math.log10(p1[w]) for w in t)
        model = 0.0
        for a, w in zip(["<start>", *t[:-1]], t, strict=True):
            top = pairs[a, w] + strength * p1[w]
            if pairs[a, w]:
                top = n * 10 ** (-min(65535, round(-math.log10(top / n) * L.STEPS)) / L.STEPS)
                top = max(top, 0)
            model += math.log10(top / (context.get(a, 0) + strength))
        out.append((doc_id, len(t), sum(c[w] > 0 for w in t), n, base, model))
    return out


def same(found, wanted):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], round(r[4], 5), round(r[5], 5))
    found, wanted = sorted((tuple(r) for r in found), key=key), sorted(wanted, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in wanted]
    for r, w in zip(found, wanted, strict=True):
        assert r[4:] == pytest.approx(w[4:], rel=1e-9, abs=1e-7)


def corpus(seed, n=120):
    rng = random.Random(seed)
    pool = ["the", "The", "a", "über", "x\x0by", "new\nline", "tab\tbed", "nbsp\xa0in", "é", "\U0001F600", *map(str, range(40))]
    weights = [40, 10, 20, *[3] * (len(pool) - 3)]
    rows = [(rng.randrange(90) if rng.random() > .05 else None, rng.choice([None, "", "  "]) if rng.random() < .1 else
             " ".join(rng.choices(pool, weights, k=rng.randrange(80))), rng.random() > .3, 1, "s") for _ in range(n)]
    return rows + rows[:10]


@pytest.mark.parametrize(("seed", "kw"), [(0, {}), (1, {"shard_bytes": 900, "block_tokens": 150})])
def test_as_dictionaries(spark, seed, kw):
    """One shard; and many shards and blocks, where common words are spread by their contexts."""
    rows = corpus(seed)
    same(L.score(spark.createDataFrame(rows, SCHEMA).repartition(4), F.col("learn"), **kw).collect(), expected(rows))


def test_very_long_text_in_pieces(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(1, " ".join(rng.choices("abcdefgh", k=5000)), True, 0, ""), (2, "a" * 9000 + "  b", False, 0, ""), (3, "a b", True, 0, "")]
    same(L.score(spark.createDataFrame(rows, SCHEMA).coalesce(1), F.col("learn"), block_tokens=700).collect(), expected(rows))
    text = "ab cd\x0bef " + "g" * 50 + " h"
    cut = list(L.pieces(text.encode(), 4))
    assert b"".join(cut).decode() == text and len(cut) > 2
    found = []
    for size in (1 << 20, 64):
        monkeypatch.setattr(L, "pieces", lambda t, size=size: PIECES(t, size))
        batch = pa.RecordBatch.from_pydict({"id": [r[0] for r in rows], "text": [r[1] for r in rows], "learn": [r[2] for r in rows]})
        seen = Counter()
        for _, first, ids, _, count, words, contexts, slots in L.blocks(iter([batch]), 1000):
            assert len(count) == len(ids) and slots[-1] == len(ids) - 1
            for w, a, s in zip(words.tolist(), contexts.tolist(), slots.tolist(), strict=True):
                seen[first + s, ids[s], w, a] += 1
        found.append(seen)
    assert found[0] == found[1]


def test_nothing_to_learn(spark):
    rows = [(1, "a b", False, 0, ""), (2, None, None, 0, "")]
    found = L.score(spark.createDataFrame(rows, SCHEMA), F.col("learn")).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found) == [
        (1, 0, 0, 0, 0), (3, 0, 0, 0, 0)]
    assert L.score(spark.createDataFrame([], SCHEMA), F.col("learn")).count() == 0


def test_sums_to_one():
    """p(w | a) over all known words and one unknown word, before quantisation."""
    rows = [(1, "a b a c a b", True), (2, "b b a", True)]
    c, pairs = Counter(), Counter()
    for _, text, _ in rows:
        t = tokens_of(text)
        c.update(t)
        pairs.update(zip(["<start>", *t[:-1]], t, strict=True))
    n, kinds = sum(c.values()), len(c)
    p1 = lambda k: (k + .5) / (n + .5 * (kinds + 1))
    for a, total in {"a": c["a"], "<start>": 2, "?": 0}.items():
        known = sum((pairs[a, w] + L.STRENGTH * p1(c[w])) / (total + L.STRENGTH) for w in c)
        assert known + L.STRENGTH * p1(0) / (total + L.STRENGTH) == pytest.approx(1)


def test_better_than_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fold = L.held_out(F.col("doc_id"))
    r = L.score(docs, ~fold).where(L.held_out(F.col("doc_id"))).agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert r[2] > 20 and r[0] > r[1]
    ids = [x["doc_id"] for x in docs.where(fold).select("doc_id").collect()]
    assert all(zlib.crc32(str(i).encode()) % 5 == 1 for i in ids)


@pytest.mark.parametrize("seed", range(6))
def test_sequences(seed):
    rng = np.random.default_rng(seed)
    for n, top in ((0, 5), (1, 3), (1, 1 << 63), (300, 40), (300, 1 << 20), (2000, (1 << 64) - 1)):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
        data = b"x" * 8 + encode(values)
        s = Sequence(data, 8)
        assert s.end == len(data) and (s.all() == values).all()
        if n:
            at = rng.integers(0, n, 50)
            assert (s.get(at) == values[at]).all()
        wanted = np.concatenate([rng.integers(0, top, 200, dtype=np.uint64, endpoint=True), values[:20],
                                 np.array([0, (1 << 64) - 1], np.uint64)])
        assert (s.successor(wanted) == np.searchsorted(values, wanted)).all()
        low = rng.integers(0, n + 1, len(wanted))
        high = np.minimum(n, low + rng.integers(0, 30, len(wanted)))
        got = s.successor(wanted, low, high)
        for w, a, z, g in zip(wanted, low, high, got, strict=True):
            assert g == a + np.searchsorted(values[a:z], w)


def test_trie_in_a_memory_map(tmp_path):
    rng = np.random.default_rng(1)
    words = np.unique(rng.integers(0, 1 << 64, 400, dtype=np.uint64))
    pairs = sorted({(int(w), int(c)) for w, c in zip(rng.integers(0, len(words), 3000), rng.integers(0, 1 << 44, 3000), strict=True)})
    word_of, context = np.array([p[0] for p in pairs]), np.array([p[1] << 20 for p in pairs], np.uint64)
    code = rng.integers(0, 65536, len(pairs)).astype(np.uint16)
    counts = rng.integers(1, 1 << 40, len(words))
    path = tmp_path / "levels"
    path.write_bytes(build_trie(words, counts, word_of, context, code))
    with open(path, "rb") as f, mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) as buffer:
        trie = Trie(buffer)
        place = trie.word(words)
        assert (place == np.arange(len(words))).all() and (trie.counts[place] == counts).all()
        assert (trie.word(words + np.uint64(1)) == np.where(np.isin(words + np.uint64(1), words), place + 1, -1)).all()
        assert (trie.code(word_of, context) == code).all()
        assert (trie.code(word_of, context ^ np.uint64(1 << 63)) == -1).sum() > 2900
        assert (trie.code(np.full(5, -1), context[:5]) == -1).all()
        del trie
