"""Operator 12 against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from ledgerline.llm import spelling as S
from ledgerline.plans.lineage import cut


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def expected(counts, ratio=5):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {w: (form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts}


def made_words(seed, n, letters="abcé", low=1, high=9):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(low, high))) for _ in range(n)}
    for w in rng.sample(sorted(words), len(words) // 3):  # neighbours on purpose
        i = rng.randrange(len(w) + 1)
        words |= {w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1:] or "a", w[:i] + rng.choice(letters) + w[i + 1:]}
    return {w: rng.choice([1, 1, 2, 5, 7, 30, 200, 1200]) for w in words}


def result(spark, counts, **kw):
    words = cut(spark.createDataFrame(sorted(counts.items()), "word string, n long").repartition(3))
    rows = S.variants(words, **kw).collect()
    assert len(rows) == len(counts)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@pytest.mark.parametrize(("seed", "tile_words"), [(0, 7), (1, 60), (2, S.TILE_WORDS)])
def test_as_all_pairs(spark, seed, tile_words):
    counts = made_words(seed, 500)
    assert result(spark, counts, tile_words=tile_words) == expected(counts)


def test_hot_prefix_over_many_tiles(spark):
    """One prefix that most words share, longer than their rest."""
    counts = {"unbeliev" + w if n % 3 else w: n for w, n in made_words(4, 350, "ab", 1, 7).items()}
    assert result(spark, counts, tile_words=9) == expected(counts)


def test_very_long_words(spark):
    long = "a" * 30_000
    counts = {long: 100, long[:-1]: 10, "b" + long: 1, long[:20_000] + "é" + long[20_001:]: 3, "aaaaaa": 5}
    assert result(spark, counts, tile_words=2) == expected(counts)


def test_scan_in_memory():
    for seed in range(30):
        words = sorted(made_words(seed, 120, "abc", 1, 8))
        lcp = S.prefix_lengths(words)
        back = sorted(w[::-1] for w in words)
        found = {(q, words[j]) for i, q in enumerate(words) for j in S.near_pairs(q, words, lcp, i + 1, False)}
        other = S.prefix_lengths(back)
        turned = [(q[::-1], back[j][::-1]) for i, q in enumerate(back) for j in S.near_pairs(q, back, other, i + 1, True)]
        pairs = [tuple(sorted(p)) for p in found] + [tuple(sorted(p)) for p in turned]
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}


def test_whole_documents(spark):
    rng = random.Random(3)
    pool = ["Straße", "ÉTAGÈRE", "colour", "color's", "behaviour", "behavior", "naïveté", "d×y÷z", "short", "Wörterbuch"]
    rows = [(i if i % 11 else None, " ".join(rng.choices(pool, k=rng.randrange(60))) if i % 7 else rng.choice([None, ""]), "x", 1)
            for i in range(300)]
    rows += rows[:20] + [(77, "Wörterbuch-" * 40_000, "x", 1)]
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int").repartition(4)
    found = {r["word"]: tuple(r)[1:] for r in S.group_variants(docs).collect()}
    assert found == expected(counts) and len(counts) > 6


def test_empty(spark):
    docs = spark.createDataFrame([(1, None), (2, "a b c")], "doc_id long, text string")
    assert S.group_variants(docs).count() == 0
    assert S.group_variants(docs.limit(0)).columns == ["word", "form", "root", "n", "n_near", "form_n"]
