"""Operator 6: the n-gram Jaccard join against brute force."""

import random
import re

import numpy as np
import pytest

from ledgerline.llm import jaccard
from ledgerline.llm.jaccard import linked_classes, most_different, slices

SCHEMA = "doc_id long, text string, cid string, N long"


def brute(rows, width, num, den):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)), key=str)


def corpus(seed, n=150, longest=120, vocabulary=400):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdefghié", k=rnd.randint(1, 6))) for _ in range(vocabulary)]
    texts = []
    while len(texts) < n:
        text = rnd.choices(words, k=rnd.choice([1, 2, 3, 9, 10, 11, 30, 60, longest]))
        texts.append(text)
        for _ in range(rnd.choice([0, 0, 1, 4])):  # chains of near copies
            text = list(text)
            for _ in range(rnd.randint(0, 2)):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            if rnd.random() < 0.3:
                text.append(rnd.choice(words))
            texts.append([x.upper() if rnd.random() < 0.1 and x.isascii() else x for x in text])
    rows = [(i, rnd.choice([" ", "\n", "\t "]).join(t)) for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    return [*rows, (9000, None), (9001, ""), (9002, " \n"), (9003, "one"), (9004, "One"), (None, "one"),
            (None, "only here in this text"), (9005, "a b c d"), (9005, rows[0][1]), rows[1], rows[1]]


def run(spark, rows, *args):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    return sorted((tuple(r)[:3] for r in linked_classes(df, *args).collect()), key=str)


@pytest.mark.parametrize(("seed", "width", "num", "den"), [(1, 3, 90, 100), (2, 5, 80, 100), (3, 1, 50, 100)])
def test_equals_brute_force(spark, seed, width, num, den):
    rows = corpus(seed)
    assert run(spark, rows, width, num, den) == brute(rows, width, num, den)


def test_clusters_larger_than_a_tree(spark, monkeypatch):
    """Many small trees: pivots, pairs of trees and pure trees of a large component all take part."""
    monkeypatch.setattr(jaccard, "LEAF_SETS", 8)
    monkeypatch.setattr(jaccard, "LEAF_TOKENS", 600)
    monkeypatch.setattr(jaccard, "ACROSS_SETS", 12)
    rnd = random.Random(5)
    base = [str(rnd.randrange(500)) for _ in range(80)]
    rows = []
    for i in range(140):  # a hot group of near copies and strays that share most of its words
        text = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 5, 8])):
            text[rnd.randrange(80)] = f"x{rnd.randrange(10_000)}"
        rows.append((i, " ".join(text[:rnd.choice([80, 80, 70, 60, 50])])))
    rows.append((3, rows[3][1]))
    assert run(spark, rows, 3, 80, 100) == brute(rows, 3, 80, 100)


def test_trees_of_wide_bitmaps_hold_fewer_sets(spark, monkeypatch):
    """What a task holds of two trees is bounded in bytes, whatever the number and size of their sets."""
    monkeypatch.setattr(jaccard, "LEAF_SETS", 4)
    monkeypatch.setattr(jaccard, "ACROSS_BYTES", 1 << 9)  # four bitmaps of 1024 bits
    sizes, real = [], jaccard.cut

    def spy(df, name, *args):
        out = real(df, name, *args)
        if name == "leaves":
            sizes.extend(r["count"] for r in out.groupBy("leaf").count().collect())
        return out

    monkeypatch.setattr(jaccard, "cut", spy)
    rnd = random.Random(5)
    text = [str(rnd.random()) for _ in range(60)]
    rows = []
    for i in range(200):
        near = list(text)
        near[rnd.randrange(60)] = f"w{i}"
        near[rnd.randrange(60)] = f"v{i}"
        rows.append((i, " ".join(near)))
    assert run(spark, rows, 1, 93, 100) == brute(rows, 1, 93, 100)
    assert len(sizes) > 10 and max(sizes) < 40  # dealt by hash: some above the average


def test_empty_table(spark):
    assert run(spark, [], 3, 90, 100) == []


def linked_pair(a, b, num):
    i = len(np.intersect1d(a, b))
    return 100 * i >= num * (len(a) + len(b) - i) and not np.array_equal(a, b)


def test_linked_sets_share_a_slice():
    """Guarantee at every size: any two linked different sets have a key in common."""
    rng = np.random.default_rng(0)
    for num in (80, 90):
        for _ in range(600):
            n = int(rng.choice([rng.integers(4, 600), rng.integers(500, 6000)], p=[.9, .1]))
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
            drop = int(rng.integers(0, most_different(len(a), num, 100) + 1))
            b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**63, int(rng.integers(0, 3))).astype(np.uint64)]))
            if linked_pair(a, b, num):
                assert len(np.intersect1d(slices(a, num, 100), slices(b, num, 100)))


@pytest.mark.parametrize("num", [80, 90])
def test_adversary_spreads_its_edits(num):
    """Each edit spoils a slice that no other edit touches, from the lowest hashes up, down, or at random."""
    rng = np.random.default_rng(num)
    for n in (300, 511, 512, 1000, 6000, 20_000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        most = most_different(len(a), num, 100) // 2
        places = (a >> np.uint64(32)).astype(float) / 2**32
        for order in (np.arange(len(a)), np.arange(len(a))[::-1], rng.permutation(len(a))):
            for pieces in (64, most, 2 * most, 4 * most):
                hit, spoilt = set(), []
                for k in order:
                    s = int(places[k] * pieces)
                    if s not in hit and len(spoilt) < most:
                        hit.add(s)
                        spoilt.append(k)
                b = a.copy()
                b[spoilt] ^= np.uint64(2)
                b = np.unique(b)
                if linked_pair(a, b, num):
                    assert len(np.intersect1d(slices(a, num, 100), slices(b, num, 100))), (n, pieces)


def test_long_pair_with_an_edit_in_each_low_slice(spark):
    """6,000 words, 20 edits whose n-grams lie in the 60 lowest of 64 parts of the range of hashes used before: still linked."""
    rnd = random.Random(11)
    base = [str(rnd.randrange(10**7)) for _ in range(6002)]
    grams = jaccard.shingle_set(" ".join(base).encode(), 3)
    assert len(grams) == 6000
    of_gram = {}
    for k in range(len(base) - 2):
        of_gram[int(jaccard.shingle_set(" ".join(base[k:k + 3]).encode(), 3)[0])] = k
    near, hit = list(base), set()
    for g in grams[:700]:  # the lowest hashes
        part, k = int(int(g) * 600 >> 64), of_gram[int(g)]
        if part not in hit and len(hit) < 60:
            hit.add(part)
            near[k] = f"x{k}"
    rows = [(1, " ".join(base)), (2, " ".join(near))]
    got = run(spark, rows, 3, 90, 100)
    assert got == brute(rows, 3, 90, 100) and [r[2] for r in got] == [1, 1]


def test_long_texts(spark):
    rnd = random.Random(3)
    base = [str(rnd.randrange(10**6)) for _ in range(30_000)]
    near, far = list(base), list(base)
    for k in range(0, 30_000, 100):
        near[k] = "x"
    for k in range(0, 30_000, 20):
        far[k] = "x"
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))]
    got = run(spark, rows, 3, 90, 100)
    assert got == brute(rows, 3, 90, 100)
    assert [r[2] for r in got] == [1, 1, 3]


def test_one_of_each_class(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (1, "z y x w v u"), (7, "z y x w v u"), (None, "a b c d e f"),
            (None, "q r s t"), (8, None), (8, None), (9, "")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    got = jaccard.one_of_each_class(df, linked_classes(df, 5, 80, 100))
    assert got.columns == df.columns
    assert sorted(((r[0], r[1]) for r in got.collect()), key=str) == sorted(
        [(1, "a b c d e f"), (1, "z y x w v u"), (None, "q r s t"), (8, None), (8, None), (9, "")], key=str)


def across(spark, left, right):
    """The links that ``_across`` finds between two components of sets of 100 tokens, as pairs of places in left and right."""
    cids = [bytes([side]) * 8 + k.to_bytes(8, "big") for side, sets in enumerate((left, right)) for k in range(len(sets))]
    band = int(np.floor(np.log(100) / (1.000001 * np.log(100 / 90))))
    sets = spark.createDataFrame([(1, bytearray(c), 100, bytearray(np.unique(np.array(x, np.uint64)).tobytes()))
                                  for c, x in zip(cids, left + right, strict=True)], "cluster long, cid binary, n long, tokens binary")
    labelled = spark.createDataFrame([(1, bytearray(c), 100, band, bytearray(c[:8])) for c in cids],
                                     "cluster long, cid binary, n long, band int, label binary")
    return [tuple(sorted(bytes(x) for x in r)) for r in jaccard._across(labelled, sets, 90, 100).collect()], cids


def random_tokens(count):
    return np.random.default_rng(9).integers(1, 2**63, count).tolist()


def test_many_links_between_components_give_few_rows(spark):
    base, own = random_tokens(100), random_tokens(220)[100:]
    sets = [base[:k % 100] + [own[k]] + base[k % 100 + 1:] for k in range(120)]
    links, _ = across(spark, sets[:60], sets[60:])  # all 3,600 pairs are linked
    assert 1 <= len(links) <= 60


def test_one_link_among_many_near_misses_is_found(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FEW_PAIRS", 2, raising=False)
    base, own = random_tokens(100), random_tokens(400)[100:]
    left = [own[3 * k:3 * k + 3] + base[3:] for k in range(40)]
    right = [base[:3] + own[120 + 3 * k:123 + 3 * k] + base[6:] for k in range(40)]
    right[17][0] = left[29][0]  # now 95 tokens in common, the others have 94
    links, cids = across(spark, left, right)
    assert links == [(cids[29], cids[57])]


@pytest.mark.parametrize("most", [1, 4, 1000])
def test_some_pairs_of_each_two_labels(most):
    rng = np.random.default_rng(most)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(40), np.arange(50), indexing="ij"))
    of_i, of_j = rng.integers(0, 3, 40), rng.integers(0, 3, 50)
    a, b, more = jaccard.some_of_each(i, j, of_i, of_j, most)
    got, every = ({}, {})
    for one, two, into in ((a, b, got), (i, j, every)):
        for x, y in zip(one.tolist(), two.tolist()):
            key = tuple(sorted((int(of_i[x]), int(of_j[y]))))
            into[key] = into.get(key, 0) + 1
    assert got == {k: min(most, n) for k, n in every.items()} and more == any(n > most for n in every.values())
    assert [len(x) for x in jaccard.some_of_each(i[:0], j[:0], of_i, of_j, most)[:2]] == [0, 0]
