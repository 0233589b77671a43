"""Operators 7 and 9 against brute force over all vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import ann, topk
from ledgerline.llm import vectors as V
from ledgerline.plans.lineage import cut

SCHEMA = "vec_id long, embedding array<float>, ids string, SCORE int"
NAN, INF = float("nan"), float("inf")


def table(spark, seed, n=900, dim=20):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    m = (centres[rng.integers(0, 5, n)] + 0.4 * rng.normal(size=(n, dim))).astype(np.float32)
    m[n // 3:2 * n // 3] = m[0]  # a third of the rows hold one vector
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(m)]
    rows += [(5000, None), (5050, [NAN] * dim), (5100, [1.0] * (dim - 1) + [INF]), (5150, [1.0, None] + [0.0] * (dim - 2)), (None, [1.0] * dim),
             (5200, [0.0] * dim), (5300, [1.0, 2.0]), (5400, [2.0, 1.0]), (5401, [1.0, 1.0]), (5500, []), rows[7], rows[50], rows[50]]
    return rows, spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(5)


def usable(rows, zeros):
    out = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and (zeros or any(v)):
            out.append((i, np.array(v, dtype=np.float32).astype(float)))
    return out


def expected(rows, every, k, score, best, zeros):
    ok, out = usable(rows, zeros), []
    for q in sorted({i for i, _ in ok if i % every == 0}):
        v = min((tuple(x) for i, x in ok if i == q))
        found = sorted((best * score(np.array(v), c), i) for i, c in ok if i != q and len(c) == len(v))[:k]
        out += [(q, r + 1, i, best * s) for r, (s, i) in enumerate(found)]
    return out


@pytest.mark.parametrize("block", [4096, 50])
def test_exact_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", block)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    rows, df = table(spark, 1)
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect()]
    whole = lambda x: np.floor(256 * x)
    want = expected(rows, 50, 5, lambda a, b: int(whole(a) @ whole(b)), -1, True)
    assert got == [(q, r, i, s) for q, r, i, s in want]


def test_products_of_any_size():
    rng = np.random.default_rng(0)
    for scale in (1e2, 1e7, 1e9, 1e15):
        q, c = np.floor(rng.normal(size=(3, 8)) * scale), np.floor(rng.normal(size=(4, 8)) * scale)
        want = [[max(-topk.LONG, min(topk.LONG, sum(int(x) * int(y) for x, y in zip(a, b, strict=True)))) for b in c] for a in q]
        assert topk.products(q, c).astype(np.int64).tolist() == want


@pytest.mark.parametrize("block", [4096, 60])
def test_nearest_neighbours(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "CODE_ROWS", block)
    monkeypatch.setattr(ann, "QUERY_ROWS", 3)
    rows, df = table(spark, 2)
    got = [tuple(r) for r in ann.search(df, F.col("vec_id") % 100 == 0, 10).orderBy("query_id", "rank").collect()]
    want = expected(rows, 100, 10, lambda a, b: float(np.sqrt(((a - b) ** 2).sum())), 1, False)
    assert len(got) == len(want)
    hits = len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want})
    assert hits >= 0.98 * len({(q, i) for q, _, i, _ in want})
    distance = {(q, i): s for q, _, i, s in want}
    assert all(s == pytest.approx(distance[q, i], abs=0, rel=1e-14) for q, _, i, s in got if (q, i) in distance)


def test_recall_on_the_given_vectors(spark):
    from conftest import SF_MID
    df = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = {(r["query_id"], r["vec_id"]) for r in ann.search(df, F.col("vec_id") % 100 == 0, 10).collect()}
    want = expected(rows, 100, 10, lambda a, b: float(np.sqrt(((a - b) ** 2).sum())), 1, False)
    assert len(got & {(q, i) for q, _, i, _ in want}) >= 0.99 * len(want)


def test_estimates_stay_within_their_bounds():
    """The bound holds for all but a small part of random pairs, and reranking leaves most rows out in high dimension."""
    rng = np.random.default_rng(3)
    m = rng.normal(size=(2000, 256))
    words, length, own = ann.encode(m, m.mean(axis=0), ann.rotation(256))
    q = rng.normal(size=256)
    rotated = (q - m.mean(axis=0)) @ ann.rotation(256)
    rotated /= np.sqrt((rotated ** 2).sum())
    est, err = ann.estimates(words, own, rotated, ann.EPSILON)
    true = ((m - m.mean(axis=0)) / length[:, None]) @ ((q - m.mean(axis=0)) / np.sqrt(((q - m.mean(axis=0)) ** 2).sum()))
    assert (np.abs(est - true) <= err).mean() > 0.99 and np.abs(est - true).mean() < 0.05
    assert np.allclose(ann.rotation(100) @ ann.rotation(100).T, np.eye(100))


def test_few_candidates_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df, F.col("vec_id") == 0, 5).collect()] == [(0, 1, 1, 256 * 128)]
    assert [r["vec_id"] for r in ann.search(df, F.col("vec_id") == 0, 10).collect()] == [1]
    empty = df.where("false")
    assert topk.top_k(empty, F.col("vec_id") == 0, 5).count() == 0
    assert ann.search(empty, F.col("vec_id") == 0, 5).count() == 0


def test_merging_in_a_tree(spark):
    rng = np.random.default_rng(5)
    rows = [(int(q), int(s), int(v), float(x)) for q in range(3) for s in range(300) for v, x in [(rng.integers(0, 10**6), rng.random())]]
    df = spark.createDataFrame(rows, "query_id long, s int, vec_id long, score double")
    got = [tuple(r) for r in V.merged(df, 4, 300, F.col("score").asc()).orderBy("query_id", "rank").collect()]
    want = [(q, r + 1, v, x) for q in range(3) for r, (x, v) in enumerate(sorted((x, v) for a, _, v, x in rows if a == q)[:4])]
    assert got == want


def test_candidates_are_sent_once_per_large_group_of_queries(spark):
    """100 candidate blocks and 40,000 queries of 64 dimensions: two copies, and 16 MB of queries in a task at most."""
    rows = min(topk.QUERY_ROWS, V.BLOCK_BYTES // (8 * 64))
    n_queries = -(-40_000 // rows)
    make = lambda n, data: cut(spark.range(n).selectExpr(
        "64 AS dim", "1 AS n", "id AS block", "CAST('i' AS binary) AS ids", f"CAST('{data}' AS binary) AS data"))
    tiles, shards = V.tiles(make(100, "c"), make(n_queries, "q"))
    copies = tiles.groupBy("ids", "s").count()
    assert tiles.count() == 100 * n_queries and shards == 25 and copies.count() == 25
    assert n_queries == 5 and V.PER_SHARD * V.BLOCK_BYTES == 16 << 20
