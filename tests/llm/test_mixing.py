"""Operator 5: targets, nearness to them, whole results; the SQL oracle is checked with the other queries."""

import random

import pytest

from ledgerline.llm import mixing

SCHEMA = "doc_id long, text string, source string, key string, SIZE long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "k", 1) for i, t, s in rows], SCHEMA)


def water_fill(sizes, weights=(5, 2, 1), cap=3):
    """Targets by resharing the excess until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        free = sum(w[s] for s in names if s not in full)
        target = {s: cap * sizes[s] if s in full else rest * w[s] / free for s in names}
        above = {s for s in names if s not in full and target[s] > cap * sizes[s]}
        if not above:
            return target
        full |= above


def corpus(seed, n=600):
    rnd = random.Random(seed)
    sources = ["a", "B", "é", "zz", "\U0001F600", None]
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 3, 20, 60])), "a" if i % 3 == 0 else rnd.choice(sources)) for i in range(n)]
    return [*rows, (9001, None, "a"), (9002, "", None), (9003, "x y", "tiny"), (9004, " \n\t", "only empty"), (None, "no id", "a"),
            rows[5], rows[5]]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken(spark, seed):
    rows = corpus(seed)
    mix = mixing.plan(frame(spark, rows))
    got = mixing.decided(mix).toPandas()
    size = [len((t or "").split()) for _, t, _ in rows]
    per = {}
    for (_, _, s), n in zip(rows, size, strict=True):
        per[s] = per.get(s, 0) + n
    assert len(got) == len(rows) and sorted(got["size"]) == sorted(size)
    target = water_fill(per)
    for s, part in got.groupby(got["source"].where(got["source"].notna(), None), dropna=False):
        s = None if s != s else s
        assert (part["source_size"] == per[s]).all()
        assert part["target"].iloc[0] == pytest.approx(target[s])
        assert abs(part["taken"].sum() - target[s]) <= part["size"].max()
    assert ((got["taken"] <= 3 * got["size"]) & (got["taken"] % got["size"].clip(lower=1) == 0)).all()
    assert got["taken"].sum() <= sum(size)
    again = mixing.decided(mixing.plan(frame(spark, rows).repartition(7))).toPandas()
    order = ["id", "size", "taken"]
    assert got[order].sort_values(order).reset_index(drop=True).equals(again[order].sort_values(order).reset_index(drop=True))


def test_mix_is_a_prefix_in_virtual_time(spark):
    mix = mixing.plan(frame(spark, corpus(3)))
    queue = mix.queue.toPandas().sort_values(["finish", "s_rank", "epoch", "key"])
    assert queue["taken"].tolist() == sorted(queue["taken"], reverse=True)
    order = mixing.mixed_order(mix).toPandas()
    assert order["finish"].is_monotonic_increasing and len(order) == queue["taken"].sum()


def test_take_documents_repeats_them_with_their_columns(spark):
    docs = frame(spark, corpus(4))
    mix = mixing.plan(docs)
    got = mixing.take_documents(docs, mix)
    assert got.columns == docs.columns
    words = mixing.decided(mix).groupBy().sum("taken").first()[0]
    assert sum(len((r["text"] or "").split()) for r in got.collect()) == words


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (2, "", None)]])
def test_nothing_to_mix(spark, rows):
    got = mixing.decided(mixing.plan(frame(spark, rows))).collect()
    assert len(got) == len(rows) and all(r["taken"] == 0 and r["target"] == 0 for r in got)
