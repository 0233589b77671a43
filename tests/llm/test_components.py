"""Connected components: one task, many tasks, chains, stars, other key types."""

import random

import pytest

from ledgerline.llm import components as C


def brute(edges):
    up = {}

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return sorted((x, root(x)) for x in {x for e in edges if None not in e and e[0] != e[1] for x in e})


@pytest.mark.parametrize("task_edges", [200_000, 40])
def test_equals_union_find(spark, monkeypatch, task_edges):
    monkeypatch.setattr(C, "TASK_EDGES", task_edges)
    rnd = random.Random(7)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(60)] + [(5, 5), (None, 3)]
    got = C.components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(tuple(r) for r in got.collect()) == brute(edges)


def test_binary_names_and_no_edges(spark):
    got = C.components(spark.createDataFrame([(b"z", b"a"), (b"b", b"z")], "a binary, b binary"))
    assert sorted((bytes(x), bytes(y)) for x, y in got.collect()) == [(b"a", b"a"), (b"b", b"a"), (b"z", b"a")]
    assert C.components(spark.createDataFrame([], "a long, b long")).collect() == []
