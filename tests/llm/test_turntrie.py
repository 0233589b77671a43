"""Operator 11 against a dictionary of all prefixes."""

import hashlib
import random
import re
import zlib

import pytest

from ledgerline.llm import turntrie as TT

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, depth int, key string"


def expected(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[-1] for t in sorted(v)] for c, v in convs.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = own.get(c - c % 20, [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            nodes.setdefault(tuple(whole[:d]), []).append((c, len(whole) == d))
    out = {}
    for key, members in nodes.items():
        below = [k for k in nodes if k[:len(key)] == key]
        kids = {k: len([1 for x in nodes if len(x) == len(k) + 1 and x[:len(k)] == k]) for k in below}
        ends = ",".join(map(str, sorted(c for c, end in members if end)))
        saved = sum((len(nodes[k]) - 1) * len(WORD.findall(k[-1][1])) for k in below if k)
        out[min(c for c, _ in members), len(key)] = (
            min(c for c, _ in nodes[key[:-1]]) if key else None, len(members), kids[key], sum(v == 0 for v in kids.values()),
            saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def result(spark, rows, **kw):
    found = TT.trie(spark.createDataFrame(rows, SCHEMA).repartition(3), **kw).collect()
    out = {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in found}
    assert len(out) == len(found)
    return out


def chat(seed, n=60, words=3, turns=6):
    rng = random.Random(seed)
    return [(c * rng.choice([1, 1, 3]) + 1000 * (c // 7), t if rng.random() > .1 else None, rng.choice(["u", "a", None, ""]),
             rng.choice([None, "", "hi", "a b  c", "x\ty", "é è"][:words + 2]), 1, "k")
            for c in range(n) for t in range(rng.randrange(turns + 1))]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("tile_bytes", [1, 700, TT.TILE_BYTES])
def test_as_prefix_dictionary(spark, seed, tile_bytes):
    """Ties, nulls, copies, prefixes of one another, with every key a tile of its own and with one tile."""
    rows = chat(seed)
    assert result(spark, rows, tile_bytes=tile_bytes) == expected(rows)


def test_hot_first_turn_and_copies(spark):
    rows = [(c, t, "u", "hello there" if t == 0 else f"w{c % 9 * t}", 0, "") for c in range(400) for t in range(4)]
    assert result(spark, rows, tile_bytes=900) == expected(rows)


def test_long_conversation(spark):
    rows = [(20, t, "u", f"turn {t}", 0, "") for t in range(1500)] + [(21, t, "u", f"turn {t}", 0, "") for t in range(1400)]
    found = result(spark, rows)
    assert len(found) == len({k for k in found}) and max(d for _, d in found) == 1500
    assert found[20, 0][1:4] == (2, 1, 1 if zlib.crc32(b"21") % 4 <= 1400 else 2)


def test_empty(spark):
    assert result(spark, []) == {}
    assert result(spark, [(None, 1, "u", "x", 0, "")]) == {}


def test_layouts_grow_and_keep_order():
    rng = random.Random(5)
    for n in (3, 16, 17, 48, 49, 256, 900):
        keys = {rng.randbytes(rng.randrange(1, 4)) for _ in range(n)} | {bytes([i]) for i in range(min(n, 256))}
        root = TT.Node(b"")
        for k in rng.sample(sorted(keys), len(keys)):
            TT.insert(root, k, k)
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node.value is not None:
                found.append(node.value)
            todo.extend(reversed(node.children()))
        assert found == sorted(keys)
        assert (root.index is None) == (len(root.children()) > 48)
