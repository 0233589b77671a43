"""Operator 8: blocks of any size against a plain split at the separator, and counts against the tokenizer."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import tokencount as C
from ledgerline.llm import tokens
from ledgerline.plans.lineage import cut

SEP = 9


def brute(files):
    out = []
    for file, ids in files.items():
        start, ordinal = 0, 0
        for i, x in enumerate(ids):
            if x == SEP:
                out.append((file, ordinal, start, i - start, True))
                start, ordinal = i + 1, ordinal + 1
        if start < len(ids):
            out.append((file, ordinal, start, len(ids) - start, False))
    return sorted(out)


@pytest.mark.parametrize(("block", "run"), [(1, 2), (4, 3), (7, 1000), (1000, 2)])
def test_blocks_are_stitched(spark, monkeypatch, block, run):
    monkeypatch.setattr(C, "RUN_BLOCKS", run)
    rnd = random.Random(block)
    files = {f: [rnd.choice([1, 2, 3, SEP] if f % 2 else [1, 2, 3, 4, 5, 6, 7, SEP]) for _ in range(rnd.randint(0, 90))] for f in range(6)}
    files |= {10: [1] * 50, 11: [SEP] * 20, 12: [1] * 30 + [SEP] + [2] * 30 + [SEP], 13: []}
    rows = [(f, k, np.array(ids[at:at + block], "<u2").tobytes()) for f, ids in files.items()
            for k, at in enumerate(range(0, max(len(ids), 1), block))]
    rnd.shuffle(rows)
    found = cut(C.separators(spark.createDataFrame(rows, "file long, block long, data binary"), SEP))
    assert sorted(tuple(r) for r in C.counts(found).collect()) == brute(files)


def test_plain_files(spark, tmp_path):
    data = {f"f{i}.bin": [1, 2, SEP, 3] * i for i in (1, 5)}
    for name, ids in data.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u4").tobytes())
    blocks = C.read_flat(spark, str(tmp_path), width=4, block_ids=3)
    found = cut(C.separators(blocks, SEP, "<u4"))
    got = sorted((r["start"], r["n_tokens"], r["closed"]) for r in C.counts(found).collect())
    assert got == sorted(x[2:] for x in brute(dict(enumerate(data.values()))))


def test_counts_are_the_tokenizers(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choices(["The", "cat", "sat.", "été", "123"], k=rnd.randint(0, 300)))) for i in range(80)]
    rows += [(500, None), (501, ""), (502, "x " * 100_000), (3, rows[3][1]), (None, "no id")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, FILE int, start int").repartition(3)
    t = Tokenizer.from_file(tokens.tokenizer_path())
    want = sorted((str(i), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in rows)
    got = C.count_documents(df).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == want
    for file in {r["file"] for r in got}:  # documents lie side by side, one separator between them
        at = 0
        for r in sorted((r for r in got if r["file"] == file), key=lambda r: r["ordinal"]):
            assert r["start"] == at
            at += r["n_tokens"] + 1


def test_special_strings_are_tokens(spark):
    texts = ["a<|endoftext|>b <|startoftext|> c", "<|endoftext|><|endoftext|>", "<|endoftext|>", "plain", "<|endof text|>"]
    t = Tokenizer.from_file(tokens.tokenizer_path())
    assert max(t.get_vocab().values()) < C.SEPARATOR < 1 << 16
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["n_tokens"] for r in C.count_documents(df).collect()}
    assert got == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)}


def test_empty_table(spark):
    assert C.count_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("kind", ["string", "int", "date"])
def test_ids_of_any_type(spark, kind):
    ids = {"string": "CAST(id AS string)", "int": "CAST(id AS int)", "date": "date_add(DATE'2020-01-01', CAST(id AS int))"}
    df = spark.range(40).selectExpr(f"{ids[kind]} AS doc_id", "repeat('word ', CAST(id AS int)) AS text").repartition(3)
    got = C.count_documents(df)
    assert got.schema["doc_id"].dataType.simpleString() == kind
    assert sorted(r["n_tokens"] for r in got.collect()) == list(range(40))
