"""Operator 3: linking, order, validation and canonical lines on hand-made chats (the query itself has SQL)."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import toolcalls as T

TOOLS = {"search": {"query": ("string", True), "limit": ("integer", False)},
         "mixed": {"a": ("number", False), "b": ("boolean", False), "c": ("object", False), "d": ("array", False)}}


def schemas(spark):
    return spark.createDataFrame(
        [(n, {k: (t, r) for k, (t, r) in p.items()}) for n, p in TOOLS.items()],
        "name string, parameters map<string, struct<type: string, required: boolean>>")


def call(i, name="search", arguments='{"query": "x"}', after=None):
    return {"id": i, "name": name, "arguments": arguments} | ({"after": after} if after else {})


def chat(spark, rows):
    return spark.createDataFrame([(c, t, r, x if x is None or isinstance(x, str) else json.dumps(x), "extra") for c, t, r, x in rows],
                                 "conv_id long, turn long, role string, text string, LINE string")


def lines(spark, rows):
    return [(r["conv"], r["turn"], r["level"], r["kind"], r["status"], json.loads(r["line"]))
            for r in T.format_chats(chat(spark, rows), schemas(spark)).collect()]


def test_messages_calls_and_results(spark):
    got = lines(spark, [
        (1, 0, "user", "hi \"you\" é\n"), (1, 1, "assistant", {"tool_calls": [call("a"), call("b", after=["a"]), call("c", after=["b", "a"])]}),
        (1, 2, "tool", {"tool_call_id": "a", "content": "found"}), (1, 3, "tool", {"tool_call_id": "zz", "content": "lost"}),
        (2, 0, "assistant", {"tool_calls": [call("a")]}), (1, 4, None, None), (None, 0, "user", "{not json"), (3, 0, "assistant", "{}"),
    ])
    by = {(c, x.get("id", t)): (lvl, status, x) for c, t, lvl, _, status, x in got}
    assert by[1, 0][2] == {"content": "hi \"you\" é\n", "role": "user"} and by[1, 4][2] == {"content": None, "role": None}
    assert by[1, "a"] == (0, "ok", {"arguments": {"query": "x"}, "content": "found", "id": "a", "name": "search", "status": "ok", "trouble": []})
    assert [by[1, i][:2] for i in "bc"] == [(1, "call without result"), (2, "call without result")]
    assert by[1, "zz"][1] == "result without call" and by[2, "a"][1] == "call without result"
    assert by[None, 0][2]["content"] == "{not json" and by[3, 0][2]["content"] == "{}"
    order = [(c, x.get("id")) for c, t, *_, x in got if c == 1 and t == 1]
    assert order == [(1, "a"), (1, "b"), (1, "c")]


@pytest.mark.parametrize(("name", "arguments", "want"), [
    ("search", '{"query": "x", "limit": 3}', []), ("search", '{"limit": 3}', ["missing query"]),
    ("search", '{"query": 5}', ["type of query"]), ("search", '{"query": "5"}', []),
    ("search", '{"query": "x", "more": 1}', ["undeclared more"]), ("search", '{"query": "x", "limit": 2.5}', ["type of limit"]),
    ("search", '{"query": null}', ["type of query"]), ("search", "[1]", ["arguments are no object"]),
    ("search", "no json", ["arguments are no object"]), ("search", None, ["arguments are no object"]),
    ("nothing", "{}", ["unknown tool"]), ("mixed", '{"a": 1.5, "b": true, "c": {"x": 1}, "d": []}', []),
    ("mixed", '{"a": "1", "b": 0, "c": [], "d": {}}', ["type of a", "type of b", "type of c", "type of d"]), ("mixed", "{}", [])])
def test_validation(spark, name, arguments, want):
    df = spark.createDataFrame([(name, arguments)], "name string, arguments string")
    assert T.problems(df, schemas(spark)).first()["problems"] == want


def test_canonical_json(spark):
    rows = [('{"b": 1, "a": {"d": [1, {"z": 0, "y": "é\\n"}], "c": null}}', '{"a":{"c":null,"d":[1,{"y":"é\\n","z":0}]},"b":1}'),
            (" [ 1 , 2 ] ", "[1,2]"), ("{", None), (None, None)]
    df = spark.createDataFrame([(x,) for x, _ in rows], "j string").select(T.canonical(F.col("j")).alias("c"))
    assert [r["c"] for r in df.collect()] == [w for _, w in rows]


def test_levels_circles_and_unknown(spark):
    rows = [(1, f"n{i}", [f"n{i - 1}"] if i else None) for i in range(7)]          # a chain
    rows += [(1, "x", ["y"]), (1, "y", ["x"]), (1, "z", ["x"]), (1, "u", ["gone"]), (1, "self", ["self"]), (1, None, ["n0"])]
    rows += [(2, "n1", ["n0"]), (None, "p", None), (None, "q", ["p"]), (3, "d", None), (3, "d", ["e"]), (3, "e", None), (3, "f", ["d"])]
    df = spark.createDataFrame(rows, "conv long, call_id string, after array<string>")
    got = {}
    for r in T.levels(df).collect():
        got.setdefault((r["conv"], r["call_id"]), []).append((r["level"], r["unmet"]))
    assert [got[1, f"n{i}"][0][0] for i in range(7)] == list(range(7))
    assert all(got[1, k][0][0] is None for k in ("x", "y", "z", "self"))
    assert got[1, "u"] == [(0, ["gone"])] and got[1, None] == [(1, [])] and got[2, "n1"] == [(0, ["n0"])]
    assert got[None, "q"][0][0] == 1
    assert sorted(got[3, "d"]) == [(0, []), (1, [])] and got[3, "f"] == [(2, [])]  # after every call of that id


def test_repeated_ids_and_empty_tables(spark):
    """The nth result of an id belongs to its nth call; the surplus is reported."""
    result = lambda turn, x: (1, turn, "tool", {"tool_call_id": "a", "content": x})
    got = lines(spark, [(1, 0, "assistant", {"tool_calls": [call("a", arguments='{"query": "1"}'), call("a", arguments='{"query": "2"}')]}),
                        result(1, "r1"), result(2, "r2"), result(2000, "r4"), result(3, "r3"),
                        (1, 2500, "assistant", {"tool_calls": [call("a", arguments='{"query": "3"}')]}), result(None, "r0")])
    assert sorted((x[5]["arguments"] or {}).get("query", "-") + x[5]["content"] + x[4] for x in got) == [
        "-r3result without call", "-r4result without call", "1r0ok", "2r1ok", "3r2result before call"]
    many = [(1, t, "assistant", {"tool_calls": [call("a")]}) for t in range(60)] + [result(100 + t, "r") for t in range(70)]
    got = lines(spark, many)
    assert len(got) == 70 and [x[4] for x in got].count("ok") == 60
    assert lines(spark, []) == []


def test_no_message_is_lost(spark):
    rows = [(1, 0, "assistant", {"tool_calls": [], "content": "hello"}),
            (1, 1, "assistant", {"tool_calls": [call("a")], "content": "let me see"}), (1, 2, "assistant", {"tool_calls": None}),
            (1, 3, "tool", {"tool_call_id": "a", "content": "x"}), (1, 4, "tool", "no json"), (1, 5, None, "hi"), (1, 6, "user", None)]
    got = lines(spark, rows)
    assert len(got) >= len(rows)
    assert [(t, json.loads(x["content"])["content"] if t == 0 else x["content"]) for _, t, _, kind, _, x in got
            if kind == "message" and t < 2] == [(0, "hello"), (1, "let me see")]


def brute_levels(calls):
    ids = {i for i, _ in calls if i is not None}
    level = [None] * len(calls)
    changed = True
    while changed:
        changed = False
        for k, (_, after) in enumerate(calls):
            if level[k] is None:
                needed = [level[j] for x in after if x in ids for j, (i, _) in enumerate(calls) if i == x]
                if None not in needed:
                    level[k], changed = max(needed, default=-1) + 1, True
    return level


@pytest.mark.parametrize("seed", range(4))
def test_levels_as_brute_force(spark, seed):
    """Chains, joints, circles and repeated ids, mixed."""
    rng = random.Random(seed)
    calls = [(rng.choice([f"i{k}", f"i{k}", f"i{k // 2}", None]) if k else "i0",
              [f"i{max(0, k - rng.randrange(1, 4)) if rng.random() < .97 else rng.randrange(70)}" for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))])
             for k in range(60)]
    df = spark.createDataFrame([(None, k, i, after) for k, (i, after) in enumerate(calls)],
                               "conv long, k int, call_id string, after array<string>")
    got = {r["k"]: r["level"] for r in T.levels(df.repartition(3)).collect()}
    assert [got[k] for k in range(60)] == brute_levels(calls)


def test_long_chain_costs_few_jobs(spark):
    rows = [(1, f"n{i}", [f"n{i - 1}"] if i else []) for i in range(200)]
    df = spark.createDataFrame(rows, "conv long, call_id string, after array<string>")
    sc = spark.sparkContext
    sc.setJobGroup("chain", "chain")
    got = {r["call_id"]: r["level"] for r in T.levels(df).collect()}
    jobs = len(sc.statusTracker().getJobIdsForGroup("chain"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert got == {f"n{i}": i for i in range(200)} and jobs < 150


def test_no_python_in_the_plan(spark):
    plan = T.format_chats(chat(spark, [(1, 0, "user", "x")]), schemas(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
