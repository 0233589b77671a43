"""Chat formatting: linking of tool calls (operator 3, DataFrame operations only).

Method.  Calls and results are joined by conversation and call id (a hash
or sort join; the id is part of the key, so a conversation that holds a
third of all rows is spread over the tasks).  Arguments are parsed as JSON
and validated against the parameters of the tool's schema: a parameter that
is required must be there, one that is there must be declared and have the
declared type.  Calls are ordered so that each follows the calls it depends
on: the level of a call is one more than that of the deepest of these.  Chains
of calls that need one other each are shortened by doubling their pointers;
the calls that need several are placed in rounds, those whose needs are all
met in each, and each round reads what is still open only.  Every message, call and result becomes one line of canonical JSON (keys sorted at
every depth, no white space), and (conversation, turn, level, kind, call id)
sorts a conversation into an order in which nothing comes before what it
depends on.

``messages_of`` reads calls and results from chat messages: an assistant
message that is a JSON object with ``tool_calls`` (``id``, ``name``,
``arguments``, optional ``after``: ids it depends on), and a tool message
that is a JSON object with ``tool_call_id`` and ``content``.

Text beside the calls of a message is a message of its own; an empty list of
calls makes an ordinary message: there is a line for every message.

Cases: a call without result, a result without call, a repeated id (its nth
result by turn belongs to its nth call, the rest is reported; what depends
on the id comes after all of its calls), arguments
that are not a JSON object, a tool without schema, an unknown dependency
(counts as met, is reported) and a circle of dependencies (level null,
reported) each get their status; a message that is null or not JSON is an
ordinary message; a null conversation is a conversation of its own; a null
id links with nothing; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.plans.lineage import cut

#: Turns of one id that are numbered together.
RUN_TURNS = 1024
CALLS = "array<struct<id: string, name: string, arguments: string, after: array<string>>>"
#: JSON type names and the variant types that they allow (fixed values).
JSON_TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DECIMAL", "DOUBLE", "FLOAT"],
              "boolean": ["BOOLEAN"], "object": ["OBJECT"], "array": ["ARRAY"], "null": ["VOID"]}


def canonical(json: Column) -> Column:
    """Canonical text of a JSON value: sorted keys, no white space; null if it is none."""
    return F.to_json(F.try_parse_json(json))


def messages_of(chat: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Plain messages (conv, turn, role, text), calls (conv, turn, call_id, name, arguments, after) and results
    (conv, turn, call_id, content) of chat messages."""
    rows = chat.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                       F.col(text).alias("text"))
    json = F.when(F.col("text").rlike(r"^\s*\{"), F.col("text"))
    rows = rows.withColumn("calls", F.when(F.col("role") == "assistant",
                                           F.from_json(json, f"tool_calls {CALLS}")["tool_calls"])) \
        .withColumn("result_of", F.when(F.col("role") == "tool", F.get_json_object(json, "$.tool_call_id")))
    plain = rows.where("coalesce(size(calls), 0) < 1 AND result_of IS NULL").select("conv", "turn", "role", "text")
    # what a calling message says beside its calls
    said = rows.where("size(calls) > 0").select("conv", "turn", "role", F.get_json_object("text", "$.content").alias("text")) \
        .where("text IS NOT NULL")
    plain = plain.union(said)
    calls = rows.where("calls IS NOT NULL").select("conv", "turn", F.explode("calls").alias("c")) \
        .select("conv", "turn", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"),
                F.col("c.arguments").alias("arguments"), F.col("c.after").alias("after"))
    results = rows.where("result_of IS NOT NULL").select(
        "conv", "turn", F.col("result_of").alias("call_id"), F.get_json_object("text", "$.content").alias("content"))
    return plain, calls, results


def problems(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls`` with ``problems``: what is wrong with the arguments, sorted.

    ``schemas``: one row per tool (name, parameters: map of parameter name to
    struct(type, required)); it is small but joined like any other table.
    """
    known = schemas.select(F.col("name").alias("s_name"), "parameters")
    rows = calls.join(known, F.col("name") == F.col("s_name"), "left")
    # each is parsed once per row: columns of their own, not expressions inside the loops over keys
    rows = rows.withColumn("_kind", F.regexp_replace(F.schema_of_variant(F.try_parse_json("arguments")), r"[<(].*", ""))
    rows = rows.withColumn("_given", F.when(F.col("_kind") == "OBJECT", F.from_json("arguments", "map<string, string>")))
    # types come from the parsed value: text parsed again on its own is no string, so quoted values are told apart
    types = F.transform_values(F.from_json("arguments", "map<string, variant>"),
                               lambda k, v: F.regexp_replace(F.schema_of_variant(v), r"[<(].*", ""))
    rows = rows.withColumn("_types", F.when(F.col("_kind") == "OBJECT", types))
    kind, given, typed = F.col("_kind"), F.map_keys("_given"), F.col("_types")
    allowed = F.create_map(*[x for t, v in JSON_TYPES.items() for x in (F.lit(t), F.array(*map(F.lit, v)))])
    declared = F.coalesce("parameters", F.map_from_arrays(F.array(), F.array()).cast(
        "map<string, struct<type: string, required: boolean>>"))
    missing = F.filter(F.map_keys(declared), lambda p: F.element_at(declared, p)["required"] & ~F.array_contains(given, p))
    unknown = F.filter(given, lambda p: ~F.map_contains_key(declared, p))
    wrong = F.filter(given, lambda p: F.map_contains_key(declared, p) & ~F.array_contains(
        F.element_at(allowed, F.element_at(declared, p)["type"]), F.element_at(typed, p)))
    named = lambda found, what: F.transform(found, lambda p: F.concat(F.lit(what), p))
    found = F.when(kind.isNull() | (kind != "OBJECT"), F.array(F.lit("arguments are no object"))) \
        .when(F.col("s_name").isNull(), F.array(F.lit("unknown tool"))) \
        .otherwise(F.array_sort(F.concat(named(missing, "missing "), named(unknown, "undeclared "), named(wrong, "type of "))))
    return rows.withColumn("problems", found).drop("s_name", "parameters", "_kind", "_given", "_types")


def group_name(conv: Column, call_id: Column) -> Column:
    """Names the calls of one id in one conversation; null for a null id."""
    return F.md5(F.concat(F.coalesce(F.concat(F.lit("c"), conv.cast("string")), F.lit("n")), F.lit(":"), call_id))


def chain_ends(steps: DataFrame) -> DataFrame:
    """g, stop, far of every step (g, to) of chains, one step per g: where its chain ends and how many steps away.

    Pointers are doubled, so a chain of d steps costs log2(d) rounds; ``stop``
    is null for what runs into a circle.
    """
    at = cut(steps.select("g", F.col("to").alias("stop"), F.lit(1).cast("long").alias("far")), "chain")
    n, longest, done = at.count(), 1, []
    todo = at
    while n and longest <= 2 * n:
        onward = at.select(F.col("g").alias("o_g"), F.col("stop").alias("o_stop"), F.col("far").alias("o_far"))
        both = cut(todo.join(onward, F.col("stop") == F.col("o_g"), "left"), "chain")
        done.append(both.where("o_g IS NULL").select("g", "stop", "far"))
        moved = both.where("o_g IS NOT NULL").select("g", F.col("o_stop").alias("stop"), (F.col("far") + F.col("o_far")).alias("far"))
        if not moved.limit(1).count():
            todo = None
            break
        # the pointers of the next round: those that moved, and those at their end
        todo = moved
        at = cut(both.select("g", F.coalesce("o_stop", "stop").alias("stop"),
                             (F.col("far") + F.coalesce("o_far", F.lit(0))).alias("far"))
                 .union(at.join(both.select("g"), "g", "left_anti")), "chain")
        longest *= 2
    out = at.limit(0)
    for part in done:
        out = out.union(part)
    if todo is not None and n:
        out = out.union(todo.select("g", F.lit(None).cast("string").alias("stop"), "far"))
    return out


def group_levels(edges: DataFrame) -> DataFrame:
    """g, level of every g of the distinct edges (g, to; a cut): 1 more than the deepest ``to``, null in or behind circles.

    What has no edges is at level 0 and not returned.  Groups with one edge
    are chains; the groups with several, and only they, are placed in rounds.
    """
    many = edges.groupBy("g").agg(F.count("*").alias("n"))
    single = edges.join(many.where("n = 1").select("g"), "g")
    ends = cut(chain_ends(single), "chain-ends")
    joints = cut(many.where("n > 1").select("g", F.lit(0).cast("long").alias("level")), "joints")
    out = []
    if joints.limit(1).count():
        e = ends.select(F.col("g").alias("e_g"), "stop", "far")
        needs = edges.join(joints.select("g"), "g").join(e, F.col("to") == F.col("e_g"), "left").select(
            "g", F.when(F.col("e_g").isNull(), F.col("to")).otherwise(F.col("stop")).alias("to"),
            (F.coalesce("far", F.lit(0)) + 1).alias("more"))
        # an end that is no joint is at level 0, a circle is never reached
        top = joints.select(F.col("g").alias("to"), F.lit(True).alias("joint"))
        needs = cut(needs.join(top, "to", "left"), "joint-needs")
        base = needs.where("to IS NOT NULL AND joint IS NULL").groupBy("g").agg(F.max("more").alias("base"))
        waiting = cut(joints.join(base, "g", "left").select("g", F.coalesce("base", "level").alias("level")), "joints")
        open_needs = cut(needs.where("to IS NULL OR joint").select("g", "to", "more"), "joint-needs")
        while True:
            now = cut(waiting.join(open_needs.select("g").distinct(), "g", "left_anti"), "placed")
            if not now.limit(1).count():
                break
            out.append(now)
            reached = now.select(F.col("g").alias("to"), F.col("level").alias("reached"))
            given = open_needs.join(reached, "to").groupBy("g").agg(F.max(F.col("reached") + F.col("more")).alias("given"))
            waiting = cut(waiting.join(now.select("g"), "g", "left_anti").join(given, "g", "left")
                          .select("g", F.greatest("level", "given").alias("level")), "joints")
            open_needs = cut(open_needs.join(reached, "to", "left_anti").select("g", "to", "more"), "joint-needs")
        out.append(waiting.select("g", F.lit(None).cast("long").alias("level")))
    placed = joints.limit(0)
    for part in out:
        placed = placed.union(part)
    placed = cut(placed, "placed")
    # a chain goes on from where it ends: a joint, a circle (null), or level 0
    p = placed.select(F.col("g").alias("p_g"), "level")
    chains = ends.join(p, F.col("stop") == F.col("p_g"), "left").select(
        "g", F.when(F.col("stop").isNotNull(), F.when(F.col("p_g").isNull(), F.col("far")).otherwise(F.col("level") + F.col("far")))
        .alias("level"))
    return placed.union(chains)


def levels(calls: DataFrame) -> DataFrame:
    """``calls`` with ``level`` (0: depends on nothing; null: in or behind a circle) and ``unmet`` (unknown ids).

    The calls of one id are one group: what needs the id comes after all of them.
    """
    calls = cut(calls.withColumn("row", F.monotonically_increasing_id())
                .withColumn("g", group_name(F.col("conv"), F.col("call_id"))), "calls")
    needs = calls.select("row", "conv", "g", F.explode(F.array_distinct("after")).alias("need")).where("need IS NOT NULL") \
        .withColumn("to", group_name(F.col("conv"), F.col("need")))
    known = calls.where("g IS NOT NULL").select(F.col("g").alias("to"), F.lit(True).alias("known")).distinct()
    needs = cut(needs.join(known, "to", "left"), "needs")
    unmet = needs.where("known IS NULL").groupBy("row").agg(F.array_sort(F.collect_set("need")).alias("unmet"))
    edges = cut(needs.where("known AND g IS NOT NULL").select("g", "to").distinct(), "edges")
    deep = group_levels(edges).select(F.col("g").alias("to"), "level", F.lit(True).alias("deep"))
    own = needs.where("known").join(deep, "to", "left").groupBy("row").agg(
        F.bool_or(F.col("deep").isNotNull() & F.col("level").isNull()).alias("circle"),
        (F.max(F.coalesce("level", F.lit(0))) + 1).alias("placed"))
    return calls.join(own, "row", "left").join(unmet, "row", "left") \
        .withColumn("level", F.when(F.col("circle").isNull(), 0).when(~F.col("circle"), F.col("placed")).cast("int")) \
        .withColumn("unmet", F.coalesce("unmet", F.array().cast("array<string>"))).drop("row", "g", "circle", "placed")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``nth``: their place among the rows of their conversation and call id, by turn.

    Counted in runs of ``RUN_TURNS`` turns first, so an id that holds many rows is many small windows.
    """
    rows = rows.withColumn("_run", F.coalesce(F.floor(F.col("turn") / RUN_TURNS), F.lit(-1)))
    inside = F.row_number().over(Window.partitionBy("conv", "call_id", "_run").orderBy("turn", *order))
    runs = rows.groupBy("conv", "call_id", "_run").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("conv", "call_id").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("conv").alias("_conv"), F.col("call_id").alias("_id"), F.col("_run").alias("_r"),
                       F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.withColumn("_in", inside).join(
        runs, F.col("conv").eqNullSafe(F.col("_conv")) & F.col("call_id").eqNullSafe(F.col("_id")) & (F.col("_run") == F.col("_r"))) \
        .withColumn("nth", F.col("_in") + F.col("_before")).drop("_run", "_in", "_conv", "_id", "_r", "_before")


def linked(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """Calls with their results: conv, turn, call_id, name, arguments, level, problems, result_turn, content, status.

    The nth result of an id, by turn, belongs to the nth call of it.
    """
    checked = numbered(cut(levels(problems(calls, schemas)), "checked-calls"), "name", "arguments")
    r = numbered(results, "content").select(F.col("conv").alias("r_conv"), F.col("turn").alias("result_turn"),
                                            F.col("call_id").alias("r_id"), "content", F.col("nth").alias("r_nth"))
    both = checked.join(r, F.col("conv").eqNullSafe(F.col("r_conv")) & (F.col("call_id") == F.col("r_id"))
                        & (F.col("nth") == F.col("r_nth")), "full")
    is_result = F.col("nth").isNull()
    return both.select(F.when(is_result, F.col("r_conv")).otherwise(F.col("conv")).alias("conv"),
                       F.when(is_result, F.col("result_turn")).otherwise(F.col("turn")).alias("turn"),
                       F.coalesce("call_id", "r_id").alias("call_id"), "name", "arguments", "level", "problems", "unmet",
                       "result_turn", "content", F.when(is_result, F.lit("result without call"))
                       .when(F.col("r_nth").isNull(), F.lit("call without result"))
                       .when(F.col("level").isNull(), F.lit("circle"))
                       .when(F.col("result_turn") < F.col("turn"), F.lit("result before call"))
                       .when((F.size("problems") > 0) | (F.size("unmet") > 0), F.lit("invalid")).otherwise(F.lit("ok")).alias("status"))


def lines(plain: DataFrame, links: DataFrame) -> DataFrame:
    """One line of canonical JSON per message and per linked call: conv, turn, level, call_id, kind, status, line."""
    messages = plain.select("conv", "turn", F.lit(0).alias("level"), F.lit(None).cast("string").alias("call_id"),
                            F.lit("message").alias("kind"), F.lit("ok").alias("status"),
                            canonical(F.to_json(F.struct(F.col("text").alias("content"), "role"),
                                                {"ignoreNullFields": "false"})).alias("line"))
    arguments = F.coalesce(canonical(F.col("arguments")), F.lit("null"))
    calls = links.select("conv", "turn", "level", "call_id", F.lit("call").alias("kind"), "status", F.concat(
        F.lit('{"arguments":'), arguments, F.lit(","),
        F.substring(F.to_json(F.struct(F.col("content"), F.col("call_id").alias("id"), "name", "status",
                                       F.array_sort(F.concat(F.coalesce("problems", F.array().cast("array<string>")), F.transform(
                                           F.coalesce("unmet", F.array().cast("array<string>")),
                                           lambda x: F.concat(F.lit("unknown dependency "), x)))).alias("trouble")),
                              {"ignoreNullFields": "false"}), 2, 2147483647)).alias("line"))
    return messages.union(calls)


def format_chats(chat: DataFrame, schemas: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """All messages of a chat table as ordered, linked, validated canonical lines."""
    plain, calls, results = messages_of(chat, conv, turn, role, text)
    return lines(plain, linked(calls, results, schemas)).orderBy("conv", "turn", "level", "kind", "call_id", "line")
