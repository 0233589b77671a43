"""Mixing sources to target weights by weighted fair queueing (operator 5, DataFrame operations only).

Method.  Each source is a queue of its documents in shuffled order (MD5 of
the id), up to ``max_epochs`` times over.  A queued copy's virtual finish
time is the cumulative size of its source up to and with it, divided by the
source's target; all copies are sorted by finish time and the mix is the
longest prefix within the total budget.  Every source then stops at virtual
time 1 or next to it, that is, within a document of its target.

Targets: sources by code point, null last, get the weights in turn; a
target is its weight's share of the total size but stops at ``max_epochs``
times the source's size, and the excess is shared again among the others
(the level at which no target is above is found from one running sum over
the sources in the order in which they reach their limit).

At scale: sizes are read once and kept as a narrow table.  Running sums do
not use one window per source or one over all: a source is split into
``BUCKETS`` by the leading hex digits of the shuffle key, and virtual time
into ``TIME_BUCKETS``; totals per bucket are summed with partial
aggregation and give each bucket its offset.  The decision comes down to
one row per source -- for each epoch the last shuffle key taken -- so the
texts themselves are never shuffled.

Cases: null or empty text has size 0 and is never taken; a null source is a
source of its own, the last; documents with the same id and text share a
shuffle key and one decision; a null id is shuffled as an empty id; no
documents give no rows; other columns are kept as they are by
``take_documents`` and not read by ``plan``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.util import broadcast_if_small, fresh_name, word_count
from ledgerline.plans.lineage import cut

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKET_DIGITS = 3  # 16**3 buckets a source
TIME_BUCKETS = 8192


@dataclass
class Mix:
    """``sized``: id, source, size, key of every document; ``sources``: one row per source with target and cut-offs;
    ``queue``: the copies with their finish time, and whether they are taken."""
    sized: DataFrame
    sources: DataFrame
    queue: DataFrame


def shuffle_key(doc_id: Column, text: Column) -> Column:
    return F.concat(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), F.md5(F.coalesce(text, F.lit(""))))


def targets(sized: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """source, s_rank, source_size, target."""
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_turn = F.element_at(F.array(*[F.lit(w) for w in weights]),
                           (F.pmod(F.col("s_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per_source.withColumn("s_rank", F.row_number().over(by_name)).withColumn("weight", in_turn) \
        .withColumn("limit", max_epochs * F.col("source_size"))
    fill = ranked.withColumn("reach", F.col("limit") / F.col("weight"))
    by_reach = Window.orderBy("reach", "s_rank")
    earlier = by_reach.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_reach.rowsBetween(0, Window.unboundedFollowing)
    everything = by_reach.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(earlier), F.lit(0))) \
        / F.sum("weight").over(onward)
    fill = fill.withColumn("level", level).withColumn("turn", F.row_number().over(by_reach))
    final = F.min(F.when(F.col("level") <= F.col("reach"), F.struct("turn", "level"))).over(everything)["level"]
    target = F.least(F.col("limit").cast("double"), F.col("weight") * F.col("final"))
    return fill.withColumn("final", final).select("source", "s_rank", "source_size", target.alias("target"))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source") -> Mix:
    sized = cut(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        shuffle_key(F.col(id_col), F.col(text_col)).alias("key")), "mix-sizes")
    sources = cut(targets(sized, weights, max_epochs), "mix-sources")
    small = broadcast_if_small(sources)

    # cumulative size of each document in its source's queue
    queued = sized.where("size > 0").withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    sums = queued.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"),
                       F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, 0)
    queued = queued.withColumn("upto", F.sum("size").over(inside)) \
        .join(sums, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket"))) \
        .select("source", "size", "key", (F.col("upto") + F.col("before")).alias("upto"))

    # every copy that starts before virtual time 1, with its finish time
    s = small.select(F.col("source").alias("s_source"), "s_rank", "source_size", "target")
    copies = queued.join(s, F.col("source").eqNullSafe(F.col("s_source"))) \
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1)))) \
        .withColumn("upto", F.col("upto") + F.col("epoch") * F.col("source_size")) \
        .where(F.col("upto") - F.col("size") < F.col("target")) \
        .select("source", "s_rank", "epoch", "key", "size", (F.col("upto") / F.col("target")).alias("finish"))
    copies = cut(copies.withColumn("slot", F.least(F.floor(F.col("finish") * TIME_BUCKETS), F.lit(TIME_BUCKETS))),
                 "mix-copies")

    # running total in the order of finish times, and the prefix within the budget
    slots = copies.groupBy("slot").agg(F.sum("size").alias("n"))
    up_to_slot = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select("slot", F.coalesce(F.sum("n").over(up_to_slot), F.lit(0)).alias("before"))
    order = ["finish", "s_rank", "epoch", "key"]
    in_slot = Window.partitionBy("slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    budget = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    queue = copies.withColumn("upto", F.sum("size").over(in_slot)).join(F.broadcast(slots), "slot") \
        .withColumn("taken", F.col("upto") + F.col("before") <= F.lit(budget)) \
        .select("source", "s_rank", "epoch", "key", "size", "finish", "taken")

    last = queue.where("taken").groupBy("source", "epoch").agg(F.max("key").alias("last"))
    last = last.groupBy(F.col("source").alias("l_source")).agg(F.collect_list("last").alias("last"))
    decided = cut(sources.join(last, F.col("source").eqNullSafe(F.col("l_source")), "left").drop("l_source"),
                  "mix-decisions")
    return Mix(sized, decided, queue)


def epochs_taken(key: Column, size: Column, last: Column) -> Column:
    """How many times the mix takes a document, from its source's cut-offs."""
    taken = F.size(F.filter(F.coalesce(last, F.array().cast("array<string>")), lambda x: x >= key))
    return F.when(size > 0, taken).otherwise(0)


def decided(mix: Mix) -> DataFrame:
    """Every document with its source's size and target and the words the mix takes of it."""
    s = broadcast_if_small(mix.sources).select(F.col("source").alias("s_source"), "source_size", "target", "last")
    return mix.sized.join(s, F.col("source").eqNullSafe(F.col("s_source")), "left").select(
        "id", "source", "size", "source_size", "target",
        (epochs_taken(F.col("key"), F.col("size"), F.col("last")) * F.col("size")).alias("taken"))


def mixed_order(mix: Mix) -> DataFrame:
    """The copies the mix takes, globally sorted by finish time."""
    return mix.queue.where("taken").orderBy("finish", "s_rank", "epoch", "key")


def take_documents(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source") -> DataFrame:
    """The documents of the mix with their columns, each as often as it is taken."""
    names = [fresh_name(docs.columns, f"_mix_{x}") for x in ("source", "last", "epoch")]
    s = broadcast_if_small(mix.sources).select(F.col("source").alias(names[0]), F.col("last").alias(names[1]))
    times = epochs_taken(shuffle_key(F.col(id_col), F.col(text_col)), word_count(F.col(text_col)), F.col(names[1]))
    return docs.join(s, F.col(source_col).eqNullSafe(F.col(names[0])), "left") \
        .withColumn(names[2], times).where(F.col(names[2]) > 0) \
        .withColumn(names[2], F.explode(F.sequence(F.lit(1), F.col(names[2])))).select(*docs.columns)
