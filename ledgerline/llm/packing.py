"""Best-fit decreasing packing of documents into sequences (operator 10).

Method.  Best-fit decreasing puts the documents, longest first, each into
the open sequence with the least room that still takes it; a segment tree
over the remaining capacities finds that room in logarithmic time.  Lengths
are whole numbers up to the capacity, so documents of one length are alike
and so are sequences with the same room: the packing is decided on the
histogram of lengths, a table of at most ``capacity`` rows whatever the
input size.  ``plan_best_fit`` places a run of equal documents into a run
of equal sequences at a time and returns those runs; the result is that of
best-fit decreasing over all documents, not of a packing per partition.

On Spark: tokenizing maps each document to its pieces (one narrow row a
piece); lengths are counted with partial aggregation; each piece gets its
rank among the pieces of its length through counts per (length, hash bucket)
-- a length that a third of all pieces share is spread over ``RANK_BUCKETS``
windows -- and the rank finds the piece's run by binary search in the plan.

Cases: null or empty text is one piece holding just the closing id; only a
document longer than the capacity is cut, into full pieces and a rest;
repeated rows are packed one by one; no documents give no rows; columns
other than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import tokens
from ledgerline.llm.util import byte_rows, few_rows_at_once, row_groups
from ledgerline.plans.lineage import cut

RANK_BUCKETS = 1024


class CapacityTree:
    """Segment tree over remaining capacities 0..size-1: which capacities have open sequences."""

    def __init__(self, size: int):
        self.base = 1
        while self.base < size:
            self.base *= 2
        self.any = [False] * (2 * self.base)

    def put(self, capacity: int, is_open: bool) -> None:
        i = self.base + capacity
        self.any[i] = is_open
        while i > 1:
            i //= 2
            value = self.any[2 * i] or self.any[2 * i + 1]
            if self.any[i] == value:
                return
            self.any[i] = value

    def tightest(self, least: int) -> int:
        """The smallest capacity of at least ``least`` with an open sequence, or -1."""
        i = self.base + least
        if self.any[i]:
            return least
        while i > 1:  # up to the first ancestor with something open to the right
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                break
            i //= 2
        else:
            return -1
        while i < self.base:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.base


def plan_best_fit(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Runs (length, first rank, count, first sequence, offset) of best-fit decreasing.

    A document goes where the room is tightest, so documents of one length
    fill a sequence as far as it takes them before the next one is touched:
    a run of ``n`` sequences with the same room takes ``fit`` layers of ``n``.
    """
    tree = CapacityTree(capacity + 1)
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # remaining -> runs (first sequence, count)
    runs, opened = [], 0

    def leave(r: int, first: int, count: int) -> None:
        if r and count:
            if not room[r]:
                tree.put(r, True)
            room[r].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            r = tree.tightest(length)
            if r >= 0:
                first, count = room[r].pop()
                if not room[r]:
                    tree.put(r, False)
            else:
                r, first = capacity, opened
                count = -(-left // (capacity // length))
                opened += count
            fit = r // length
            n = min(count, left // fit)
            layers = fit
            if not n:  # fewer documents than one sequence takes
                n, layers = 1, left
            for k in range(layers):
                runs.append((length, rank + k * n, n, first, capacity - r + k * length))
            rank, left = rank + layers * n, left - layers * n
            leave(r - layers * length, first, n)
            if r < capacity:
                leave(r, first + n, count - n)
            else:  # new sequences: the ones not filled yet are not open
                opened = first + n
    return np.array(runs, dtype=np.int64).reshape(-1, 5)


def tokenized(docs: DataFrame, id_col: str, text_col: str, capacity: int, closing_id: int, path: str) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32."""
    def run(batches):
        cache = tokens.word_ids(path)
        for batch in row_groups(batches):
            out, ids = [], []
            texts = byte_rows(batch.column(1))
            for doc, packed in zip(batch.column(0).to_pylist(), tokens.encode_all(cache, texts, closing_id), strict=True):
                for row in tokens.pieces(packed, capacity):
                    ids.append(doc)
                    out.append(row)
            cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.column(0).type), pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                names=["id", "piece", "start", "length", "ids_crc32"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, piece int, start long, length long, ids_crc32 long")


def assign(parts: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to the pieces (a frame that can be read again without recomputing)."""
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_best_fit(histogram, capacity)
    sc = parts.sparkSession.sparkContext
    runs = sc.broadcast(plan)  # bounded by the capacity, not by the number of documents

    bucket = F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(RANK_BUCKETS)).cast("int")
    parts = parts.withColumn("bucket", bucket)
    sizes = parts.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("id", "piece", "start", "ids_crc32")
    ranked = parts.withColumn("rank", F.row_number().over(inside) - 1).join(starts, ["length", "bucket"]) \
        .select("id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))

    def place(batches):
        plan = runs.value
        shift = np.int64(1) << np.int64(48)  # length and rank as one sortable number
        keys = plan[:, 0] * shift + plan[:, 1]
        order = np.argsort(keys, kind="stable")
        keys, plan = keys[order], plan[order]
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length * shift + rank, side="right") - 1
            sequence = plan[at, 3] + rank - plan[at, 1] if len(at) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence, pa.int64()), pa.array(plan[at, 4], pa.int64())],
                names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    id_type = parts.schema["id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"id {id_type}, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, closing_id: int = 1,
         path: str | None = None) -> DataFrame:
    """Pack all documents: id, piece, start, length, ids_crc32, sequence_id, offset."""
    path = path or tokens.tokenizer_path()
    with few_rows_at_once(docs.sparkSession):
        parts = cut(tokenized(docs, id_col, text_col, capacity, closing_id, path), "pieces")
    return assign(parts, capacity).withColumnRenamed("id", id_col)
