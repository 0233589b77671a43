"""Blocks of dense vectors, tiles of query and candidate blocks, and merging of per-query top lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "dim int, n int, block long, ids binary, data binary"
MERGE_FAN_IN = 16
#: Bytes of one block of vectors at most, and blocks that meet in one key of the grid.
BLOCK_BYTES = 4 << 20
PER_SHARD = 4


def dense(ids: pa.Array, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, float64 matrix) for each dimension, of the usable rows: id and vector not null, all components finite."""
    known = pc.and_(pc.is_valid(ids), pc.is_valid(column)).to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null component turns into nan
    starts = np.cumsum(sizes) - sizes
    ids = pc.fill_null(ids, 0).cast(pa.int64()).to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes[known]):
        at = np.flatnonzero(known & (sizes == dim))
        matrix = flat[starts[at][:, None] + np.arange(dim)] if dim else np.zeros((len(at), 0))
        good = np.isfinite(matrix).all(axis=1)
        if good.any():
            yield ids[at][good], matrix[good]


def blocks(df: DataFrame, id_col: str, vector_col: str, rows: int,
           prepare: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Pack the usable vectors, as ``prepare(ids, matrix)`` leaves them, into blocks of at most ``rows`` rows and ``BLOCK_BYTES``."""
    def run(batches):
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        for batch in batches:
            for ids, matrix in dense(batch.column(0), batch.column(1)):
                ids, matrix = prepare(ids, matrix)
                step = max(1, min(rows, BLOCK_BYTES // (8 * max(1, matrix.shape[1]))))
                for i in range(0, len(ids), step):
                    part = matrix[i:i + step]
                    number += 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part.shape[1]], pa.int32()), pa.array([len(part)], pa.int32()),
                         pa.array([number], pa.int64()),
                         pa.array([ids[i:i + step].astype("<i8").tobytes()], pa.binary()),
                         pa.array([part.astype("<f8").tobytes()], pa.binary())],
                        names=["dim", "n", "block", "ids", "data"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).mapInArrow(run, BLOCK)


def unpack(n: int, dim: int, ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, "<i8"), np.frombuffer(data, "<f8").reshape(n, dim)


def queries_of(df: DataFrame, id_col: str, vector_col: str, is_query: Column) -> DataFrame:
    """One row per query id; of rows that repeat an id the smallest vector is the query."""
    return df.where(is_query).groupBy(F.col(id_col).alias("id")).agg(F.min(vector_col).alias("vector"))


def tiles(candidates: DataFrame, queries: DataFrame) -> tuple[DataFrame, int]:
    """Every block of candidates beside every block of queries of its dimension, and the number of shards.

    Both frames must be cuts.  Candidate blocks are dealt to shards, query
    blocks to rows of shards; block (q, s) of that grid is one join key, so
    each key has a bounded number of blocks and any task can take any tile.
    A candidate block is sent once per ``PER_SHARD`` blocks of queries, so
    these are as large as a task may hold.
    """
    n_shards = max(1, -(-candidates.count() // PER_SHARD))
    n_rows = max(1, -(-queries.count() // PER_SHARD))
    c = candidates.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("q"),
        F.pmod(F.xxhash64("block"), F.lit(n_shards)).cast("int").alias("s"), "dim", "n", "ids", "data")
    q = queries.select(
        F.pmod(F.xxhash64("block"), F.lit(n_rows)).cast("int").alias("q"),
        F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("s"), "dim",
        F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    return c.join(q, ["q", "s", "dim"]).select("s", "dim", "n", "ids", "data", "q_n", "q_ids", "q_data"), n_shards


def best_rows(scores: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each row of ``scores``: the columns of its ``k`` highest values, ties by smaller column."""
    n = scores.shape[1]
    floor = np.partition(scores, n - k, axis=1)[:, n - k] if n > k else None
    for i, row in enumerate(scores):
        at = np.arange(n) if floor is None else np.flatnonzero(row >= floor[i])
        yield at[np.argsort(-row[at], kind="stable")[:k]]


def merged(lists: DataFrame, k: int, n_shards: int, best_first: Column) -> DataFrame:
    """Merge top lists (query_id, s, vec_id, score) level by level, ``MERGE_FAN_IN`` shards to one."""
    while n_shards > 1:
        n_shards = -(-n_shards // MERGE_FAN_IN)
        lists = lists.withColumn("s", F.floor(F.col("s") / MERGE_FAN_IN).cast("int") if n_shards > 1 else F.lit(0))
        window = Window.partitionBy("query_id", "s").orderBy(best_first, "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k).drop("rank")
    window = Window.partitionBy("query_id").orderBy(best_first, "vec_id")
    return lists.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
