"""Exact top-k search by inner product (operator 7).

Method.  Candidates are packed into shards of ``CANDIDATE_ROWS`` vectors and
queries into blocks of ``QUERY_ROWS``; each tile (query block, shard) is one
matrix product with a partial selection of the k best per query; the lists
of a query are merged in a tree, ``MERGE_FAN_IN`` shards at a time.

Vectors are scaled to whole numbers first, so scores are exact: a tile uses
float64 products while every partial sum stays below 2**53, else 64-bit
integers, else Python's integers (a score beyond a long becomes the nearest
long).

Cases: a vector that is null or holds a null or non-finite component (also
after scaling), or whose id is null, takes no part; only vectors of one
dimension are compared; a query meets every row with another id, rows that
repeat an id are candidates each; a repeated query id counts once; with
fewer candidates than k all are returned; ties go to the smaller id; empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import vectors as V
from ledgerline.plans.lineage import cut

CANDIDATE_ROWS, QUERY_ROWS = 4096, 8192
LONG = (1 << 63) - 1


def whole_numbers(scale: float):
    def prepare(ids: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            matrix = np.floor(scale * matrix)
        good = np.isfinite(matrix).all(axis=1)
        ids, matrix = ids[good], matrix[good]
        order = np.argsort(ids, kind="stable")
        return ids[order], matrix[order]
    return prepare


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows."""
    bound = q.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0))
    if bound < 2.0**53:
        return q @ c.T
    if bound < 2.0**62:
        return q.astype(np.int64) @ c.astype(np.int64).T
    exact = np.vectorize(int, otypes=[object])
    big = exact(q) @ exact(c).T
    return np.clip(big, -LONG, LONG)


def top_k(vectors: DataFrame, is_query: Column, k: int, scale: float = 256.0, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """The ``k`` highest inner products of each query: query_id, rank, vec_id, score."""
    prepare = whole_numbers(scale)
    candidates = cut(V.blocks(vectors, id_col, vector_col, CANDIDATE_ROWS, prepare), "topk-candidates")
    queries = cut(V.blocks(V.queries_of(vectors, id_col, vector_col, is_query), "id", "vector", QUERY_ROWS, prepare),
                  "topk-queries")
    tiles, n_shards = V.tiles(candidates, queries)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, c = V.unpack(row["n"], row["dim"], row["ids"], row["data"])
                q_ids, q = V.unpack(row["q_n"], row["dim"], row["q_ids"], row["q_data"])
                out_q, out_v, out_s = [], [], []
                for i in range(0, len(q_ids), 128):
                    scores = products(q[i:i + 128], c)
                    # one more than k: the query's own row may be among them
                    own = np.searchsorted(ids, q_ids[i:i + 128], "right") - np.searchsorted(ids, q_ids[i:i + 128])
                    for j, at in enumerate(V.best_rows(scores, k + int(own.max(initial=0)))):
                        at = at[ids[at] != q_ids[i + j]][:k]
                        out_q += [q_ids[i + j]] * len(at)
                        out_v.append(ids[at])
                        out_s.append(scores[j, at].astype(np.int64))
                if out_v:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out_q, pa.int64()), pa.array(np.full(len(out_q), row["s"]), pa.int32()),
                         pa.array(np.concatenate(out_v), pa.int64()), pa.array(np.concatenate(out_s), pa.int64())],
                        names=["query_id", "s", "vec_id", "score"])

    lists = tiles.mapInArrow(run, "query_id long, s int, vec_id long, score long")
    return V.merged(lists, k, n_shards, F.col("score").desc())
