"""Approximate nearest neighbours by randomly rotated one-bit codes (operator 9).

Method.  A vector v is taken relative to the centroid c of all vectors,
rotated by a random orthogonal matrix and kept as the signs of its
components: one bit each, packed into 64-bit words, with two scalars, its
distance to c and the inner product of the unit vector with its own code.
A query is rotated alike and its components become ``QUERY_BITS``-bit
whole numbers; bit planes and population counts give its inner product with
each code, and the scalars turn that into an estimate of the true inner
product of the unit vectors whose error is at most
``epsilon * sqrt((1 - p^2) / p^2 / (D - 1))`` but for a small chance (p: the
code's own inner product, D: the dimension), plus what the rounding of the
query can add.  A candidate is reranked on the original vectors if its
lower distance bound is not above the k-th smallest upper bound of its
tile; so results are exact unless a bound fails.

Every row is coded; only the centroid is fitted, on all rows.  Tiles of
code blocks and query blocks, and the merging of lists, are those of the
exact search.

Cases: a vector that is null, all zeros or holds a null or non-finite
component, or whose id is null, takes no part, neither as a query nor as a
candidate; only vectors of one dimension are compared; rows that repeat an
id are candidates each, but a query meets only other ids; a repeated query
id counts once; with fewer candidates than k all are returned; ties go to
the smaller id; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import vectors as V
from ledgerline.plans.lineage import cut

CODE_ROWS, QUERY_ROWS = 4096, 8192
QUERY_BITS = 8
EPSILON = 3.0
SEED = 20240


def usable(ids: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    good = matrix.any(axis=1)
    ids, matrix = ids[good], matrix[good]
    order = np.argsort(ids, kind="stable")
    return ids[order], matrix[order]


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix over ``dim`` components filled up to whole 64-bit words."""
    full = -(-dim // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(seed + full).standard_normal((full, full)))
    return (q * np.sign(np.diag(r)))[:dim]


def encode(matrix: np.ndarray, centroid: np.ndarray, rotate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits (uint64 words), distance to the centroid, and inner product of unit vector and code."""
    residual = matrix - centroid
    length = np.sqrt((residual * residual).sum(axis=1))
    unit = residual @ rotate / np.where(length > 0, length, 1)[:, None]
    full = rotate.shape[1]
    words = np.packbits(unit > 0, axis=1, bitorder="little").view("<u8")
    return words, length, np.where(length > 0, np.abs(unit).sum(axis=1) / np.sqrt(full), 1)


def estimates(words: np.ndarray, own: np.ndarray, unit: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of coded unit vectors with one rotated unit query, and their error bounds."""
    full = len(unit)
    low, top = float(unit.min()), float(unit.max())
    step = (top - low) / (2**QUERY_BITS - 1) or 1.0
    level = np.rint((unit - low) / step).astype(np.uint64)
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    total = np.zeros(len(words), dtype=np.int64)
    for b in range(QUERY_BITS):
        plane = np.packbits((level >> np.uint64(b)) & np.uint64(1) == 1, bitorder="little").view("<u8")
        total += np.bitwise_count(words & plane).sum(axis=1, dtype=np.int64) << b
    positive = low * ones + step * total  # sum of the query's components where the code has a one
    whole = low * full + step * float(level.sum())
    with_code = (2 * positive - whole) / np.sqrt(full)
    rounding = np.abs(unit - (low + step * level)).sum() / np.sqrt(full)
    own = np.maximum(own, 1e-9)
    spread = np.sqrt(np.maximum(0, 1 - own * own) / (own * own) / max(1, full - 1))
    return with_code / own, epsilon * spread + rounding / own


def nearest(ids, matrix, code, q_id: int, query: np.ndarray, centroid, rotate, k: int, epsilon: float):
    """Ids and distances of the ``k`` nearest rows of one block, and how many rows were reranked."""
    words, length, own = code
    residual = query - centroid
    b = float(np.sqrt((residual * residual).sum()))
    others = ids != q_id
    est, err = estimates(words, own, residual @ rotate / (b or 1.0), epsilon)
    base, cross = length * length + b * b, 2 * length * b
    lower = np.where(others, base - cross * np.minimum(1, est + err), np.inf)
    upper = np.where(others, base - cross * np.maximum(-1, est - err), np.inf)
    n = int(others.sum())
    limit = np.partition(upper, k - 1)[k - 1] if n > k else np.inf
    at = np.flatnonzero(others & (lower <= limit + 1e-9 * abs(limit)))
    diff = matrix[at] - query
    exact = np.sqrt((diff * diff).sum(axis=1))
    best = np.argsort(exact, kind="stable")[:k]
    return ids[at][best], exact[best], len(at)


def centroids(blocks: DataFrame) -> dict[int, np.ndarray]:
    """The mean of all vectors of each dimension."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, matrix = V.unpack(row["n"], row["dim"], row["ids"], row["data"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(row["dim"], row["dim"]), pa.int32()), pa.array(np.arange(row["dim"]), pa.int32()),
                     pa.array(matrix.sum(axis=0), pa.float64()), pa.array(np.full(row["dim"], row["n"]), pa.int64())],
                    names=["dim", "at", "total", "n"])

    sums = blocks.mapInArrow(run, "dim int, at int, total double, n long").groupBy("dim", "at") \
        .agg((F.sum("total") / F.sum("n")).alias("mean")).orderBy("dim", "at").collect()
    out: dict[int, list[float]] = {}
    for r in sums:
        out.setdefault(r["dim"], []).append(r["mean"])
    return {dim: np.array(mean) for dim, mean in out.items()}


def search(vectors: DataFrame, is_query: Column, k: int, epsilon: float = EPSILON, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each query: query_id, rank, vec_id, score (Euclidean distance)."""
    spark = vectors.sparkSession
    candidates = cut(V.blocks(vectors, id_col, vector_col, CODE_ROWS, usable), "ann-vectors")
    queries = cut(V.blocks(V.queries_of(vectors, id_col, vector_col, is_query), "id", "vector", QUERY_ROWS, usable),
                  "ann-queries")
    means = spark.sparkContext.broadcast(centroids(candidates))  # one vector per dimension
    schema = candidates.schema.simpleString()[len("struct<"):-1].replace(":", " ")

    def code(batches):
        for batch in batches:
            rows = batch.to_pylist()
            extra = []
            for row in rows:
                _, matrix = V.unpack(row["n"], row["dim"], row["ids"], row["data"])
                words, length, own = encode(matrix, means.value[row["dim"]], rotation(row["dim"]))
                extra.append((words.tobytes(), length.tobytes() + own.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in extra], pa.binary()),
                 pa.array([x[1] for x in extra], pa.binary())], names=[*batch.schema.names, "codes", "scalars"])

    index = cut(candidates.mapInArrow(code, schema + ", codes binary, scalars binary"), "ann-index")
    return search_index(index, queries, means, k, epsilon)


def search_index(index: DataFrame, queries: DataFrame, means, k: int, epsilon: float) -> DataFrame:
    packed = index.withColumn("data", F.concat("data", "codes", "scalars")).drop("codes", "scalars")
    tiles, n_shards = V.tiles(packed, queries)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n, dim = row["n"], row["dim"]
                size, words = 8 * n * dim, -(-dim // 64)
                ids, matrix = V.unpack(n, dim, row["ids"], row["data"][:size])
                codes = np.frombuffer(row["data"], "<u8", n * words, size).reshape(n, words)
                scalars = np.frombuffer(row["data"], "<f8", 2 * n, size + 8 * n * words)
                q_ids, q = V.unpack(row["q_n"], dim, row["q_ids"], row["q_data"])
                rotate, centroid = rotation(dim), means.value[dim]
                out_q, out_v, out_d = [], [], []
                for q_id, query in zip(q_ids, q, strict=True):
                    found, distance, _ = nearest(ids, matrix, (codes, scalars[:n], scalars[n:]), q_id, query,
                                                     centroid, rotate, k, epsilon)
                    out_q += [q_id] * len(found)
                    out_v.append(found)
                    out_d.append(distance)
                if out_v:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out_q, pa.int64()), pa.array(np.full(len(out_q), row["s"]), pa.int32()),
                         pa.array(np.concatenate(out_v), pa.int64()), pa.array(np.concatenate(out_d), pa.float64())],
                        names=["query_id", "s", "vec_id", "score"])

    lists = tiles.mapInArrow(run, "query_id long, s int, vec_id long, score double")
    return V.merged(lists, k, n_shards, F.col("score").asc())
