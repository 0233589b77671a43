"""Connected components of a graph given as a frame of edges."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.plans.lineage import cut, drop_cut

#: Edges that one task contracts at a time.
TASK_EDGES = 200_000


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def contracted(edges: DataFrame, tasks: int) -> DataFrame:
    """Edges dealt to ``tasks`` tasks, each replaced by a star for every component that the task sees."""
    def run(batches):
        up: dict = {}

        def root(x):
            top = x
            while (parent := up.get(top, top)) != top:
                top = parent
            while x != top:
                up[x], x = top, up.get(x, x)
            return top

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                up[max(a, b)] = min(a, b)
        links = [(x, top) for x in up if (top := root(x)) != x]
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], kind), pa.array([y for _, y in links], kind)],
                                             names=["a", "b"])

    return edges.repartition(tasks).mapInArrow(run, edges.schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); a component is named by its smallest node.

    Each task first contracts up to ``TASK_EDGES`` edges to stars.  If there
    was more than one task, two steps alternate until nothing changes: each
    node's larger neighbours are linked to its smallest neighbour, then its
    smaller ones; trees of links shrink to stars in a number of rounds that
    grows with the logarithm of the graph's size.  Edges with a null end are
    left out.
    """
    e = cut(edges.where("a <> b").select("a", "b"), "edges")
    n = e.count()
    tasks = max(1, -(-n // TASK_EDGES))
    stars = cut(contracted(e, tasks), "edges")
    drop_cut(e)
    if tasks > 1:
        stars = _stars(stars)
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .union(stars.select("b", "b").distinct())


def _stars(e: DataFrame) -> DataFrame:
    """The edges (a > b) of stars with the same components as ``e`` (a cut, which is given back)."""
    before = _checksum(e)
    while True:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .union(least.select("a", "m")).distinct()
        small = cut(small, "edges")
        drop_cut(e)
        e, after = small, _checksum(small)
        if after == before:
            return e
        before = after
