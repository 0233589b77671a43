"""Forests and boosted trees grown from sparse histograms; the models are MLlib's own.

MLlib adds every row to the statistics of each sampled feature of its node,
most of them one-hot slots that are zero.  Here a row is kept as the few bins
in which it differs from zero; the zero bin of a feature is what the others
leave of the node's total.  Of two children only the smaller one is summed
up, the other is the parent less that one.

What is grown is what MLlib grows: every row, the same candidate thresholds
(quantiles of a sample of ``max(maxBins ** 2, 10000)`` rows, as
``RandomForest.findSplits``), a Poisson(1) count per row and tree (from a
table of 16 bits), features drawn anew for each node, variance or Gini gain,
the same stopping rules, and boosting by squared error.  Random draws are
made per block of rows, so they differ from MLlib's.

On Spark: ``binned`` writes blocks of ``BLOCK_ROWS`` rows; a pass per level
sums them up in one task per core, and the sums of a tree are put together
and split in a task per tree (or on the driver, where all of them are at most
``DRIVER_BYTES``).  A pass takes as many trees as fit ``PASS_BYTES``.  Besides
the blocks only sums per node are kept, whatever the number of rows.

Settings beyond these rules (see ``supported``) are left to MLlib.
"""

from __future__ import annotations

import io
import json
import math
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.util import MLReadable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.plans.lineage import cut, drop_cut
from ledgerline.sources.io import scratch_path

#: Rows of a block: its bins stay in a core's cache.
BLOCK_ROWS = 32_768
#: Rows that are worth a task of their own.
TASK_ROWS = 4_096
#: Node sums that a task holds in a pass, and those that may go to the driver.
PASS_BYTES = 96 << 20
DRIVER_BYTES = 24 << 20
#: Deepest tree whose places are numbered as a heap.
MAX_DEPTH = 12


# ------------------------------------------------------------------- bins


def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds of a column, by the rule of MLlib's ``findSplitsForContinuousFeature``."""
    v, n = np.unique(values[~np.isnan(values)], return_counts=True)
    if len(v) < 2:
        return np.empty(0)
    middle = (v[:-1] + v[1:]) / 2
    if len(middle) <= most:
        return middle
    stride = n.sum() / (most + 1)
    upto, target, out = np.cumsum(n), stride, []
    for i in range(1, len(v)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


class Bins:
    """The bins of all features, numbered through: feature ``s`` has those from ``start[s]``, ``zero[s]`` is the one of 0."""

    def __init__(self, cuts: list[np.ndarray], nominal: np.ndarray):
        self.cuts, self.nominal = cuts, nominal
        size = np.array([len(c) + 1 for c in cuts])
        self.start = np.concatenate(([0], np.cumsum(size)[:-1]))
        self.total = int(size.sum())
        self.feature = np.repeat(np.arange(len(cuts)), size)
        self.bin = (np.arange(self.total) - self.start[self.feature]).astype(np.uint8)
        self.zero = np.array([np.searchsorted(c, 0.0) for c in cuts], dtype=np.uint8)
        self.last = np.zeros(self.total, dtype=bool)  # no threshold behind the last bin of a feature
        self.last[self.start + size - 1] = True

    def entries(self, n: int, row: np.ndarray, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Bin numbers of ``n`` rows where they are not those of zero, a column per row, filled up with ``total``.

        The values are given in the order of their rows; what is not given is zero.
        """
        found = (value > 0.5).astype(np.uint8)
        plain = np.flatnonzero(~self.nominal.take(feature))
        order = plain.take(np.argsort(feature.take(plain).astype(np.uint16), kind="stable"))
        ends = np.searchsorted(feature.take(order), np.arange(len(self.cuts) + 1))
        for s in np.flatnonzero(~self.nominal):
            at = order[ends[s]:ends[s + 1]]
            found[at] = np.searchsorted(self.cuts[s], value.take(at))
        used = np.flatnonzero(found != self.zero.take(feature))
        row, number = row.take(used), self.start.take(feature.take(used)) + found.take(used)
        per = np.bincount(row, minlength=n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
        out = np.full((max(1, per.max(initial=0)), n), self.total, dtype=np.uint32 if self.total >= 65535 else np.uint16)
        out[place, row] = number
        return out

    def dense(self, entries: np.ndarray) -> np.ndarray:
        """The bin of every feature (rows) of every row (columns)."""
        n = entries.shape[1]
        out = np.empty((len(self.cuts) + 1, n), dtype=np.uint8)
        out[:-1] = self.zero[:, None]
        flat, feature = out.reshape(-1), np.append(self.feature, len(self.cuts)) * n
        number, rows = np.append(self.bin, np.uint8(0)), np.arange(n)
        for e in entries:
            flat[feature.take(e) + rows] = number.take(e)
        return out


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of what a vector column, given as MLlib's struct, holds; in the order of the rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        raise ValueError("features must not be null")
    kind, indices, values = (column.field(k) for k in ("type", "indices", "values"))
    length = np.asarray(values.value_lengths())
    row = np.repeat(np.arange(len(column)), length)
    flat = np.asarray(values.flatten())
    is_dense = np.repeat(np.asarray(kind) == 1, length)
    at = np.empty(len(flat), dtype=np.int64)
    at[~is_dense] = np.asarray(indices.flatten())
    at[is_dense] = (np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length))[is_dense]
    return row, at, flat


def feature_bins(df: DataFrame, features: str, max_bins: int, rows: int, seed: int) -> Bins:
    """One-hot slots have two bins; the thresholds of the others come from a sample, as in MLlib."""
    meta = df.schema[features].metadata.get("ml_attr", {})
    binary = {a["idx"] for a in meta.get("attrs", {}).get("binary", [])}
    part = df.select(F.unwrap_udt(features).alias("v"))
    fraction = max(max_bins ** 2, 10_000) / rows
    x = part.sample(fraction=fraction, seed=seed).toArrow() if fraction < 1 else part.toArrow()
    if not x.num_rows:
        x = part.limit(10_000).toArrow()
    first = x.column("v").chunk(0)[0].as_py()
    size = meta.get("num_attrs") or first["size"] or len(first["values"])
    values = np.zeros((x.num_rows, size))
    row, at, value = vectors(x.column("v"))
    values[row, at] = value
    most = min(max_bins, rows) - 1
    nominal = np.array([s in binary for s in range(size)])
    return Bins([np.array([0.5]) if nominal[s] else thresholds(values[:, s], most) for s in range(size)], nominal)


BLOCK = "block long, n int, entries binary, y binary, w binary, f binary, bad long, classes int, least double"


def binned(df: DataFrame, features: str, label: str, weight: str | None, bins: Bins, rows: int) -> DataFrame:
    """The rows in blocks: bins, label, weight, and place for a running prediction; written once."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, have = TaskContext.get().partitionId() << 32, [], 0

        def block(tables):
            t = pa.Table.from_batches(tables).combine_chunks()
            y, w = (t.column(c).combine_chunks().to_numpy(zero_copy_only=False).astype(float) for c in ("y", "w"))
            row, feature, value = vectors(t.column("v"))
            e = bins.entries(len(y), row, feature, value)
            wrong = ~np.isfinite(y) | ~np.isfinite(w) | (w < 0)
            wrong[row[~np.isfinite(value)]] = True
            bad = np.count_nonzero(wrong)
            classes = int(y.max()) + 1 if np.isin(y, (0, 1)).all() else 0
            used = w[w > 0]
            return pa.RecordBatch.from_pylist([{
                "block": number, "n": len(y), "entries": e.tobytes(), "y": y.tobytes(), "w": w.tobytes() if (w != 1).any() else b"",
                "f": b"", "bad": bad, "classes": classes, "least": float(used.min()) if len(used) else math.inf}], schema)

        schema = pa.schema([("block", pa.int64()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("entries", "y", "w", "f")],
                            ("bad", pa.int64()), ("classes", pa.int32()), ("least", pa.float64())])
        for batch in batches:
            while batch.num_rows:
                some = batch.slice(0, BLOCK_ROWS - have)
                batch = batch.slice(some.num_rows)
                held.append(some)
                have += some.num_rows
                if have == BLOCK_ROWS:
                    yield block(held)
                    number, held, have = number + 1, [], 0
        if have:
            yield block(held)

    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    part = df.select(F.unwrap_udt(features).alias("v"), F.col(label).cast("double").alias("y"), w.alias("w"))
    tasks = max(1, rows // TASK_ROWS)
    if tasks < df.sparkSession.sparkContext.defaultParallelism:
        part = part.coalesce(tasks)
    return cut(part.mapInArrow(blocks, BLOCK), "binned")


# ------------------------------------------------------------------ trees


class Tree:
    """A tree in the places of a heap: the children of ``i`` are ``2i + 1`` (bins up to ``bin``) and ``2i + 2``."""

    def __init__(self, number: int, depth: int):
        size = 2 ** (depth + 1) - 1
        self.number = number
        self.feature = np.full(size, -1)  # -1: a leaf, or no node
        self.bin = np.full(size, 255, dtype=np.uint8)
        self.gain = np.full(size, -1.0)
        self.sums = np.zeros((size, 4))  # weight, weight * y, weight * y * y, rows
        self.left_weight = np.zeros(size)

    def smaller(self, level: int) -> np.ndarray:
        """The places of ``level`` that are summed up: the root, or the lighter child of each parent."""
        if not level:
            return np.zeros(1, dtype=np.int64)
        at = np.flatnonzero(self.feature[2 ** (level - 1) - 1:2 ** level - 1] >= 0) + 2 ** (level - 1) - 1
        return 2 * at + 1 + (2 * self.left_weight[at] > self.sums[at, 0])

    def route(self, level: int) -> tuple:
        """What rows need to find their place on ``level``; leaves above send all rows left."""
        return np.maximum(self.feature[:2 ** level - 1], 0), self.bin[:2 ** level - 1]

    def values(self, level: int) -> np.ndarray:
        """The prediction at each place of ``level``, that of a leaf above at its leftmost place."""
        found = np.zeros(len(self.sums))
        used = self.sums[:, 0] > 0
        found[used] = self.sums[used, 1] / self.sums[used, 0]
        for i in range(2 ** level - 1):
            if self.feature[i] < 0:
                found[2 * i + 1] = found[i]
        return found[2 ** level - 1:2 ** (level + 1) - 1]


def descend(flat: np.ndarray, n: int, rows: np.ndarray, route: tuple, level: int) -> np.ndarray:
    """The place on ``level`` of each of ``rows``, from 0."""
    feature, last = route[0] * n, route[1]
    at = np.zeros(len(rows), dtype=np.int64)
    for _ in range(level):
        right = flat.take(feature.take(at) + rows) > last.take(at)
        at *= 2
        at += 1
        at += right
    return at - (2 ** level - 1)


#: Poisson(1) as a table of 16 bits.
POISSON = np.repeat(np.arange(9), np.diff(np.rint(65536 * np.array(
    [0] + [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(8)] + [1])).astype(int))).astype(np.uint8)


def drawn(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """How often each row of a block is in the sample of a tree."""
    return POISSON.take(np.frombuffer(np.random.default_rng([seed, tree, block]).bytes(2 * n), dtype=np.uint16))


def block_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The blocks of a batch, unpacked one at a time."""
    for i in range(batch.num_rows):
        yield {c: batch.column(c)[i].as_py() for c in ("block", "n", "entries", "y", "w", "f")}


def block_arrays(row: dict, bins: Bins):
    n = row["n"]
    e = np.frombuffer(row["entries"], dtype=np.uint32 if bins.total >= 65535 else np.uint16).reshape(-1, n)
    y = np.frombuffer(row["y"])
    w = np.frombuffer(row["w"]) if row["w"] else None
    f = np.frombuffer(row["f"]) if row["f"] else None
    return n, e, y, w, f


def level_sums(bins: Bins, trees: list[Tree], level: int, depth: int, seed: int | None):
    """The function of a pass: sums of the smaller places of ``level``, per feature's bin unless these will be leaves.

    Without ``seed`` every row counts once.
    """
    plans = []
    for t in trees:
        place = np.full(2 ** level, -1, dtype=np.int64)
        small = t.smaller(level) - (2 ** level - 1)
        place[small] = np.arange(len(small))
        plans.append((t.number, t.route(level), place, len(small)))
    width = bins.total + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((k, 4)) for *_, k in plans]
        hist = [np.zeros(k * width, dtype=complex) if level < depth else None for *_, k in plans]
        for batch in batches:
            for row in block_rows(batch):
                n, e, y, weight, f = block_arrays(row, bins)
                flat = bins.dense(e).reshape(-1) if level else None
                if f is not None:
                    y = 2 * (y - f)  # the negative gradient of the squared error
                for (number, route, place, k), s, h in zip(plans, sums, hist, strict=True):
                    count = drawn(seed, number, row["block"], n) if seed is not None else None
                    rows = np.flatnonzero(count) if count is not None else np.arange(n)
                    if level:
                        at = place.take(descend(flat, n, rows, route, level))
                        order = np.argsort(at.astype(np.int16), kind="stable")
                        order = order[np.searchsorted(at.take(order), 0):]  # sorted by place, so that sums stay in cache
                        rows, at = rows.take(order), at.take(order)
                    else:
                        at = np.zeros(len(rows), dtype=np.int64)
                    c = count.take(rows).astype(float) if count is not None else np.ones(len(rows))
                    w = c if weight is None else c * weight.take(rows)
                    v = y.take(rows)
                    wv = w * v
                    for j, x in enumerate((w, wv, wv * v, c)):
                        s[:, j] += np.bincount(at, x, k)
                    if h is not None:
                        both, base = w + 1j * wv, at * width
                        for one in e:
                            np.add.at(h, base + one.take(rows), both)
        for (number, *_), s, h in zip(plans, sums, hist, strict=True):
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([number], pa.int32()), "kind": pa.array(["part"]), "sums": pa.array([s.tobytes()], pa.binary()),
                "hist": pa.array([b"" if h is None else h.reshape(-1, width)[:, :-1].tobytes()], pa.binary())})

    return run


SUMS = "tree int, kind string, sums binary, hist binary"


def split_level(bins: Bins, tree: Tree, level: int, depth: int, small: np.ndarray, sums: np.ndarray, hist: np.ndarray | None,
                before: dict, chosen: int, seed: int, least: float, scale: float):
    """(places, sums, feature, bin, gain, left weight) of all nodes of a level, and their histograms.

    ``sums`` and ``hist`` are those of the places ``small``; a sibling has what its parent, in ``before``, has besides.
    """
    if level:
        sibling = small - 1 + 2 * (small % 2)
        parent = (small - 1) // 2
        places = np.concatenate((small, sibling))
        sums = np.concatenate((sums, tree.sums[parent] - sums))
        if hist is not None:
            hist = np.concatenate((hist, before["hist"][np.searchsorted(before["places"], parent)] - hist))
        order = np.argsort(places)
        places, sums, hist = places[order], sums[order], None if hist is None else hist[order]
    else:
        places = small
    k = len(places)
    feature, cut_bin, gain, left = np.full(k, -1), np.full(k, 255, dtype=np.uint8), np.full(k, -1.0), np.zeros(k)
    if level < depth and k:
        n, total = sums[:, :1], sums[:, 1:2]
        full = hist.copy()
        rest = (n + 1j * total) - np.add.reduceat(full, bins.start, axis=1)
        full[:, bins.start + bins.zero] += rest
        upto = np.cumsum(full, axis=1)
        upto -= np.concatenate((np.zeros((k, 1)), upto), axis=1)[:, bins.start[bins.feature]]
        ln, ls = upto.real, upto.imag
        rn = n - ln
        ok = ~bins.last & (ln >= least / 2) & (rn >= least / 2)
        if chosen < len(bins.cuts):
            pick = np.zeros((k, len(bins.cuts)), dtype=bool)
            for i, p in enumerate(places):
                pick[i, np.random.default_rng([seed, tree.number, int(p), 1]).choice(len(bins.cuts), chosen, replace=False)] = True
            ok &= pick[:, bins.feature]
        mean = total / n
        with np.errstate(all="ignore"):
            # sums of (y - mean): the gain without cancellation
            dl = ls - ln * mean
            found = np.where(ok, dl * dl * (1 / ln + 1 / rn) / n, -1.0)
        best = found.argmax(axis=1)
        top = found[np.arange(k), best]
        impurity = sums[:, 2] / sums[:, 0] - mean[:, 0] ** 2
        good = (top > 1e-13 * (1 + mean[:, 0] ** 2)) & (impurity > 1e-13 * (1 + mean[:, 0] ** 2))
        feature[good], cut_bin[good] = bins.feature[best][good], bins.bin[best][good]
        gain[good], left[good] = scale * top[good], ln[np.arange(k), best][good]
    return (places, sums, feature, cut_bin, gain, left), {"places": places, "hist": hist}


def packed(arrays: tuple) -> bytes:
    out = io.BytesIO()
    np.savez(out, *arrays)
    return out.getvalue()


def unpacked(data: bytes) -> tuple:
    z = np.load(io.BytesIO(data))
    return tuple(z[f"arr_{i}"] for i in range(len(z.files)))


def grow(blocks: DataFrame, bins: Bins, numbers: list[int], depth: int, chosen: int, seed: int, draw: bool, least: float,
         scale: float = 1.0) -> list[Tree]:
    """The trees with these numbers over the blocks, level by level, as many at a time as fit a pass."""
    most = 2 ** max(0, depth - 2) * (bins.total + 1) * 16  # of a tree, on the last level with histograms
    at_once = max(1, PASS_BYTES // most)
    out: list[Tree] = []
    for i in range(0, len(numbers), at_once):
        out += _grow_some(blocks, bins, [Tree(k, depth) for k in numbers[i:i + at_once]], depth, chosen, seed, draw, least, scale)
    return out


def _grow_some(blocks, bins, trees, depth, chosen, seed, draw, least, scale) -> list[Tree]:
    spark = blocks.sparkSession
    tasks = min(spark.sparkContext.defaultParallelism, blocks.rdd.getNumPartitions())
    used = blocks.select("block", "n", "entries", "y", "w", "f").coalesce(tasks)
    kept, state = {}, None  # histograms of the level above: on the driver, or written
    for level in range(depth + 1):
        alive = [t for t in trees if len(t.smaller(level))]
        if not alive:
            break
        parts = used.mapInArrow(level_sums(bins, alive, level, depth, seed if draw else None), SUMS)
        size = tasks * len(alive) * 2 ** max(0, level - 1) * (bins.total * 16 if level < depth else 32)
        by_number = {t.number: t for t in alive}

        def together(number: int, rows: list[dict], before: dict):
            tree = by_number[number]
            small = tree.smaller(level)
            sums = sum(np.frombuffer(r["sums"]).reshape(-1, 4) for r in rows)
            hist = sum(np.frombuffer(r["hist"], dtype=complex).reshape(-1, bins.total) for r in rows) if level < depth else None
            return split_level(bins, tree, level, depth, small, sums, hist, before, chosen, seed, least, scale)

        if size <= DRIVER_BYTES and state is None:
            rows = parts.collect()
            per: dict[int, list] = {}
            for r in rows:
                per.setdefault(r["tree"], []).append(r)
            found = {}
            for number, some in per.items():
                found[number], kept[number] = together(number, some, kept.get(number, {}))
        else:
            if state is None and level:
                state = cut(_state_frame(spark, kept), "forest")
                kept = {}

            def reduce(table: pa.Table) -> pa.Table:
                rows = table.to_pylist()
                old = [r for r in rows if r["kind"] == "old"]
                before = {"places": np.frombuffer(old[0]["sums"], dtype=np.int64),
                          "hist": np.frombuffer(old[0]["hist"], dtype=complex).reshape(-1, bins.total)} if old and level < depth else {}
                new = [r for r in rows if r["kind"] == "part"]
                if not new:
                    return table.slice(0, 0).append_column("found", pa.array([], pa.binary()))
                splits, hists = together(rows[0]["tree"], new, before)
                return pa.table({"tree": pa.array([rows[0]["tree"]], pa.int32()), "kind": ["old"],
                                 "sums": pa.array([hists["places"].astype(np.int64).tobytes()], pa.binary()),
                                 "hist": pa.array([hists["hist"].tobytes() if level < depth - 1 else b""], pa.binary()),
                                 "found": pa.array([packed(splits)], pa.binary())})

            both = parts if state is None else parts.unionByName(state.select("tree", "kind", "sums", "hist"))
            done = cut(both.repartition(tasks, "tree").groupBy("tree").applyInArrow(reduce, f"{SUMS}, found binary"), "forest")
            found = {r["tree"]: unpacked(r["found"]) for r in done.select("tree", "found").collect()}
            if state is not None:
                drop_cut(state)
            state = done
        for number, (places, sums, feature, cut_bin, gain, left) in found.items():
            t = by_number[number]
            t.sums[places], t.feature[places], t.bin[places], t.gain[places], t.left_weight[places] = sums, feature, cut_bin, gain, left
    if state is not None:
        drop_cut(state)
    return trees


def _state_frame(spark, kept: dict) -> DataFrame:
    rows = [(k, "old", v["places"].astype(np.int64).tobytes(), v["hist"].tobytes()) for k, v in kept.items()]
    return spark.createDataFrame(pa.table({
        "tree": pa.array([r[0] for r in rows], pa.int32()), "kind": pa.array([r[1] for r in rows], pa.string()),
        "sums": pa.array([r[2] for r in rows], pa.binary()), "hist": pa.array([r[3] for r in rows], pa.binary())}), SUMS)


def boosted(blocks: DataFrame, bins: Bins, rounds: int, depth: int, step: float, seed: int, least: float) -> tuple[list[Tree], list[float]]:
    """Trees and their weights: the first fits the label, each other one the residuals of those before."""
    spark = blocks.sparkSession
    trees, weights, now = [], [], blocks
    for k in range(rounds):
        tree = grow(now, bins, [k], depth, len(bins.cuts), seed, False, least)[0]
        trees.append(tree)
        weights.append(step if k else 1.0)
        if k == rounds - 1:
            break
        route, values, add = tree.route(depth), tree.values(depth), weights[-1]

        def predicted(batches):
            for batch in batches:
                f = []
                for row in block_rows(batch):
                    n, e, _, _, before = block_arrays(row, bins)
                    p = add * values.take(descend(bins.dense(e).reshape(-1), n, np.arange(n), route, depth))
                    f.append((p if before is None else before + p).tobytes())
                yield batch.set_column(batch.schema.get_field_index("f"), "f", pa.array(f, pa.binary()))

        new = cut(now.mapInArrow(predicted, now.schema), "boosted")
        if now is not blocks:
            drop_cut(now)
        now = new
    if now is not blocks:
        drop_cut(now)
    return trees, weights


# ----------------------------------------------------------------- models

_NODE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                   ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                   ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                                        ("numCategories", pa.int32())]))])


def node_rows(tree: Tree, bins: Bins, classes: bool) -> list[dict]:
    """The nodes as MLlib stores them, parents before children; twin leaves with one prediction are merged, as MLlib does."""
    sums, gain, last, features = (x.tolist() for x in (tree.sums, tree.gain, tree.bin, tree.feature))
    size = len(sums)
    guess = [0.0 if not n else (1.0 if 2 * s > n else 0.0) if classes else s / n for n, s, _, _ in sums]
    end = [f < 0 for f in features]
    for i in reversed(range(size // 2)):
        end[i] = end[i] or (end[2 * i + 1] and end[2 * i + 2] and guess[2 * i + 1] == guess[2 * i + 2])

    out: list[dict] = []

    def add(i) -> int:
        n, s, ss, raw = sums[i]
        mean = s / n
        impurity = 2 * mean * (1 - mean) if classes else max(0.0, ss / n - mean * mean)
        at, feature = len(out), features[i]
        split = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
        if not end[i] and bins.nominal[feature]:
            split = {"featureIndex": feature, "leftCategoriesOrThreshold": [0.0], "numCategories": 2}
        elif not end[i]:
            split = {"featureIndex": feature, "leftCategoriesOrThreshold": [float(bins.cuts[feature][last[i]])], "numCategories": -1}
        node = {"id": at, "prediction": guess[i], "impurity": impurity, "impurityStats": [n - s, s] if classes else [n, s, ss],
                "rawCount": round(raw), "gain": -1.0 if end[i] else gain[i], "leftChild": -1, "rightChild": -1, "split": split}
        out.append(node)
        if not end[i]:
            node["leftChild"] = add(2 * i + 1)
            node["rightChild"] = add(2 * i + 2)
        return at

    add(0)
    return out


#: Params of an ensemble that its trees do not have.
_OF_ALL = {"bootstrap", "numTrees", "featureSubsetStrategy", "subsamplingRate", "maxIter", "stepSize", "lossType", "validationTol",
           "validationIndicatorCol"}


def model_of(estimator, spark, cls, java: str, tree_java: str, bins: Bins, trees: list[Tree], weights: list[float], extra: dict) -> MLReadable:
    """MLlib's model of these trees: written in MLlib's format and loaded."""
    path = scratch_path(spark, f"grown-{uuid.uuid4().hex[:8]}")
    own = {p.name: v for p, v in estimator._paramMap.items()}
    default = {p.name: v for p, v in estimator._defaultParamMap.items()}

    def meta(kind, uid, skip=frozenset(), **more):
        return json.dumps({"class": kind, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
                           "paramMap": {k: v for k, v in own.items() if k not in skip},
                           "defaultParamMap": {k: v for k, v in default.items() if k not in skip}, **more})

    classes = "numClasses" in extra
    head = meta(java, estimator.uid, numFeatures=len(bins.cuts), numTrees=len(trees), **extra)
    spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    nodes = [(k, row) for k, t in enumerate(trees) for row in node_rows(t, bins, classes)]
    spark.createDataFrame(pa.table({"treeID": pa.array([k for k, _ in nodes], pa.int32()), "nodeData": pa.array([r for _, r in nodes], _NODE)})) \
        .coalesce(1).write.parquet(f"{path}/data")
    tree_meta = {"numFeatures": len(bins.cuts)} | extra if classes else {}
    rows = [(k, meta(tree_java, f"{'dtc' if classes else 'dtr'}_{uuid.uuid4().hex[:12]}", _OF_ALL, **tree_meta), float(w)) for k, w in enumerate(weights)]
    spark.createDataFrame(rows, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    model = cls.load(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return model


def supported(est) -> bool:
    """Whether the settings are those that are grown here."""
    get = est.getOrDefault
    plain = get("maxDepth") <= MAX_DEPTH and get("minInstancesPerNode") == 1 and get("minInfoGain") == 0 \
        and get("minWeightFractionPerNode") == 0 and get("subsamplingRate") == 1 and get("maxBins") <= 255 and get("maxDepth") > 0
    if isinstance(est, GBTRegressor):
        return plain and get("lossType") == "squared" and get("featureSubsetStrategy") == "all" and not est.isSet("validationIndicatorCol")
    return plain and get("bootstrap") and get("numTrees") > 1 and get("featureSubsetStrategy") == "auto" \
        and get("impurity") in ("variance", "gini") and not (est.hasParam("thresholds") and est.isSet("thresholds"))


def _prepared(est, df: DataFrame):
    """(bins, blocks, rows, classes, least weight); None if there is nothing to learn from."""
    features, label = est.getOrDefault("featuresCol"), est.getOrDefault("labelCol")
    weight = est.getOrDefault("weightCol") if est.isSet("weightCol") else None
    rows = df.count()
    # nominal features other than one-hot slots are beyond these bins
    attrs = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    if not rows or attrs.get("nominal"):
        return None
    bins = feature_bins(df, features, est.getOrDefault("maxBins"), rows, est.getOrDefault("seed") % 2 ** 31)
    blocks = binned(df, features, label, weight, bins, rows)
    seen = blocks.agg(F.sum("bad").alias("bad"), F.min("classes").alias("low"), F.max("classes").alias("high"), F.min("least").alias("least")).first()
    if seen["bad"]:
        raise ValueError(f"{seen['bad']} rows whose label, weight or features are not finite")  # as in MLlib
    return bins, blocks, (seen["low"], seen["high"]), seen["least"]


def _fit_forest(est, df: DataFrame, cls, java: str, tree_java: str, classes: bool):
    ready = _prepared(est, df) if supported(est) else None
    if ready is None:
        return None
    bins, blocks, (low, high), least = ready
    try:
        if classes and (low == 0 or high != 2):
            return None
        size = len(bins.cuts)
        chosen = math.ceil(math.sqrt(size)) if classes else math.ceil(size / 3)
        depth, seed = est.getOrDefault("maxDepth"), est.getOrDefault("seed") % 2 ** 63
        trees = grow(blocks, bins, list(range(est.getOrDefault("numTrees"))), depth, chosen, seed, True, least, 2.0 if classes else 1.0)
    finally:
        drop_cut(blocks)
    return model_of(est, df.sparkSession, cls, java, tree_java, bins, trees, [1.0] * len(trees), {"numClasses": 2} if classes else {})


class HistogramForestRegressor(RandomForestRegressor):
    """MLlib's forest, grown from sparse histograms."""

    def _fit(self, dataset):
        model = _fit_forest(self, dataset, RandomForestRegressionModel, "org.apache.spark.ml.regression.RandomForestRegressionModel",
                            "org.apache.spark.ml.regression.DecisionTreeRegressionModel", False)
        return super()._fit(dataset) if model is None else self._copyValues(model)


class HistogramForestClassifier(RandomForestClassifier):
    """MLlib's forest of two classes, grown from sparse histograms."""

    def _fit(self, dataset):
        model = _fit_forest(self, dataset, RandomForestClassificationModel, "org.apache.spark.ml.classification.RandomForestClassificationModel",
                            "org.apache.spark.ml.classification.DecisionTreeClassificationModel", True)
        return super()._fit(dataset) if model is None else self._copyValues(model)


class HistogramGBTRegressor(GBTRegressor):
    """MLlib's boosted trees, grown from sparse histograms."""

    def _fit(self, dataset):
        ready = _prepared(self, dataset) if supported(self) else None
        if ready is None:
            return super()._fit(dataset)
        bins, blocks, _, least = ready
        try:
            trees, weights = boosted(blocks, bins, self.getOrDefault("maxIter"), self.getOrDefault("maxDepth"), self.getOrDefault("stepSize"),
                                     self.getOrDefault("seed") % 2 ** 63, least)
        finally:
            drop_cut(blocks)
        return self._copyValues(model_of(self, dataset.sparkSession, GBTRegressionModel, "org.apache.spark.ml.regression.GBTRegressionModel",
                                         "org.apache.spark.ml.regression.DecisionTreeRegressionModel", bins, trees, weights, {}))
