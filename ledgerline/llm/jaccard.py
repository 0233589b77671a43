"""N-gram Jaccard join and its connected classes by signature trees (operator 6).

A document's set holds its distinct word n-grams (as 64-bit hashes); two
documents link when ``den * |A n B| >= num * |A u B|``.  The result gives
every document the smallest id it can reach by links.

Method.  Equal sets are one class (128-bit digest), so copies cost nothing
more.  A signature tree holds sets as leaves; a node holds the OR of the
token bitmaps below it, their size range and least bit count.  Two trees
are traversed together, level by level: a pair of nodes is dropped when no
two sets below them can share enough tokens -- sets of the first node have
at least ``least bit count - bits in common`` tokens outside every set of the
second, which bounds their overlap -- and pairs of sets that remain are
verified by exact intersection.  Pairs already joined in one component are
skipped, so a large group of near copies costs about one verification each.

Sets meet in one tree only if they can be linked.  The hash range is cut
into slices, and two sets share a tree if they agree on a whole slice that
is not empty.  The number of slices is chosen per power of two of the size,
and grows with it, so this loses nothing: sets with that similarity differ in
d tokens at most and there are more than d slices, so one is the same in
both (empty slices count where a set has no more than d full ones).  A set of n
n-grams has about n / 9 slices at 0.9 and n / 4 at 0.8, of nine and four
n-grams each.

At scale: (slice, class) rows are shuffled once and read in order of the
slices, which gives candidate clusters of classes that share one, and only
their texts are read a second time.  Clusters up to ``LEAF_SETS`` sets and
``LEAF_TOKENS`` tokens are one tree.  Larger ones are dealt by size band and
hash to several; each tree is joined with itself, one set of every
component found is dealt again until that stops helping, and then those
pairs of trees that may still hold a link across components are traversed,
on bitmaps alone; the pairs of sets that are left are verified.  Two large
components can have very many links between them and one is enough, so each
pair of trees first gives ``FEW_PAIRS`` pairs of sets for each two components;
where there were more, it is traversed again with the components found by
then, for ``FEW_PAIRS`` times as many, until none is left out.  No task gets
more than two trees; edges and labels stay in frames.

Cases: null or empty text, or one without words, has an empty set that
links with nothing, itself being its class; fewer words than n make one
n-gram of the whole sequence; repeated rows are copies; a null id is never
the smallest unless all ids of its class are null; empty tables give no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.util import broadcast_if_small, byte_rows, few_rows_at_once, forget_worker_cache, fresh_name, row_groups, worker_cache
from ledgerline.plans.lineage import cut, drop_cut

LEAF_SETS = 1024
LEAF_TOKENS = 1 << 20
ACROSS_SETS = 4096
ACROSS_BYTES = 1 << 23      # of the bitmaps of a tree that is joined with others
FEW_PAIRS = 16              # of sets of two components, verified first
TOKEN_ROWS = 64             # rows with token sets that a worker unpacks at a time
FAN_OUT = 8
PAIRS_AT_ONCE = 1 << 12   # node pairs opened at a time
BYTES_AT_ONCE = 1 << 22   # of bitmaps compared at a time
MAX_WORDS = 150_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_ODD = np.array([0x9E3779B97F4A7C15 + 2 * 0xD1B54A32D192ED03 * k & 0xFFFFFFFFFFFFFFFF | 1 for k in range(64)], np.uint64)


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash; forgets when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 48:
            self[word] = value
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashes = worker_cache("word hashes", WordHashes)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - width + 1
    if n < 1:  # the whole sequence as one n-gram
        return _mix((h * _ODD[:len(h)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(h)))
    total = h[:n] * _ODD[0]
    for k in range(1, width):
        total += h[k:k + n] * _ODD[k]
    return np.unique(_mix(total))


def most_different(size: int, num: int, den: int) -> int:
    """The most tokens in which a set of this size and a linked one can differ."""
    return (size + size * den // num) * (den - num) // (den + num)


def slices(tokens: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of the slices under which a set is held; linked sets of different content share one."""
    n = len(tokens)
    d = most_different(n, num, den)
    if d == 0:
        return np.zeros(0, np.int64)  # linked with equal sets only
    out = []
    octave = n.bit_length()
    for o in (octave, octave + 1) if n * den // num >= 1 << octave else (octave,):
        largest = (1 << o) - 1
        pieces = 2 * largest * (den - num) // (den + num) + 1
        pieces += max(1, pieces // 16)  # some may be empty
        at = ((tokens >> np.uint64(32)) * np.uint64(pieces)) >> np.uint64(32)
        label = np.uint64(o) * np.uint64(1 << 32)
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        content = np.add.reduceat(_mix(tokens ^ np.uint64(0xA5A5A5A5)), starts)
        out.append(_mix(content ^ _mix(label + at[starts])))
        if len(starts) <= d:
            empty = np.setdiff1d(np.arange(pieces, dtype=np.uint64), at[starts])
            out.append(_mix(_mix(label + empty)))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


class Tree:
    """Signature tree over the rows of a bitmap matrix; level 0 are the sets themselves."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        pops = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, sizes, sizes, pops)]

    def grow(self, height: int) -> None:
        while len(self.levels) < height:
            bits, low, high, pops = self.levels[-1]
            at = np.arange(0, len(low), FAN_OUT)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.minimum.reduceat(pops, at)))

    @property
    def height(self) -> int:
        n, h = len(self.levels[0][1]), 1
        while n > 1:
            n, h = -(-n // FAN_OUT), h + 1
        return h


def may_link(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether nodes i of one level and j of another can hold two linked sets."""
    common = np.empty(len(i), np.int64)
    step = max(1, BYTES_AT_ONCE // (8 * x[0].shape[1]))
    for at in range(0, len(i), step):
        part = slice(at, at + step)
        common[part] = np.bitwise_count(x[0][i[part]] & y[0][j[part]]).sum(axis=1, dtype=np.int64)
    outside_y = np.maximum(0, x[3][i] - common)
    outside_x = np.maximum(0, y[3][j] - common)
    return (den * x[2][i] - num * y[1][j] >= outside_y * (den + num)) \
        & (den * y[2][j] - num * x[1][i] >= outside_x * (den + num))


def some_of_each(i: np.ndarray, j: np.ndarray, of_i: np.ndarray, of_j: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """At most ``most`` of the pairs for each two labels, by a hash of the pair, and whether some are left out."""
    labels = np.minimum(of_i[i], of_j[j]) * np.int64(1 << 32) + np.maximum(of_i[i], of_j[j])
    order = np.lexsort((_mix(i.astype(np.uint64) * np.uint64(1 << 32) + j.astype(np.uint64)), labels))
    labels = labels[order]
    fresh = np.concatenate([[True], labels[1:] != labels[:-1]])[:len(labels)]
    at = np.arange(len(labels))
    keep = order[at - np.maximum.accumulate(np.where(fresh, at, 0)) < most]
    return i[keep], j[keep], len(keep) < len(i)


def surviving_pairs(a: Tree, b: Tree, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Dual traversal: the pairs of sets that no bound rules out (of one tree with itself: i < j)."""
    found = list(_surviving(a, b, num, den))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def pairs_apart(a: Tree, b: Tree, of_a: np.ndarray, of_b: np.ndarray, most: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Of the surviving pairs with different labels at most ``most`` for each two labels, and whether there are more."""
    i = j = np.zeros(0, np.int64)
    more = False
    for one, two in _surviving(a, b, num, den):
        apart = of_a[one] != of_b[two]
        i, j, left_out = some_of_each(np.concatenate([i, one[apart]]), np.concatenate([j, two[apart]]), of_a, of_b, most)
        more |= left_out
    return i, j, more


def _surviving(a: Tree, b: Tree, num: int, den: int):
    same = a is b
    height = max(a.height, b.height)
    a.grow(height)
    b.grow(height)
    child = np.arange(FAN_OUT)
    # depth first in parts of PAIRS_AT_ONCE, so few pairs are open at any time
    todo = [(height - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))] if not same or height > 1 else []
    while todo:
        level, i, j = todo.pop()
        keep = may_link(a.levels[level], b.levels[level], i, j, num, den)
        i, j = i[keep], j[keep]
        if level == 0:
            yield i, j
            continue
        for at in range(0, len(i), PAIRS_AT_ONCE):
            one, two = i[at:at + PAIRS_AT_ONCE], j[at:at + PAIRS_AT_ONCE]
            one = np.repeat(one[:, None] * FAN_OUT + child, FAN_OUT, axis=1).ravel()
            two = np.tile(two[:, None] * FAN_OUT + child, (1, FAN_OUT)).ravel()
            ok = (one < len(a.levels[level - 1][1])) & (two < len(b.levels[level - 1][1]))
            if same:
                ok &= one <= two if level > 1 else one < two
            todo.append((level - 1, one[ok].astype(np.int32), two[ok].astype(np.int32)))


def bitmaps(sets: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(sets), width // 8), np.uint8)
    for row, tokens in zip(out, sets, strict=True):
        bit = tokens & np.uint64(width - 1)
        np.bitwise_or.at(row, (bit >> np.uint64(3)).astype(np.int64), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))
    return out.view(np.uint64)


def in_tree_order(sets: list[np.ndarray]) -> np.ndarray:
    """An order that puts similar sets side by side: by their smallest tokens."""
    first = [s[0] for s in sets]
    second = [s[min(1, len(s) - 1)] for s in sets]
    return np.lexsort((second, first))


def width_for(largest: int) -> int:
    """Bits of the bitmaps of sets up to this size."""
    return 1 << min(16, max(10, (4 * largest).bit_length()))


def tree_links(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links that join the components of ``sets``: one for each joining, not all links."""
    order = in_tree_order(sets)
    sets = [sets[i] for i in order]
    sizes = np.array([len(x) for x in sets], np.int64)
    tree = Tree(bitmaps(sets, width_for(int(sizes.max()))), sizes)
    i, j = surviving_pairs(tree, tree, num, den)
    by_first = np.argsort(i, kind="stable")
    i, j = i[by_first], j[by_first]
    label, found = np.arange(len(sets)), []
    ends = np.flatnonzero(np.concatenate([i[1:] != i[:-1], [True]])) + 1 if len(i) else []
    begin = 0
    for end in ends:
        x, others = i[begin], j[begin:end]
        begin = end
        for y in others[label[others] != label[x]]:
            if label[y] != label[x] and linked(sets[x], sets[y], num, den):
                found.append((int(order[x]), int(order[y])))
                label[label == label[y]] = label[x]
    return found


def linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    common = np.intersect1d(x, y, assume_unique=True).size
    return common * (den + num) >= num * (len(x) + len(y))


def _once(rows: pa.Table) -> pa.Table:
    """The first row of each class."""
    first = {}
    for at, cid in enumerate(rows.column("cid").to_pylist()):
        first.setdefault(cid, at)
    return rows.take(pa.array(list(first.values()), pa.int64())) if len(first) < rows.num_rows else rows


def _matrix(bits: pa.ChunkedArray) -> np.ndarray:
    """Bitmaps of one width as the rows of a matrix."""
    return np.frombuffer(b"".join(x.as_buffer() for x in bits), "<u8").reshape(len(bits), -1)


def _pairs(a: list | pa.ChunkedArray, b: list | pa.ChunkedArray) -> pa.Table:
    return pa.table({"a": a, "b": b}, schema=pa.schema([("a", pa.binary()), ("b", pa.binary())]))


def _edges_of(num: int, den: int):
    """applyInArrow function: the joining links of one tree."""
    def run(rows: pa.Table) -> pa.Table:
        forget_worker_cache()  # of the words: trees hold token sets
        rows = _once(rows.select(["cid", "tokens"]))
        cids = rows.column("cid").to_pylist()
        if len(cids) < 2:
            return _pairs([], [])
        found = tree_links([np.frombuffer(x.as_buffer(), "<u8") for x in rows.column("tokens")], num, den)
        return _pairs([cids[x] for x, _ in found], [cids[y] for _, y in found])
    return run


def set_rows(docs: DataFrame, id_col: str, text_col: str, width: int, num: int, den: int) -> DataFrame:
    """id, row (64-bit hash of the text), n (set size), cid (digest of the set, null if empty), keys (slices)."""
    def run(batches):
        for batch in row_groups(batches):
            n, cid, keys = [], [], []
            for text in byte_rows(batch.column(1)):
                tokens = shingle_set(text, width)
                n.append(len(tokens))
                cid.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None)
                keys.append(slices(tokens, num, den))
            offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(cid, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["id", "row", "n", "cid", "keys"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), text_hash(F.col(text_col)).alias("row")) \
        .mapInArrow(run, f"id {id_type}, row long, n long, cid binary, keys array<long>")


def token_rows(texts: DataFrame, width: int) -> DataFrame:
    """cluster, cid, n, tokens of the rows (cluster, cid, text) whose text has that digest."""
    def run(batches):
        for batch in row_groups(batches):
            keep, n, packed = [], [], []
            for at, (cid, text) in enumerate(zip(batch.column(1).to_pylist(), byte_rows(batch.column(2)), strict=True)):
                tokens = shingle_set(text, width)
                data = tokens.tobytes()
                if hashlib.blake2b(data, digest_size=16).digest() == cid:
                    keep.append(at)
                    n.append(len(tokens))
                    packed.append(data)
            own = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(n, pa.int64()),
                                              pa.array(packed, pa.binary())], names=["cluster", "cid", "n", "tokens"])

    return texts.select("cluster", "cid", "text").mapInArrow(run, "cluster long, cid binary, n long, tokens binary")


def text_hash(text: Column) -> Column:
    """Tells rows with the same id apart."""
    return F.xxhash64(text)


def _short(cid):
    """A 64-bit name of a class, for grouping candidates only."""
    return F.xxhash64(cid)


def candidate_clusters(rows: DataFrame) -> DataFrame:
    """(node, component): classes (by short name) that may be linked, directly or in a chain.

    The keys are shuffled once and read in order: each class under a key is
    linked to the first one there, in passing, so a key of any number of classes
    needs no memory.
    """
    def run(batches):
        last = first = None
        for batch in batches:
            key, c = (batch.column(i).to_numpy() for i in (0, 1))
            if not len(key):
                continue
            fresh = np.concatenate([[last is None or key[0] != last], key[1:] != key[:-1]])
            at = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), -1))
            least = np.where(at >= 0, c[np.maximum(at, 0)], 0 if first is None else first)
            last, first = key[-1], least[-1]
            apart = c != least
            if apart.any():
                pairs = np.unique(np.stack([c[apart], least[apart]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    keys = rows.select(F.explode("keys").alias("key"), _short("cid").alias("c"))
    return components(keys.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long"))


def dealt(sets: DataFrame, salt: int, num: int, den: int) -> DataFrame:
    """Add the tree (band, slot) of each set, and whether its cluster is one tree (``whole``)."""
    clusters = sets.groupBy("cluster").agg(
        ((F.count("*") <= LEAF_SETS) & (F.sum("n") <= LEAF_TOKENS)).alias("whole"))
    sets = sets.join(broadcast_if_small(cut(clusters, "clusters"), 500_000), "cluster")
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(1.000001 * math.log(den / num))).cast("int")
    sets = sets.withColumn("band", F.when(F.col("whole"), F.lit(-1)).otherwise(band))
    bands = sets.where("NOT whole").groupBy("cluster", "band").agg(
        F.greatest(F.ceil(F.count("*") / LEAF_SETS), F.ceil(F.sum("n") / LEAF_TOKENS)).alias("slots"))
    sets = sets.join(broadcast_if_small(cut(bands, "bands"), 500_000), ["cluster", "band"], "left")
    slot = F.coalesce(F.pmod(F.xxhash64("cid", F.lit(salt)), F.col("slots")), F.lit(0))
    return sets.withColumn("slot", slot.cast("int"))


def links(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between the sets (cluster, cid, n, tokens; a cut) that give the components of all links."""
    find = _edges_of(num, den)
    tree = ["cluster", "band", "slot"]
    level = dealt(sets, 0, num, den)
    edges = cut(level.groupBy(*tree).applyInArrow(find, "a binary, b binary"), "links")
    large = cut(level.where("NOT whole").select("cluster", "cid", "n", "band").distinct(), "large")
    n_large = large.count()
    if not n_large:
        return edges

    # one set of each component found so far, dealt again, until that joins few more
    salt, was = 1, n_large
    while True:
        labelled = cut(_labelled(large, edges), "labelled")
        pivots = cut(labelled.groupBy("cluster", "band", "label").agg(F.min("cid").alias("cid")).select("cluster", "cid"), "pivots")
        n_pivots = pivots.count()
        if n_pivots * 2 > was:
            break
        was = n_pivots
        again = dealt(sets.join(broadcast_if_small(pivots, 500_000), ["cluster", "cid"], "left_semi"), salt, num, den)
        edges = cut(edges.union(again.groupBy(*tree).applyInArrow(find, "a binary, b binary")), "links")
        salt += 1
    return cut(edges.union(_across(labelled, sets, num, den)), "links")


def _labelled(sets: DataFrame, edges: DataFrame) -> DataFrame:
    """Add ``label``: the component of each set by the edges so far."""
    found = components(edges)
    return sets.join(found, F.col("cid") == F.col("node"), "left") \
        .withColumn("label", F.coalesce("component", "cid")).drop("node", "component")


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps narrowed to ``words`` 64-bit words."""
    return np.bitwise_or.reduce(bits.reshape(len(bits), -1, words), axis=1)


def _across(labelled: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between different trees of the same cluster; ``labelled`` has the component and band of each set.

    Trees are dealt anew, of sets whose bitmaps take up to ``ACROSS_BYTES``: a
    component that fills half a tree of its band has trees of its own, so a
    pair of trees of one component is skipped.
    Bitmaps alone are moved to the pairs of trees; the pairs of sets that the
    traversal leaves, between components, are verified on their tokens.
    """
    unit = 1.000001 * math.log(den / num)
    bits = F.least(F.lit(16), F.greatest(F.lit(10), F.length(F.bin(4 * F.ceil(F.exp((F.col("band") + 1) * unit))))))
    most = F.least(F.lit(ACROSS_SETS), F.floor(8 * ACROSS_BYTES / F.pow(F.lit(2), bits)))
    own = labelled.groupBy("cluster", "band", "label").agg(F.count("*").alias("own")).where(F.col("own") * 2 >= most)
    narrow = labelled.join(broadcast_if_small(own), ["cluster", "band", "label"], "left") \
        .withColumn("of", F.when(F.col("own").isNotNull(), F.col("label"))).drop("own")
    per = narrow.groupBy("cluster", "band", "of").agg(F.ceil(F.count("*") / F.first(most)).alias("slots")) \
        .select(F.col("cluster").alias("p_cluster"), F.col("band").alias("p_band"), F.col("of").alias("p_of"), "slots")
    narrow = narrow.join(broadcast_if_small(per), (F.col("cluster") == F.col("p_cluster")) & (F.col("band") == F.col("p_band"))
                         & F.col("of").eqNullSafe(F.col("p_of")))
    leaf = F.xxhash64("cluster", "band", "of", F.pmod(F.xxhash64("cid"), F.col("slots")))
    narrow = cut(narrow.withColumn("leaf", leaf).select("cid", "band", "label", "of", "leaf"), "leaves")

    def picture(batches):
        for batch in row_groups(batches, TOKEN_ROWS):
            bits = [bitmaps([np.frombuffer(x, "<u8")], width_for(math.ceil(math.exp((band + 1) * unit)))).tobytes()
                    for band, x in zip(batch.column(1).to_pylist(), batch.column(6).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], batch.column(7), pa.array(bits, pa.binary())],
                                             names=["cid", "band", "label", "of", "leaf", "cluster", "n", "bits"])

    body = narrow.join(sets.select(F.col("cid").alias("t_cid"), "cluster", "tokens", "n"), F.col("cid") == F.col("t_cid")) \
        .select("cid", "band", "label", "of", "leaf", "cluster", "tokens", "n")
    body = cut(body.mapInArrow(picture, "cid binary, band int, label binary, of binary, leaf long, cluster long, n long, "
                                        "bits binary"), "bitmaps")

    def root(rows: pa.Table) -> pa.Table:
        bits, n = _matrix(rows.column("bits")), rows.column("n").to_numpy()
        first = rows.select(["cluster", "leaf", "band", "of"]).slice(0, 1)
        for name, value in (("low", n.min()), ("high", n.max()), ("pop", np.bitwise_count(bits).sum(axis=1, dtype=np.int64).min())):
            first = first.append_column(name, pa.array([int(value)], pa.int64()))
        return first.append_column("bits", pa.array([np.bitwise_or.reduce(bits, axis=0).tobytes()], pa.binary()))

    roots = cut(body.groupBy("leaf").applyInArrow(
        root, "cluster long, leaf long, band int, of binary, low long, high long, pop long, bits binary"), "roots")
    other = roots.select(*[F.col(c).alias(f"o_{c}") for c in roots.columns])
    # equal bands once in either order, the next band from below: one equality on (cluster, band)
    pairs = roots.withColumn("to", F.explode(F.array(F.col("band"), F.col("band") + 1))) \
        .join(other, (F.col("cluster") == F.col("o_cluster")) & (F.col("to") == F.col("o_band"))) \
        .where((F.col("band") < F.col("o_band")) | (F.col("leaf") <= F.col("o_leaf"))) \
        .where(F.col("of").isNull() | F.col("o_of").isNull() | (F.col("of") != F.col("o_of")))

    def pair_trees(x: tuple, y: tuple) -> tuple[tuple, tuple]:
        words = min(x[0].shape[1], y[0].shape[1])
        return tuple((f, *z[1:3], np.bitwise_count(f).sum(axis=1, dtype=np.int64) if f.shape[1] < z[0].shape[1] else z[3])
                     for z in (x, y) for f in (_folded(z[0], words),))

    def prune(batches):
        for batch in row_groups(batches):
            kept = []
            for t in batch.to_pylist():
                x, y = ((np.frombuffer(t[p + "bits"], "<u8")[None], np.array([t[p + "low"]]), np.array([t[p + "high"]]),
                         np.array([t[p + "pop"]])) for p in ("", "o_"))
                # the least bit count of sets is not that of their folded bitmaps: bound by size alone then
                if len(t["bits"]) != len(t["o_bits"]):
                    x, y = ((_folded(z[0], 16), z[1], z[2], np.array([0])) for z in (x, y))
                if may_link(x, y, np.array([0]), np.array([0]), num, den)[0]:
                    kept.append((t["leaf"], t["o_leaf"]))
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], pa.int64()) for i in (0, 1)], names=["l", "r"])

    pairs = cut(pairs.select("leaf", "low", "high", "pop", "bits", "o_leaf", "o_low", "o_high", "o_pop", "o_bits")
                .mapInArrow(prune, "l long, r long"), "tree-pairs")

    def candidates(most: int):
        def run(rows: pa.Table) -> pa.Table:
            sides = []
            for k in (0, 1):
                part = _once(rows.filter(pc.equal(rows.column("side"), k)))
                if part.num_rows:
                    bits, sizes = _matrix(part.column("bits")), part.column("n").to_numpy()
                    sides.append((part, (bits, sizes, sizes, np.bitwise_count(bits).sum(axis=1, dtype=np.int64))))
            if len(sides) == 2:
                x, y = pair_trees(sides[0][1], sides[1][1])
                a, b = Tree(x[0], x[1]), Tree(y[0], y[1])
            else:
                a = b = Tree(sides[0][1][0], sides[0][1][1])
            one, two = sides[0][0], sides[-1][0]
            labels = {x: k for k, x in enumerate({*one.column("label").to_pylist(), *two.column("label").to_pylist()})}
            at, to = (np.array([labels[x] for x in side.column("label").to_pylist()]) for side in (one, two))
            i, j, more = pairs_apart(a, b, at, to, most, num, den)
            i, j = pa.array(i, pa.int64()), pa.array(j, pa.int64())
            pairs = pa.table({"a": one.column("cid").take(i), "b": two.column("cid").take(j),
                              "a_label": one.column("label").take(i), "b_label": two.column("label").take(j),
                              "l": pa.nulls(len(i), pa.int64()), "r": pa.nulls(len(i), pa.int64())})
            again = rows.select(["l", "r"]).slice(0, int(more))  # a row that names the trees
            return pa.concat_tables([pairs, again], promote_options="default")
        return run

    part = body.select("leaf", "cid", "label", "n", "bits")
    edges = joined = None
    most = FEW_PAIRS
    while True:
        now = part
        if joined is not None:
            now = part.join(broadcast_if_small(components(joined), 500_000), F.col("label") == F.col("node"), "left") \
                .withColumn("label", F.coalesce("component", "label")).drop("node", "component")
        left = pairs.join(now, F.col("l") == F.col("leaf")).select("l", "r", "cid", "label", "n", "bits", F.lit(0).alias("side"))
        right = pairs.where("l <> r").join(now, F.col("r") == F.col("leaf")) \
            .select("l", "r", "cid", "label", "n", "bits", F.lit(1).alias("side"))
        maybe = cut(left.union(right).groupBy("l", "r").applyInArrow(
            candidates(most), "a binary, b binary, a_label binary, b_label binary, l long, r long"), "candidates")
        found = cut(_verified(maybe.where("l IS NULL").drop("l", "r"), sets, num, den), "links")
        edges = found if edges is None else edges.union(found)
        pairs = maybe.where("l IS NOT NULL").select("l", "r")
        if pairs.isEmpty():
            return edges.select("a", "b")
        joined = edges.select(F.col("a_label").alias("a"), F.col("b_label").alias("b"))
        most *= FEW_PAIRS


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Of the pairs (a, b, a_label, b_label) of sets those that are linked; a task gives one of each two labels."""
    def run(batches):
        seen = set()
        for batch in row_groups(batches, TOKEN_ROWS):
            keep = []
            for at, (one, two, x, y) in enumerate(zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True)):
                labels = (min(one, two), max(one, two))
                if labels not in seen and linked(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), num, den):
                    seen.add(labels)
                    keep.append(at)
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(kept.columns[:4], names=["a", "b", "a_label", "b_label"])

    ends = broadcast_if_small(cut(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), "ends"), 500_000)
    tokens = sets.join(ends, "cid", "left_semi").select("cid", "tokens").dropDuplicates(["cid"])
    one, two = (tokens.select(F.col("cid").alias(f"{k}_cid"), F.col("tokens").alias(f"{k}_tokens")) for k in "ab")
    return pairs.join(one, F.col("a") == F.col("a_cid")).join(two, F.col("b") == F.col("b_cid")) \
        .select("a", "b", "a_label", "b_label", "a_tokens", "b_tokens") \
        .mapInArrow(run, "a binary, b binary, a_label binary, b_label binary")


def linked_classes(docs: DataFrame, width: int, num: int, den: int, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id, class (null for an empty set) and row (text hash) of every document."""
    with few_rows_at_once(docs.sparkSession):
        keyed = cut(set_rows(docs, id_col, text_col, width, num, den), "sets")
    clusters = candidate_clusters(keyed).withColumnRenamed("component", "cluster")
    rows = cut(keyed.drop("keys"), "rows")
    drop_cut(keyed)
    classes = cut(rows.where("cid IS NOT NULL").groupBy("cid").agg(F.min("id").alias("rep")), "classes")
    members = cut(classes.withColumn("node", _short("cid")).join(clusters, "node").select("cid", "rep", "cluster"),
                  "members")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .join(broadcast_if_small(members, 1_000_000), F.col("id").eqNullSafe(F.col("rep")))
    # under a repeated id there may be other texts: a class takes the one with its digest
    with few_rows_at_once(docs.sparkSession):
        sets = cut(token_rows(texts, width), "tokens")
        joining = links(sets, num, den)
    found = components(joining)

    joined = classes.select("cid", "rep").join(found, F.col("cid") == F.col("node"), "left") \
        .withColumn("class", F.coalesce("component", "cid")).select("cid", "rep", "class")
    least = joined.groupBy("class").agg(F.min("rep").alias("component_id"))
    by_class = cut(joined.join(least, "class").select(F.col("cid").alias("c_cid"), "class", "component_id"), "components")
    return rows.join(by_class, F.col("cid") == F.col("c_cid"), "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("cid").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"), "class", "row")


def one_of_each_class(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of which ``classes`` (of ``linked_classes``; a cut) has the first row of each class.

    First is the smallest id (null last), then the smallest text hash; of
    rows that repeat both, one stays.  Rows with an empty set all stay.
    """
    place = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), "row")
    of_class = classes.where("class IS NOT NULL").withColumn("place", place)
    first = of_class.groupBy("class").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = of_class.join(first, "class")
    names = [fresh_name(docs.columns, f"_dup_{x}") for x in ("id", "row", "text")]
    address = [F.col("place.id").alias(names[0]), F.col("place.row").alias(names[1])]
    others = cut(shared.where("place <> first").select(*address).distinct(), "duplicates")
    repeats = cut(shared.where("place = first").groupBy(*address).agg(F.count("*").alias("n")).where("n > 1")
                  .drop("n"), "repeats")
    rows = docs.withColumn(names[2], text_hash(F.col(text_col)))

    def at(side):
        return rows[id_col].eqNullSafe(side[names[0]]) & (rows[names[2]] == side[names[1]])

    others, repeats = (broadcast_if_small(x, 1_000_000) for x in (others, repeats))
    rows = rows.join(others, at(others), "left_anti")
    once = rows.join(repeats, at(repeats), "left_semi").dropDuplicates([id_col, names[2]])
    return rows.join(repeats, at(repeats), "left_anti").union(once).select(*docs.columns)
