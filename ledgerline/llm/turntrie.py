"""Prefix trie of conversations by adaptive radix trees (operator 11).

A turn is a fixed-width big-endian number: 16 bytes of the digest of its
role and text, then its number of words in 4.  A conversation is the bytes
of its turns, and conversations with a common start share the nodes of it.

Method.  Conversations with the same turns become one key first.  The keys
are range-partitioned, sorted, and packed into tiles of ``TILE_BYTES``.  In a
tile they are inserted into an adaptive radix tree: nodes hold up to 16
children in sorted lists, up to 48 behind an index of 256 bytes, and beyond
that a table of 256; an edge holds all bytes on which nothing branches.  The
tree branches at any byte, but only depths that are whole turns are nodes of
the result.

At scale: a node belongs to more than one tile only if it is a prefix of
the last key of one and the first key of the next.  Every tile knows how many
turns its first and last key share with its neighbours, so it counts a node,
child or leaf only if no tile before it does; all other nodes are complete
in their tile, and the few shared ones are added up by the digest of their
prefix.  No key is hot: a first turn that a third of all conversations share
is spread over tiles, and copies of one conversation are one row (their ids
arrive as texts of up to ``ID_RANGE`` ids and pass through the hash of their
node in order, one after another).  A task holds one tile; a conversation is
held whole, at 20 bytes a turn.

Cases: a null role or text is empty; turns are ordered by number, null
first, ties by their digest; repeated rows are turns of their own; rows
without conversation id are left out; a null or empty text has no words;
conversations without turns end at the root; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.util import word_count
from ledgerline.plans.lineage import cut, drop_cut

ID_BYTES, WIDTH = 16, 20
TILE_BYTES = 4 << 20
ID_RANGE = 1 << 16
NO_IDS = hashlib.sha256(b"").hexdigest()


class Node:
    """A tree node; ``edge`` are the bytes from its parent, ``value`` what ends here.

    ``index`` and ``kids`` are one of three layouts: sorted bytes beside
    children (up to 16), a table of 256 places in ``kids`` (up to 48), or no
    index and 256 places.
    """
    __slots__ = ("edge", "value", "index", "kids")

    def __init__(self, edge: bytes, value=None):
        self.edge, self.value = edge, value
        self.index, self.kids = bytearray(), []

    def get(self, byte: int) -> Node | None:
        if self.index is None:
            return self.kids[byte]
        if len(self.index) == 256:
            at = self.index[byte]
            return self.kids[at - 1] if at else None
        at = self.index.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, child: Node) -> None:
        """Add a child, or replace the one at this byte."""
        if self.index is None:
            self.kids[byte] = child
        elif len(self.index) == 256:
            if self.index[byte]:
                self.kids[self.index[byte] - 1] = child
            elif len(self.kids) < 48:
                self.kids.append(child)
                self.index[byte] = len(self.kids)
            else:
                table = [None] * 256
                for b, at in enumerate(self.index):
                    if at:
                        table[b] = self.kids[at - 1]
                table[byte] = child
                self.index, self.kids = None, table
        elif (at := self.index.find(byte)) >= 0:
            self.kids[at] = child
        elif len(self.kids) < 16:
            at = sum(b < byte for b in self.index)
            self.index.insert(at, byte)
            self.kids.insert(at, child)
        else:
            table = bytearray(256)
            for at, b in enumerate(self.index):
                table[b] = at + 1
            self.index = table
            self.put(byte, child)

    def children(self) -> list[Node]:
        """In the order of their bytes."""
        if self.index is None:
            return [k for k in self.kids if k is not None]
        if len(self.index) == 256:
            return [self.kids[at - 1] for at in self.index if at]
        return self.kids


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def insert(root: Node, key: bytes, value) -> None:
    node, at = root, 0
    while at < len(key):
        child = node.get(key[at])
        if child is None:
            node.put(key[at], Node(key[at:], value))
            return
        edge = child.edge
        same = len(edge) if key.startswith(edge, at) else common(edge, key[at:at + len(edge)])
        if same < len(edge):
            upper = Node(edge[:same])
            child.edge = edge[same:]
            upper.put(child.edge[0], child)
            node.put(key[at], upper)
            child = upper
        node, at = child, at + same
    node.value = value


def turn_nodes(root: Node, width: int = WIDTH) -> Iterator[tuple[int, int, int, object]]:
    """(depth, parent's place or -1, words, value) of every node at a whole number of turns, parents first."""
    yield 0, -1, 0, root.value
    made = 1
    todo = [(child, 0, 0) for child in reversed(root.children())]
    while todo:
        node, start, parent = todo.pop()
        end = start + len(node.edge)
        for at in range((start // width + 1) * width, end + 1, width):
            words = int.from_bytes(node.edge[at - start - (width - ID_BYTES):at - start], "big")
            yield at // width, parent, words, node.value if at == end else None
            parent = made
            made += 1
        todo.extend((child, end, parent) for child in reversed(node.children()))


def prefix_names(key: bytes, upto: int) -> list[bytes]:
    """Digests that name the prefixes of 0 to ``upto`` turns."""
    h, out = hashlib.sha256(), []
    for d in range(upto + 1):
        out.append(h.digest()[:16])
        h.update(key[d * WIDTH:(d + 1) * WIDTH])
    return out


def tile_nodes(keys: list[bytes], convs: list[int], ns: list[int], ends: list[str], lead: int, follow: int) -> list[tuple]:
    """Nodes of one tile of sorted keys: (name, parent's name, shared, conv, depth, parent's conv, n, children, leaves,
    saved, ends).

    ``lead`` and ``follow``: how many turns the first key shares with the
    key before the tile and the last one with the key after it, -1 if there is none.
    Names are given for shared nodes and for parents that are shared.
    """
    root = Node(b"")
    for i, key in enumerate(keys):
        insert(root, key, i)
    nodes = list(turn_nodes(root))
    size = len(nodes)
    first, last = len(keys[0]) // WIDTH, len(keys[-1]) // WIDTH
    name: list = [None] * size
    owned = [1] * size
    for d, x in enumerate(prefix_names(keys[0], min(lead, first))):
        name[d], owned[d] = x, 0
    at = size - 1
    names = prefix_names(keys[-1], min(follow, last))
    for d in range(last, -1, -1):
        if d < len(names):
            name[at] = names[d]
        at = nodes[at][1]
    n, conv, kids, leaves, saved = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size
    for i in range(size - 1, -1, -1):
        _, parent, words, value = nodes[i]
        if value is not None:
            n[i] += ns[value]
            conv[i] = convs[value] if conv[i] is None else min(conv[i], convs[value])
        if not kids[i] and value is not None and not (i == size - 1 and follow == last):
            leaves[i] = 1
        saved[i] += (n[i] - owned[i]) * words
        if parent >= 0:
            n[parent] += n[i]
            conv[parent] = conv[i] if conv[parent] is None else min(conv[parent], conv[i])
            kids[parent] += owned[i]
            leaves[parent] += leaves[i]
            saved[parent] += saved[i]
    out = []
    for i, (depth, parent, _, value) in enumerate(nodes):
        open_parent = parent >= 0 and name[parent] is not None
        out.append((name[i], name[parent] if open_parent else None, name[i] is not None, conv[i], depth,
                    None if parent < 0 or open_parent else conv[parent], n[i], kids[i], leaves[i], saved[i],
                    None if value is None else ends[value]))
    return out


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv, key of every conversation: the first h turns of conversation c - c % 20, then its own after its first h."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    words = word_count(text)
    digest = F.substring(F.sha2(F.concat(F.octet_length(role), F.lit(":"), role, text), 256), 1, 2 * ID_BYTES)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn",
        F.concat(digest, F.lpad(F.hex(words), 8, "0")).alias("id"))
    turns = turns.withColumn("base", F.col("conv") - F.col("conv") % 20)
    # one shuffle by base serves both the conversations and the bases' first turns
    whole = turns.repartition("base").groupBy("base", "conv").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("turn", "id"))), lambda t: t["id"]).alias("own"))
    first = F.max(F.when(F.col("conv") == F.col("base"), F.slice("own", 1, 3))).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).cast("int")
    ids = F.concat(F.slice(F.coalesce(first, F.array().cast("array<string>")), F.lit(1), h),
                   F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0))))
    return whole.select("conv", F.unhex(F.array_join(ids, "")).alias("key"))


def tiles(convs: DataFrame, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """Sorted tiles of distinct keys; what a tile shares with others of its partition is counted here."""
    chunks = convs.groupBy("key", F.floor(F.col("conv") / ID_RANGE).alias("range")).agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"),
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def sequences(batches):
        """(key, smallest id, members, hash of ids) of each run of rows with one key."""
        now = None
        for batch in batches:
            for key, conv, n, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and now[0] == key:
                    now[3].update(b"," + ids.encode())
                    now[2] += n
                else:
                    if now is not None:
                        yield now
                    now = [key, conv, n, hashlib.sha256(ids.encode())]
        if now is not None:
            yield now

    def row(pid, number, rows, lead, follow):
        keys, convs, ns, ends = zip(*rows, strict=True)
        values = [pid << 32 | number, pid, number, lead, follow, keys[0], keys[-1], list(keys), list(convs), list(ns), list(ends)]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow, strict=True)], schema=arrow)

    arrow = pa.schema([("tile", pa.int64()), ("pid", pa.int64()), ("number", pa.int64()), ("lead", pa.int64()),
                       ("follow", pa.int64()), ("first", pa.binary()), ("last", pa.binary()), ("keys", pa.list_(pa.binary())),
                       ("convs", pa.list_(pa.int64())), ("ns", pa.list_(pa.int64())), ("ends", pa.list_(pa.string()))])

    def pack(batches):
        task = TaskContext.get()
        pid, number, rows, size, lead = task.partitionId() if task else 0, 0, [], 0, None
        for key, conv, n, h in sequences(batches):
            if size >= tile_bytes:
                shared = common(rows[-1][0], key) // WIDTH
                yield row(pid, number, rows, lead, shared)
                number, rows, size, lead = number + 1, [], 0, shared
            rows.append((key, conv, n, h.hexdigest()))
            size += len(key) + 100
        if rows:
            yield row(pid, number, rows, lead, None)

    return chunks.repartitionByRange("key").sortWithinPartitions("key", "range").select("key", "conv", "n", "ids").mapInArrow(
        pack, "tile long, pid long, number long, lead long, follow long, first binary, last binary, keys array<binary>, "
              "convs array<long>, ns array<long>, ends array<string>")


def trie(conversations: DataFrame, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    packed = cut(tiles(rebuilt(conversations), tile_bytes), "turn-tiles")
    # one row per partition: the keys beside its first and last tile
    order = Window.orderBy("pid")
    sides = packed.groupBy("pid").agg(F.min_by("first", "number").alias("a"), F.max_by("last", "number").alias("z")) \
        .select("pid", F.lag("z").over(order).alias("before"), F.lead("a").over(order).alias("after"))

    schema = ("tile long, name binary, p_name binary, shared boolean, conv long, depth long, p_conv long, n long, children long, "
              "leaves long, saved long, ends string")
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.bool_(), *[pa.int64()] * 7, pa.string()]
    columns = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for t in range(batch.num_rows):
                tile, lead, follow, keys, convs, ns, ends, before, after = (c[t].as_py() for c in batch.columns)
                lead = lead if lead is not None else -1 if before is None else common(before, keys[0]) // WIDTH
                follow = follow if follow is not None else -1 if after is None else common(keys[-1], after) // WIDTH
                nodes = tile_nodes(keys, convs, ns, ends, lead, follow)
                for at in range(0, len(nodes), 20_000):
                    part = list(zip(*nodes[at:at + 20_000], strict=True))
                    part.insert(0, (tile,) * len(part[0]))
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(part, kinds, strict=True)], names=columns)

    nodes = cut(packed.join(sides, "pid").select("tile", "lead", "follow", "keys", "convs", "ns", "ends", "before", "after")
                .mapInArrow(run, schema), "turn-nodes")
    drop_cut(packed)
    shared = nodes.where("shared")
    merged = cut(shared.groupBy("name").agg(
        F.min("conv").alias("conv"), F.min("depth").alias("depth"), F.max("p_name").alias("p_name"),
        *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")], F.max("ends").alias("ends")), "shared-nodes")
    above = merged.select(F.col("name").alias("p_name"), F.col("conv").alias("above"))
    # parents by (tile, name): no parent is a hot key, however many children it has
    known = shared.select("tile", F.col("name").alias("p_name")).join(above, "p_name")
    inner = nodes.where("NOT shared AND p_name IS NOT NULL").join(known, ["tile", "p_name"]).withColumn("p_conv", F.col("above"))
    top = merged.join(above, "p_name", "left").withColumn("p_conv", F.col("above"))
    columns = ["conv", "depth", "p_conv", "n", "children", "leaves", "saved", "ends"]
    whole = nodes.where("NOT shared AND p_name IS NULL").select(columns).union(inner.select(columns)).union(top.select(columns))
    return whole.select(F.col("conv").alias("conv_id"), "depth", F.col("p_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_IDS)).alias("ends_sha256"))
