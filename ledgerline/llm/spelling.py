"""Spelling variants by dynamic programming over a sorted vocabulary (operator 12).

Method.  The vocabulary is sorted and cut into tiles of ``TILE_WORDS`` words.
A word is compared with a tile by one scan: the rows of the edit matrix (a
band of three cells: one edit needs no more) are kept for the prefix of the
word last seen, so the next word starts at the row of the prefix that the two
share; and as soon as all cells of a row exceed one edit, all words with
that prefix are passed over at once.

Two words within one edit share the first half of the shorter one, or the
second half.  The vocabulary is scanned twice, as it is and reversed, and a
word is only compared with the words after it that share its first half.
These follow it in its own tile, except for the last words of a tile: they
are sent on to the tiles where their half goes on, less those whose common
prefix is more than one edit away.  So a prefix that a third of all words share
is many tiles, each a piece of work of its own, and a word is sent only to
those where it may have a neighbour.

``vocabulary`` counts words per text before anything is shuffled.  A chain
of forms is followed by doubling its steps; a form is at least ``ratio``
times as frequent as its word, so chains are short.

Bounds: what is broadcast is one row per tile (its first word and common
prefix, ``EDGE`` code points each); tiles grow with the vocabulary so that
there are at most ``MAX_TILES`` of them beside one per partition.

Cases: a null text has no words; a null id counts as empty text before the
colon; ties between forms go to the smallest word in code-point order;
repeated rows count each; words of any length are compared whole; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.util import byte_rows, row_groups
from ledgerline.plans.lineage import cut, drop_cut

RUN = re.compile("[A-Za-zÀ-ÿ]+")
TILE_WORDS = 10_000
MAX_TILES = 20_000
EDGE = 64
FLUSH_WORDS = 200_000
LONG_TEXT = 1 << 22
LAST = "\U0010FFFF"

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def damaged(id_crc: int, run: str, every: int) -> str:
    """The run, without one of its code points if the crc32 of '<id>:<run>' is divisible by ``every``."""
    h = zlib.crc32(run.encode(), id_crc)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def runs_of(text: bytes) -> Counter:
    """How often each run of letters occurs, A-Z lower-cased; a very long text is not held as a list of runs."""
    plain = text.translate(_LOWER).decode()
    if len(plain) < LONG_TEXT:
        return Counter(RUN.findall(plain))
    return Counter(m.group() for m in RUN.finditer(plain))


def vocabulary(docs: DataFrame, min_chars: int, min_count: int, damage_every: int) -> DataFrame:
    """word, n of all runs of letters of at least ``min_chars`` code points that occur ``min_count`` times."""
    def run(batches):
        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                              names=["word", "n"])
        total: Counter = Counter()
        for batch in row_groups(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1)), strict=True):
                id_crc = zlib.crc32(doc_id.encode() + b":")
                for word, n in runs_of(text).items():
                    if len(word) >= min_chars:
                        word = damaged(id_crc, word, damage_every)
                        if len(word) >= min_chars:
                            total[word] += n
                if len(total) >= FLUSH_WORDS:
                    yield rows()
                    total.clear()
        if total:
            yield rows()

    return docs.where("text IS NOT NULL").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text") \
        .mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    i = 0
    while a[i] == b[i]:
        i += 1
    return i


def next_row(row: tuple, q: str, d: int, c: str) -> tuple:
    """The band after letter ``c`` at depth ``d`` (1 for the first): edits to the first d-1, d and d+1 letters of q."""
    a, b, c2 = row
    m = len(q)
    low = min(a + (d < 2 or d - 2 >= m or c != q[d - 2]), b + 1)
    mid = min(b + (d - 1 >= m or c != q[d - 1]), c2 + 1, low + 1) if d <= m else 2
    high = min(c2 + (c != q[d]), mid + 1) if d < m else 2
    return low, mid, high


def may_be_near(q: str, prefix: str, half: int) -> bool:
    """Whether a word with this prefix can be within one edit of q, both having the first ``half`` letters of q."""
    row = (1, 0, 1)
    for d in range(half + 1, len(prefix) + 1):
        row = next_row(row, q, d, prefix[d - 1])
        if min(row) > 1:
            return False
    return True


def least_half(q: str) -> int:
    """Letters that q shares at least with a word after it that shares half of the shorter of both."""
    return (len(q) - 1) // 2


def scan(q: str, words: list[str], lcp: list[int], start: int) -> Iterator[int]:
    """Places from ``start`` on of the words that begin with q's first half and are one edit from q."""
    half, m, size = least_half(q), len(q), len(words)
    head = q[:half]
    rows = [(1, 0, 1)]  # rows[d - half] after the first d letters of the word at hand
    at, same = start, half
    while at < size and (lcp[at] >= half if at > start else words[at].startswith(head)):
        word = words[at]
        del rows[same - half + 1:]
        d, row = same, rows[-1]
        end = min(len(word), m + 2)
        while d < end:
            d += 1
            row = next_row(row, q, d, word[d - 1])
            rows.append(row)
            if row[0] > 1 and row[1] > 1 and row[2] > 1:
                break
        if min(row) > 1 or d < len(word):  # pass over all words with these d letters
            to = at + 1
            if to < size and lcp[to] >= d:
                to = bisect_left(words, word[:d] + LAST, to)
                if to < size and not words[to].startswith(head):
                    return
                same = max(half, min(d, shared(word[:d], words[to]))) if to < size else half
                at = to
                if at < size and lcp[at] < half:
                    return
                continue
        elif abs(m - d) <= 1 and row[m - d + 1] == 1:
            yield at
        at += 1
        if at < size:
            same = max(half, min(lcp[at], d))


def near_pairs(q: str, words: list[str], lcp: list[int], start: int, reverse: bool) -> Iterator[int]:
    """Places of the neighbours of q that this direction has to find: the other finds the rest."""
    for at in scan(q, words, lcp, start):
        w = words[at]
        a = min(len(q), len(w)) // 2
        if not reverse:
            if shared(q, w) >= a:
                yield at
        elif shared(q[::-1], w[::-1]) < a:
            yield at


def prefix_lengths(words: list[str]) -> list[int]:
    return [0, *(shared(a, b) for a, b in zip(words, words[1:], strict=False))]


def tiles(words: DataFrame, tile_words: int) -> DataFrame:
    """The vocabulary (word, n), forward and reversed, as rows (tile, reverse, words, ns) in order of (reverse, tile)."""
    both = words.select(F.lit(False).alias("reverse"), "word", "n").union(
        words.select(F.lit(True), F.reverse("word"), "n"))
    arrow = pa.schema([("tile", pa.int64()), ("reverse", pa.bool_()), ("words", pa.list_(pa.string())), ("ns", pa.list_(pa.int64()))])

    def pack(batches):
        task = TaskContext.get()
        tile, side, words, ns = (task.partitionId() if task else 0) << 32, None, [], []

        def row():
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip([tile, side, words, ns], arrow, strict=True)],
                                              schema=arrow)
        for batch in batches:
            for reverse, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if words and (side != reverse or len(words) >= tile_words):
                    yield row()
                    tile, words, ns = tile + 1, [], []
                side = reverse
                words.append(word)
                ns.append(n)
        if words:
            yield row()

    return both.repartitionByRange("reverse", "word").sortWithinPartitions("reverse", "word").mapInArrow(
        pack, "tile long, reverse boolean, words array<string>, ns array<long>")


def neighbours(words: DataFrame, tile_words: int = TILE_WORDS) -> DataFrame:
    """word, n, near, near_n: every pair of words (of a cut: word, n) that differ by exactly one edit, once."""
    tile_words = max(tile_words, words.count() // MAX_TILES)
    packed = cut(tiles(words, tile_words), "word-tiles")
    first, last = F.get("words", F.lit(0)), F.element_at("words", -1)
    edges = sorted(packed.select("tile", "reverse", F.substring(first, 1, EDGE).alias("first"),
                                 F.substring(last, 1, EDGE).alias("last")).collect(), key=lambda r: r["tile"])
    board = words.sparkSession.sparkContext.broadcast(
        [(r["tile"], r["reverse"], r["first"], r["first"][:shared(r["first"], r["last"])]) for r in edges])

    def onward(batches):
        """The words of a tile whose first half goes on in later tiles: rows of (tile they are sent to, words, ns)."""
        places = {t: i for i, (t, *_) in enumerate(board.value)}
        for batch in batches:
            for tile, reverse, words, ns in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = places[tile] + 1
                while at < len(board.value):
                    to, side, start, prefix = board.value[at]
                    on = [i for i, q in enumerate(words) if start.startswith(q[:least_half(q)][:EDGE])] if side == reverse else []
                    if not on:
                        break
                    sent = [i for i in on if may_be_near(words[i], prefix, least_half(words[i]))]
                    if sent:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([to], pa.int64()), pa.array([reverse], pa.bool_()), pa.array([[words[i] for i in sent]]),
                             pa.array([[ns[i] for i in sent]], pa.list_(pa.int64()))], names=["tile", "reverse", "words", "ns"])
                    at += 1

    work = packed.withColumn("sent", F.lit(False)).union(
        packed.mapInArrow(onward, packed.schema).withColumn("sent", F.lit(True)))

    def run(batches):
        tile = words = ns = lcp = None
        for batch in batches:
            for number, reverse, mine, mine_ns, sent in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not sent:
                    tile, words, ns, lcp = number, mine, mine_ns, prefix_lengths(mine)
                elif number != tile:
                    raise ValueError("a tile came after the words sent to it")
                out = []
                for i, q in enumerate(mine):
                    out += [(i, at) for at in near_pairs(q, words, lcp, 0 if sent else i + 1, reverse)]
                for k in range(0, len(out), 50_000):
                    part = out[k:k + 50_000]
                    pair = [[mine[i] for i, _ in part], [words[j] for _, j in part]]
                    if reverse:
                        pair = [[w[::-1] for w in side] for side in pair]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pair[0], pa.string()), pa.array([mine_ns[i] for i, _ in part], pa.int64()),
                         pa.array(pair[1], pa.string()), pa.array([ns[j] for _, j in part], pa.int64())],
                        names=["word", "n", "near", "near_n"])

    # a tile is little data and much work: as many tasks as tiles, not fewer by their bytes
    pairs = cut(work.repartition(max(1, len(edges)), "tile").sortWithinPartitions("tile", "sent").mapInArrow(
        run, "word string, n long, near string, near_n long"), "near-words")
    board.destroy()
    drop_cut(packed)
    return pairs


def roots(forms: DataFrame) -> DataFrame:
    """word, root of every word (word, form; a cut) that has a form: the end of its chain of forms."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        far = cut(at.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                       F.col("further").isNotNull().alias("moved")), "word-roots")
        moved = far.where("moved").limit(1).count()
        at = far.select("word", "root")
        if not moved:
            return at


def variants(words: DataFrame, ratio: int = 5, tile_words: int = TILE_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word (of a cut: word, n)."""
    pairs = neighbours(words, tile_words)
    both = pairs.union(pairs.select("near", "near_n", "word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near")))
    found = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"), F.first("n").alias("n"))
    found = cut(found.select("word", "n_near", (-F.col("best.n")).alias("form_n"), F.col("best.near").alias("form"),
                             (-F.col("best.n") >= ratio * F.col("n")).alias("follows")), "word-forms")
    drop_cut(pairs)
    forms = cut(found.where("follows").select("word", "form", "form_n"), "forms")
    ends = roots(forms)
    return words.join(found.select("word", "n_near"), "word", "left").join(forms, "word", "left").join(ends, "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                "form_n")


def group_variants(docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5, damage_every: int = 199) -> DataFrame:
    """The spelling variants among the words of whole documents (doc_id, text)."""
    return variants(cut(vocabulary(docs, min_chars, min_count, damage_every), "vocabulary"), ratio)
