"""Language-model scores of documents from an Elias-Fano n-gram trie (operator 13).

Model.  With c(w) the count of token w in the training documents, N and V
the number of tokens and of distinct tokens, and p1(w) = (c(w) + 0.5) / (N +
0.5 * (V + 1)):

    p(w | a) = (c(a, w) + strength * p1(w)) / (c(a) + strength)

where a is the token before w, or the start of the document, which counts
as often as there are training documents.  Over all known tokens and one
unknown one this sums to 1 after every context.

The trie has two levels, words and, under each word, the tokens it followed,
with the smoothed joint probability (c(a, w) + strength * p1(w)) / N
quantised to ``STEPS`` steps a decade (16 bits).  log10 p(w | a) is that,
plus log10 N, less log10(c(a) + strength).  Every token but the last of a
document is the context of the next, so the last term is paid by the token
itself, and every number that a word needs lies in its own shard.

At scale: tasks gather ``BLOCK_TOKENS`` tokens at a time, aggregate their
bigrams, and send them, Elias-Fano coded, to shards by a hash of w; with each
bigram go the documents of the block in which it occurs, so a shard builds its
trie from the training documents, looks up all bigrams and returns one
partial sum per document.  A word that holds more than ``HOT_SHARE`` of a
shard is spread over all shards by its contexts; the list of such words, with
their counts, is broadcast (at most 1 / HOT_SHARE words per shard).  The number
of shards follows from the size of the text.  Nothing is dropped: rare
bigrams, long texts and all documents take part.

Words are 64-bit hashes, contexts under a word ``CONTEXT_BITS`` bits.

Cases: a null or empty text has one token, the end; a null id counts as empty
text in the fold; a word that was not seen has c = 0 and its successor falls
back to p1; without training documents every score is 0; repeated rows are
scored each; very long texts are cut into pieces at white space, their
contexts kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.eliasfano import Sequence, Trie, build_trie, encode
from ledgerline.llm.util import byte_rows, row_groups, worker_cache

STRENGTH = 200.0
STEPS = 2048
SHARD_BYTES = 16 << 20
HOT_SHARE = 0.1
BLOCK_TOKENS = 1 << 20
PIECE_BYTES = 1 << 22
CONTEXT_BITS = 44
MAX_WORDS = 300_000

END, BEGIN = 1, 2
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


class Hashes(dict):
    """Word (bytes) -> 64-bit hash; forgets when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 48:
            self[word] = value
        return value


def word_hashes(text: bytes) -> np.ndarray:
    words = text.translate(_LOWER).split()
    return np.fromiter(map(worker_cache("lm word hashes", Hashes).__getitem__, words), np.uint64, len(words))


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The text in pieces that end at white space."""
    at = 0
    while len(text) - at > size:
        space = _SPACE.search(text, at + size)
        if space is None:
            break
        yield text[at:space.start()]
        at = space.start()
    yield text[at:]


def packed_ints(values: np.ndarray) -> bytes:
    """Non-negative whole numbers in as few bytes each as the largest needs."""
    width = next(w for w in (1, 2, 4, 8) if int(values.max(initial=0)) < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpacked_ints(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


def blocks(batches, block_tokens: int):
    """Token blocks of rows (id, text, learn): (block, first row, ids, learn flags, tokens per row here, words, contexts,
    slots).

    A row's number is its place in the task's input; a block holds some
    consecutive rows, the first or last maybe in part.
    """
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 40
    made = number
    ids, learn, count, words, contexts = [], [], [], [], []
    size, first = 0, number

    def block():
        slots = np.repeat(np.arange(len(count), dtype=np.int32), count)
        return (made, first, ids, np.array(learn, bool), np.array(count), np.concatenate(words), np.concatenate(contexts), slots)

    for batch in row_groups(batches):
        for row_id, text, flag in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1)), batch.column(2).to_pylist(),
                                      strict=True):
            parts, before, found = pieces(text or b""), BEGIN, False
            part = next(parts)
            while part is not None:
                following = next(parts, None)
                h = word_hashes(part)
                if following is None:
                    h = np.append(h, np.uint64(END))
                if len(h):
                    ids.append(row_id)
                    learn.append(flag)
                    count.append(len(h))
                    words.append(h)
                    contexts.append(np.concatenate([np.array([before], np.uint64), h[:-1]]))
                    before, size = h[-1], size + len(h)
                part = following
                # the next piece of a row is in a block of its own, so a block has a row once
                if count and (size >= block_tokens or part is not None):
                    yield block()
                    ids, learn, count, words, contexts = [], [], [], [], []
                    made, size, first = made + 1, 0, number if part is not None else number + 1
            number += 1
    if count:
        yield block()


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _mixed(h: np.ndarray) -> np.ndarray:
    return h * np.uint64(0x9E3779B97F4A7C15)


def word_counts(rows: DataFrame, shards: int, hot_at: int, block_tokens: int) -> DataFrame:
    """Per shard of the training words: tokens, words, and the words with at least ``hot_at`` tokens with their counts."""
    def run(batches):
        for _, _, _, learn, _, words, _, slots in blocks(batches, block_tokens):
            found, n = np.unique(words[learn[slots]], return_counts=True)
            cuts = np.searchsorted(shard_of(found, shards), np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(cuts)):
                mine = slice(cuts[s], cuts[s + 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int64()), pa.array([encode(found[mine])], pa.binary()),
                     pa.array([packed_ints(n[mine])], pa.binary())], names=["shard", "words", "counts"])

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        words, at = np.unique(np.concatenate([Sequence(x).all() for x in pdf["words"]]), return_inverse=True)
        n = np.bincount(at, np.concatenate([unpacked_ints(x) for x in pdf["counts"]])).astype(np.int64)
        hot = n >= hot_at
        return pd.DataFrame({"tokens": [int(n.sum())], "kinds": [len(words)], "hot": [words[hot].view(np.int64)],
                             "hot_n": [n[hot]]})

    return rows.where("learn").mapInArrow(run, "shard long, words binary, counts binary").groupBy("shard") \
        .applyInPandas(total, "tokens long, kinds long, hot array<long>, hot_n array<long>")


def bigrams(rows: DataFrame, shards: int, hot: np.ndarray, block_tokens: int) -> DataFrame:
    """Bigrams of each block and shard, with the rows in which they occur; ``hot``: ascending words to spread."""
    shared = rows.sparkSession.sparkContext.broadcast(hot)
    id_type = rows.schema["id"].dataType

    def run(batches):
        hot = shared.value
        for block, first, ids, learn, count, words, contexts, slots in blocks(batches, block_tokens):
            kinds, place = np.unique(words, return_inverse=True)
            key = (place.astype(np.uint64) << np.uint64(CONTEXT_BITS)) + (contexts >> np.uint64(64 - CONTEXT_BITS))
            order = np.argsort(key, kind="stable")  # rows stay in order within a bigram
            key, slot = key[order], slots[order]
            # (bigram, row) with how often, then the bigrams
            fresh = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (slot[1:] != slot[:-1])]))
            times = np.diff(np.append(fresh, len(key)))
            key, slot = key[fresh], slot[fresh]
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            pair, n_rows = key[begin], np.diff(np.append(begin, len(key)))
            word = (pair >> np.uint64(CONTEXT_BITS)).astype(np.int64)
            shard = shard_of(kinds, shards)[word]
            if len(hot):
                is_hot = np.isin(kinds, hot)[word]
                shard[is_hot] = shard_of(_mixed(pair[is_hot] << np.uint64(64 - CONTEXT_BITS)), shards)
            by_shard = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[by_shard], np.arange(shards + 1))
            per_row = np.repeat(np.arange(len(pair)), n_rows)
            row_order = np.argsort(shard[per_row], kind="stable")
            row_cuts = np.searchsorted(shard[per_row][row_order], np.arange(shards + 1))
            told = False
            for s in np.flatnonzero(np.diff(cuts)):
                mine, at = by_shard[cuts[s]:cuts[s + 1]], row_order[row_cuts[s]:row_cuts[s + 1]]
                own, local = np.unique(word[mine], return_inverse=True)
                local_key = (local.astype(np.uint64) << np.uint64(CONTEXT_BITS)) \
                    + (pair[mine] & np.uint64((1 << CONTEXT_BITS) - 1))
                values = [s, block, np.packbits(learn).tobytes(), len(learn), encode(kinds[own]), encode(local_key),
                          packed_ints(n_rows[mine]), packed_ints(slot[at]), packed_ints(times[at]),
                          None if told else first, None if told else ids, None if told else count.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow, strict=True)], schema=arrow)
                told = True

    arrow = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("learn", pa.binary()), ("slots", pa.int64()),
                       ("words", pa.binary()), ("pairs", pa.binary()), ("n_rows", pa.binary()), ("rows", pa.binary()),
                       ("times", pa.binary()), ("first", pa.int64()), ("ids", pa.list_(_arrow_type(id_type))), ("tokens", pa.list_(pa.int64()))])
    return rows.mapInArrow(run, f"shard long, block long, learn binary, slots long, words binary, pairs binary, n_rows binary, "
                                f"rows binary, times binary, first long, ids array<{id_type.simpleString()}>, tokens array<long>")


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def quantised(p: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-np.log10(p) * STEPS), 0, 65535).astype(np.uint16)


def trie_of(words: np.ndarray, word_of: np.ndarray, context: np.ndarray, n: np.ndarray, counts: np.ndarray, tokens: int,
            kinds: int, strength: float) -> bytes:
    """The trie of a shard: bigrams (place of the word, context, count; ascending) of words with their counts."""
    p1 = (counts + 0.5) / (tokens + 0.5 * (kinds + 1))
    return build_trie(words, counts, word_of, context, quantised((n + strength * p1[word_of]) / tokens))


def scored(pairs: DataFrame, tokens: int, kinds: int, hot: np.ndarray, hot_n: np.ndarray, strength: float) -> DataFrame:
    """Partial sums of each block and shard: known tokens, base and model log10 probabilities per row of the block."""
    shared = pairs.sparkSession.sparkContext.broadcast((hot, hot_n))
    id_type = pairs.schema["ids"].dataType.elementType

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        hot, hot_n = shared.value
        parts = []
        for r in pdf.itertuples(index=False):
            key = Sequence(r.pairs).all()
            learn = np.unpackbits(np.frombuffer(r.learn, np.uint8), count=r.slots)
            n_rows, slot, times = (unpacked_ints(x) for x in (r.n_rows, r.rows, r.times))
            begin = np.cumsum(n_rows, dtype=np.int64) - n_rows
            parts.append((Sequence(r.words).all(), (key >> np.uint64(CONTEXT_BITS)).astype(np.int64),
                          key << np.uint64(64 - CONTEXT_BITS), np.add.reduceat(times * learn[slot], begin, dtype=np.int64), n_rows, slot, times))
        # the trie of what is learned from
        words = np.unique(np.concatenate([w[np.bincount(at, n, len(w)) > 0] for w, at, _, n, *_ in parts]))
        sides = []
        for w, at, context, n, *_ in parts:
            seen = n > 0
            sides.append((np.searchsorted(words, w[at[seen]]), context[seen], n[seen]))
        word_of, context, n = (np.concatenate(x) for x in zip(*sides, strict=True))
        order = np.lexsort((context, word_of))
        word_of, context, n = word_of[order], context[order], n[order]
        fresh = np.flatnonzero(np.concatenate([[True], (word_of[1:] != word_of[:-1]) | (context[1:] != context[:-1])])) \
            if len(n) else np.zeros(0, np.int64)
        word_of, context, n = word_of[fresh], context[fresh], np.add.reduceat(n, fresh) if len(n) else n
        counts = np.bincount(word_of, n, len(words)).astype(np.int64)
        at = np.searchsorted(hot, words)
        is_hot = at < len(hot)
        is_hot[is_hot] = hot[at[is_hot]] == words[is_hot]
        counts[is_hot] = hot_n[at[is_hot]]
        trie = Trie(trie_of(words, word_of, context, n, counts, max(tokens, 1), kinds, strength))

        out = []
        for r, (w, at, context, _, n_rows, slot, times) in zip(pdf.itertuples(index=False), parts, strict=True):
            place = trie.word(w)
            c = np.where(place >= 0, trie.counts[place], 0) if len(trie.counts) else np.zeros(len(w), np.int64)
            # a hot word may be known by other shards only
            if len(hot):
                i = np.minimum(np.searchsorted(hot, w), len(hot) - 1)
                c = np.where(hot[i] == w, hot_n[i], c)
            p1 = (c + 0.5) / (tokens + 0.5 * (kinds + 1))
            code = trie.code(place[at], context)
            value = np.where(code >= 0, np.log10(max(tokens, 1)) - code / STEPS, np.log10(strength * p1)[at]) \
                - np.log10(c + strength)[at]
            sums = [np.bincount(slot, times * np.repeat(x, n_rows), r.slots)
                    for x in ((c > 0).astype(float)[at], np.log10(p1)[at], value)]
            out.append((r.block, r.shard, r.first, r.ids, r.tokens, packed_ints(sums[0].astype(np.int64)), sums[1].tobytes(), sums[2].tobytes()))
        return pd.DataFrame(out, columns=["block", "shard", "first", "ids", "tokens", "known", "base", "score"])

    return pairs.groupBy("shard").applyInPandas(
        run, f"block long, shard long, first long, ids array<{id_type.simpleString()}>, tokens array<long>, known binary, "
             "base binary, score binary")


def by_row(sums: DataFrame) -> DataFrame:
    """row, id, n_tokens, n_known, base_score, score of the rows of each block."""
    id_type = sums.schema["ids"].dataType.elementType

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        order = pdf.sort_values("shard")  # sums in one order, however rows arrive
        told = next(r for r in order.itertuples(index=False) if r.tokens is not None)
        n = len(told.tokens)
        return pd.DataFrame({
            "row": int(told.first) + np.arange(n), "id": list(told.ids), "n_tokens": np.asarray(told.tokens, np.int64),
            "n_known": np.sum([unpacked_ints(x) for x in order["known"]], axis=0).astype(np.int64),
            "base_score": np.sum([np.frombuffer(x, "<f8") for x in order["base"]], axis=0),
            "score": np.sum([np.frombuffer(x, "<f8") for x in order["score"]], axis=0)})

    return sums.groupBy("block").applyInPandas(
        run, f"row long, id {id_type.simpleString()}, n_tokens long, n_known long, base_score double, score double")


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", strength: float = STRENGTH,
          shard_bytes: int = SHARD_BYTES, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Score every document under the model of those for which ``learn`` holds.

    Returns id, n_tokens, n_known, train_tokens, base_score, score.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    hot_at = max(1, int(HOT_SHARE * shard_bytes / 6))  # a token is about six bytes
    found = word_counts(rows, shards, hot_at, block_tokens).collect()  # one row a shard
    tokens, kinds = sum(r["tokens"] for r in found), sum(r["kinds"] for r in found)
    hot = np.array([w for r in found for w in r["hot"]], np.int64).view(np.uint64)
    hot_n = np.array([n for r in found for n in r["hot_n"]], np.int64)
    order = np.argsort(hot)
    sums = scored(bigrams(rows, shards, hot[order], block_tokens), tokens, kinds, hot[order], hot_n[order], strength)
    # a very long text is several rows here
    whole = by_row(sums).groupBy("row").agg(F.first("id").alias("id"), *[F.sum(c).alias(c) for c in (
        "n_tokens", "n_known", "base_score", "score")])
    return whole.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                        "base_score", "score")


def held_out(doc_id: Column) -> Column:
    """The fold that is not learned from: crc32 of the id as text leaves 1 when divided by 5 (a null id: empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1
