"""Language identification by prediction by partial matching (operator 1).

Method.  For every language a tree of byte contexts up to ``ORDER`` bytes
long holds how often each byte followed each context.  A byte is coded in
the longest context the language knows; if the byte never followed it, an
escape is coded and the next shorter context is tried, down to all 256
bytes alike.  With n bytes seen after a context, t different ones, a byte
seen c times costs log2((n + t) / c) bits and the escape log2((n + t) / t)
(method C, no exclusion).  The statistics are frozen after training, so the
code length of a text is a plain sum over its bytes, and the language with
the shortest code wins; the score is that language's share when each is
given probability 2**-length.

Vectorised: the trees of all languages are merged; for every node (a byte
string that occurs in some language) the cost of its last byte after its
other bytes and the cost of the escapes are tabulated per language.  A
text's code length is then the sum over its positions of
``cost[longest known string ending here] + escapes[longest context]``, one
gather each, exactly the step-by-step code.

Training uses at most ``SAMPLE_SEGMENTS`` segments of ``SEGMENT_CHARS``
characters over all languages (an equal share for each, less of each beyond
four languages; those with the smallest text hash, repeated segments once):
that bounds the model, which is built in a task, collected once and broadcast.  Scoring reads every whole text.

Cases: null or empty text, or one without any letter, is ``und`` with score
0, as is every text if nothing was learned; ties go to the language first
by code point; rows with a null language are not learned from; repeated
rows are scored one by one; more than ``MAX_LANGUAGES`` languages raise a
ValueError; other columns are kept as they are.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.util import byte_rows, fresh_name, row_groups
from ledgerline.plans.lineage import cut, drop_cut

ORDER = 4
SAMPLE_SEGMENTS = 1024
SEGMENT_CHARS = 4096
MAX_LANGUAGES = 200
UNDETERMINED = "und"
BLOCK_BYTES = 1 << 18
PART_BYTES = 1 << 23
REJECT_BITS = 64

_TAG = np.int64(1) << np.int64(8 * (ORDER + 1))  # a string of k bytes is the number k * _TAG + its bytes


def sample_size(languages: int, segments: int, segment_chars: int) -> tuple[int, int]:
    """Segments per language and characters per segment.

    The model has a table of strings by languages: beyond four languages the
    sample shrinks as their number grows, so that characters times languages stay below
    4 * ``segments`` * ``segment_chars``.
    """
    chars = max(1, min(segments * segment_chars // languages, 4 * segments * segment_chars // languages ** 2))
    return max(1, chars // segment_chars), min(segment_chars, chars)


def sample(labelled: DataFrame, segments: int, segment_chars: int) -> tuple[list[str], DataFrame]:
    """The languages, and at most ``segments`` segments (lang, text) of the labelled rows (lang, text)."""
    names = [r["lang"] for r in labelled.select("lang").where("lang IS NOT NULL").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    labelled = labelled.where("lang IS NOT NULL AND length(text) > 0")
    if not names:
        return [], labelled.select("lang", "text")
    share, segment_chars = sample_size(len(names), segments, segment_chars)
    # one pass over each text, however long
    parts = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{segment_chars}}}"), F.lit(0))
    segs = labelled.select("lang", F.explode(parts).alias("text")).withColumn("h", F.xxhash64("text"))
    # hashes alone are moved and ranked; the texts of the few that are chosen are read again
    hashes = cut(segs.select("lang", "h").distinct(), "segment-hashes")
    # of a language with many segments only those below a hash that leaves about four shares are ranked
    limits = []
    for r in hashes.groupBy("lang").agg(F.count("*").alias("n")).collect():
        few = 4 * share + 256
        limits += [F.lit(r["lang"]), F.lit((1 << 63) - 1 if r["n"] <= few else -(1 << 63) + (few << 64) // r["n"])]
    limit = F.element_at(F.create_map(*limits), F.col("lang")) if limits else F.lit(0)
    first = Window.partitionBy("lang").orderBy("h")
    chosen = hashes.where(F.col("h") <= limit).withColumn("rank", F.row_number().over(first)) \
        .where(F.col("rank") <= share).select("lang", "h")
    texts = segs.join(F.broadcast(chosen), ["lang", "h"]).dropDuplicates(["lang", "h"]).select("lang", "text")
    texts = cut(texts.coalesce(4), "training-segments")
    drop_cut(hashes)
    return sorted(names), texts


def strings(block: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """The number of the k bytes that end at each position, or 0 where the text has fewer."""
    out = np.full(len(block), np.int64(k) * _TAG)
    for j in range(k):  # j bytes back
        out[j:] += block[:len(block) - j].astype(np.int64) << np.int64(8 * j)
    for j in range(k - 1):  # too near a start
        at = starts + j
        out[at[at < len(block)]] = 0
    return out


def count_strings(segments: DataFrame, order: int = ORDER) -> DataFrame:
    """How often each byte string of 1 to ``order`` + 1 bytes occurs in each language: lang, string, n."""
    def run(batches):
        texts: dict = {}  # a task holds its part of the sample, so a string is one row per task and language
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1)), strict=True):
                if text:
                    texts.setdefault(lang, []).append(text)
        for lang, mine in sorted(texts.items()):
            block = np.frombuffer(b"".join(mine), np.uint8)
            starts = np.cumsum([0, *map(len, mine[:-1])])
            for k in range(1, order + 2):
                found, n = np.unique(strings(block, starts, k), return_counts=True)
                found, n = found[found > 0], n[found > 0]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int64()),
                                                  pa.array(n, pa.int64())], names=["lang", "string", "n"])

    return segments.mapInArrow(run, "lang string, string long, n long") \
        .groupBy("lang", "string").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Merged context trees of all languages; node 0 is the empty string."""
    langs: list[str]
    order: int
    node: np.ndarray     # string number of each node (0 for node 0), ascending
    slots: np.ndarray    # hash table over the strings: node or 0
    cost: np.ndarray     # per node and language: cost of the last byte, less the escapes of shorter contexts
    escape: np.ndarray   # per node and language: escapes from it and all shorter contexts
    bits: int

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The node of each string, 0 where there is none."""
        slot = slot_of(wanted, self.bits)
        found = self.slots[slot]
        left = np.flatnonzero((found > 0) & (self.node[found] != wanted))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            found[left] = self.slots[slot[left]]
            left = left[(found[left] > 0) & (self.node[found[left]] != wanted[left])]
        return found

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text under each language."""
        out = np.zeros((len(texts), len(self.langs)))
        group, size = [], 0
        for i, text in enumerate(texts):
            for at in range(0, len(text), BLOCK_BYTES):  # long texts in windows, each with its context before it
                lead = min(at, self.order)
                group.append((i, text[at - lead:at + BLOCK_BYTES], lead))
                size += len(group[-1][1])
                if size >= BLOCK_BYTES:
                    self._add(group, out)
                    group, size = [], 0
        if group:
            self._add(group, out)
        return out

    def _add(self, group: list[tuple[int, bytes, int]], out: np.ndarray) -> None:
        block = np.frombuffer(b"".join(x for _, x, _ in group), np.uint8)
        starts = np.cumsum([0, *(len(x) for _, x, _ in group[:-1])])
        longest = np.zeros(len(block), np.int32)
        context = longest
        for k in range(1, self.order + 2):
            if k == self.order + 1:
                context = longest.copy()
            found = self.find(strings(block, starts, k))
            np.copyto(longest, found, where=found > 0)
        context = np.concatenate([[0], context[:-1]])
        context[starts] = 0
        begin = starts + [lead for _, _, lead in group]
        ends = starts + [len(x) for _, x, _ in group]
        bounds = np.stack([begin, ends], axis=1).ravel()
        if bounds[-1] == len(block):
            bounds = bounds[:-1]
        bits = self.cost[longest]
        bits += self.escape[context]
        sums = np.add.reduceat(bits, bounds, axis=0)[::2]
        np.add.at(out, [i for i, _, _ in group], sums)


def slot_of(string: np.ndarray, bits: int) -> np.ndarray:
    return ((string.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def build(langs: list[str], lang: np.ndarray, string: np.ndarray, n: np.ndarray, order: int = ORDER) -> Model:
    """The model of counted strings (language number, string, count)."""
    known, at = np.unique(string, return_inverse=True)
    node = np.concatenate([[0], known]).astype(np.int64)
    count = np.zeros((len(node), len(langs)))
    np.add.at(count, (at + 1, lang), n)
    size = node // _TAG
    text = node - size * _TAG

    def node_of(k, value):
        return np.where(k > 0, np.searchsorted(node, k * _TAG + value), 0)

    before = node_of(size - 1, text >> 8)                              # without the last byte
    after = node_of(size - 1, text & ((np.int64(1) << 8 * np.maximum(size - 1, 0)) - 1))  # without the first byte
    before[0] = after[0] = 0
    total, kinds = np.zeros_like(count), np.zeros_like(count)
    np.add.at(total, before[1:], count[1:])
    np.add.at(kinds, before[1:], count[1:] > 0)
    step = np.zeros_like(count)
    np.log2((total + kinds) / np.where(kinds > 0, kinds, 1), out=step, where=kinds > 0)
    cost, escape = np.zeros_like(count), step.copy()
    cost[0] = 8.0
    for k in range(1, order + 2):
        mine = np.flatnonzero(size == k)
        b, a, c = before[mine], after[mine], count[mine]
        escape[mine] += escape[a]
        cost[mine] = np.where(c > 0, np.log2((total[b] + kinds[b]) / np.where(c > 0, c, 1), where=c > 0,
                                             out=np.zeros_like(c)), step[b] + cost[a])
    cost[1:] -= escape[before[1:]]
    bits = max(8, int(np.ceil(np.log2(4 * len(node)))))
    slots = np.zeros(1 << bits, np.int32)
    left, place = np.arange(1, len(node)), slot_of(node[1:], bits)
    while len(left):
        free = slots[place] == 0
        _, one = np.unique(place[free], return_index=True)
        put = np.flatnonzero(free)[one]
        slots[place[put]] = left[put]
        rest = np.ones(len(left), bool)
        rest[put] = False
        left, place = left[rest], (place[rest] + 1) & ((1 << bits) - 1)
    return Model(langs, order, node, slots, cost, escape, bits)


def train(labelled: DataFrame, segments: int = SAMPLE_SEGMENTS, segment_chars: int = SEGMENT_CHARS) -> Model | None:
    """The model of labelled rows (lang, text); None if there is nothing to learn from.

    It is built in a task, from counts that the sample bounds, and comes to the driver as the arrays that are broadcast.
    """
    _, chosen = sample(labelled, segments, segment_chars)

    def run(batches):
        langs, string, n = [], [], []
        for batch in batches:
            langs += batch.column(0).to_pylist()
            string.append(batch.column(1).to_numpy())
            n.append(batch.column(2).to_numpy())
        if langs:
            # languages whose texts are all empty teach nothing
            names = sorted(set(langs), key=lambda x: x.encode())
            number = {x: i for i, x in enumerate(names)}
            model = build(names, np.array([number[x] for x in langs]), np.concatenate(string), np.concatenate(n), order=ORDER)
            data = pickle.dumps(vars(model))
            for at in range(0, len(data), PART_BYTES):
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([data[at:at + PART_BYTES]], pa.binary())],
                                                 names=["at", "data"])

    parts = sorted(count_strings(chosen).coalesce(1).mapInArrow(run, "at long, data binary").collect())
    drop_cut(*[x for x in [chosen] if hasattr(x, "_cut_path")])
    return Model(**pickle.loads(b"".join(bytes(r["data"]) for r in parts))) if parts else None


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", names: tuple[str, str, str] =
             ("lang_pred", "score", "bits_per_byte")) -> DataFrame:
    """``docs`` with the predicted language, its score (0 to 1) and its code length per byte of text."""
    letter = fresh_name(docs.columns, "_letter")
    has_letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        model = shared.value
        for batch in row_groups(batches):
            fit = np.array(batch.column(batch.num_columns - 1).to_pylist(), dtype=bool)
            if model is None:
                fit[:] = False
            pred = np.full(batch.num_rows, UNDETERMINED, dtype=object)
            score, rate = np.zeros(batch.num_rows), np.full(batch.num_rows, np.nan)
            which = np.flatnonzero(fit)
            if len(which):
                rows = byte_rows(batch.column(at))
                texts = [rows[i] for i in which]
                lengths = model.lengths(texts)
                best = lengths.argmin(axis=1)
                least = lengths.min(axis=1)
                pred[which] = np.array(model.langs, dtype=object)[best]
                score[which] = 1 / np.exp2(least[:, None] - lengths).sum(axis=1)
                rate[which] = least / [len(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rate, pa.float64(), from_pandas=True)], names=[*batch.schema.names[:-1], *names])

    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()),
                           T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.DoubleType())])
    return docs.withColumn(letter, has_letter).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """The fold that is not learned from: crc32 of the id as text divisible by 5 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    return docs.where(~held_out(F.col(id_col))).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))


def accepted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The documents in some learned language, with their own columns.

    Rejected are texts without a letter and texts whose best code is longer
    by ``REJECT_BITS`` bits than the text itself: no learned language comes
    nearer to them than no model at all, and by more than a few rare names
    or numbers in a short text would make.  With nothing learned only the
    first rule holds.
    """
    names = tuple(fresh_name(docs.columns, f"_langid_{x}") for x in ("pred", "score", "rate"))
    if model is None:
        return docs.where(F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    found = identify(docs, model, text_col, names)
    over = (F.col(names[2]) - 8) * F.octet_length(F.col(text_col))
    return found.where((F.col(names[0]) != UNDETERMINED) & (over <= REJECT_BITS)).select(*docs.columns)
