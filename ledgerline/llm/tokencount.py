"""Token counts of documents in flat token files by separator scan (operator 8).

A flat token file is a plain sequence of fixed-width ids in which an
end-of-document id follows every document; there is no index.  The file is
read in blocks that take no notice of documents.

Method.  Each block is searched for the separator in one vectorised
comparison.  What a block needs from the blocks before it -- how many
separators there were, how many ids there were, and where the last
separator was -- comes from a prefix scan over one narrow row per block: in
runs of ``RUN_BLOCKS`` blocks, then over the runs, so no file, however
large, is one window.  A document that crosses blocks gets its count from
the last separator before and the one after it.

``write_flat`` makes such files from texts with a public tokenizer: one
file per input partition, as rows (file, block, data), and beside it the
ids of the documents in file order.  ``read_flat`` reads plain binary files.

Cases: null or empty text has 0 tokens; special strings of the tokenizer, such
as a literal '<|endoftext|>', are tokens like others; documents follow one another in the
order of their rows; ids after the last separator of a file are a last
document marked as not closed (``closed`` false); blocks may be empty or
missing at the end; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm import tokens
from ledgerline.llm.util import byte_rows, row_groups
from ledgerline.plans.lineage import cut, drop_cut

SEPARATOR = 49408  # the first 16-bit id beyond the tokenizer's: no text can hold it
BLOCK_IDS = 1 << 16
RUN_BLOCKS = 1024


def write_flat(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", separator: int = SEPARATOR,
               block_ids: int = BLOCK_IDS, path: str | None = None) -> DataFrame:
    """Rows of token blocks (file, block, data: 16-bit ids) and of document lists (file, first, docs)."""
    path = path or tokens.tokenizer_path()
    id_type = docs.schema[id_col].dataType.simpleString()

    def row(file, block, data, first, ids, kind):
        return pa.RecordBatch.from_arrays(
            [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([data], pa.binary()),
             pa.array([first], pa.int64()), pa.array([ids], pa.list_(kind))], names=["file", "block", "data", "first", "docs"])

    def run(batches):
        cache = tokens.word_ids(path)
        task = TaskContext.get()
        file, block, first, rest, kind = task.partitionId() if task else 0, 0, 0, b"", None
        for batch in row_groups(batches):
            ids = batch.column(0)
            kind = ids.type
            yield row(file, None, None, first, ids.to_pylist(), ids.type)
            first += len(ids)
            parts = [rest]
            for text in byte_rows(batch.column(1)):
                packed = np.frombuffer(tokens.encode(cache, text, separator), "<u4")
                if (packed[:-1] == separator).any():
                    raise ValueError("a text holds the separator as an ordinary token")
                parts.append(packed.astype("<u2").tobytes())
            rest = b"".join(parts)
            width = 2 * block_ids
            for at in range(0, len(rest) - width + 1, width):
                yield row(file, block, rest[at:at + width], None, None, ids.type)
                block += 1
            rest = rest[len(rest) // width * width:]
        if rest:
            yield row(file, block, rest, None, None, kind)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"file long, block long, data binary, first long, docs array<{id_type}>")


def read_flat(spark: SparkSession, path: str, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks (file, block, data) of plain binary files of at most 2 GB each; files are numbered by a hash of their path."""
    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for k, at in enumerate(range(0, len(content), width * block_ids)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file], pa.int64()), pa.array([k], pa.int64()),
                         pa.array([content[at:at + width * block_ids]], pa.binary())], names=["file", "block", "data"])

    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("path").alias("file"), "content")
    return files.mapInArrow(run, "file long, block long, data binary")


def separators(blocks: DataFrame, separator: int, dtype: str = "<u2") -> DataFrame:
    """file, block, n_ids, at (positions of the separator) of each block."""
    def run(batches):
        for batch in batches:
            n, at = [], []
            for data in batch.column(2).to_pylist():
                ids = np.frombuffer(data, dtype)
                n.append(len(ids))
                at.append(np.flatnonzero(ids == separator).astype(np.int32))
            offsets = np.cumsum([0, *map(len, at)]).astype(np.int32)
            flat = np.concatenate(at) if at else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["file", "block", "n_ids", "at"])

    return blocks.select("file", "block", "data").mapInArrow(run, "file long, block long, n_ids long, at array<int>")


def counts(found: DataFrame) -> DataFrame:
    """file, ordinal, start, n_tokens, closed of every document; ``found``: separators per block (a cut)."""
    run = F.floor(F.col("block") / RUN_BLOCKS)
    n_at = F.size("at")
    last = F.when(n_at > 0, F.element_at("at", -1))
    rows = found.select("file", "block", run.alias("run"), "n_ids", "at", n_at.alias("n_at"), last.alias("last"))
    before = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))) \
        .withColumn("docs", F.coalesce(F.sum("n_at").over(before), F.lit(0)))
    rows = rows.withColumn("end", F.max(F.col("base") + F.col("last")).over(before))  # last separator in the run so far

    runs = rows.groupBy("file", "run").agg(F.sum("n_ids").alias("n_ids"), F.sum("n_at").alias("n_at"),
                                           F.max(F.col("base") + F.col("last")).alias("last"))
    earlier = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("r_base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))) \
        .withColumn("r_docs", F.coalesce(F.sum("n_at").over(earlier), F.lit(0)))
    runs = runs.withColumn("r_end", F.max(F.col("r_base") + F.col("last")).over(earlier))
    rows = rows.join(runs.select("file", "run", "r_base", "r_docs", "r_end"), ["file", "run"])

    base = F.col("r_base") + F.col("base")
    previous = F.coalesce(F.col("r_base") + F.col("end"), F.col("r_end"), F.lit(-1))
    rows = rows.select("file", (F.col("r_docs") + F.col("docs")).alias("docs"), previous.alias("previous"),
                       F.transform("at", lambda x: x.cast("long") + base).alias("at"))
    closed = rows.select("file", "docs", "previous", "at", F.posexplode("at").alias("k", "stop")).select(
        "file", (F.col("docs") + F.col("k")).alias("ordinal"),
        (F.when(F.col("k") == 0, F.col("previous")).otherwise(F.get("at", F.col("k") - 1)) + 1).alias("start"), "stop")
    closed = closed.select("file", "ordinal", "start", (F.col("stop") - F.col("start")).alias("n_tokens"),
                           F.lit(True).alias("closed"))

    total = runs.groupBy("file").agg(F.sum("n_ids").alias("n_ids"), F.sum("n_at").alias("ordinal"),
                                     (F.coalesce(F.max(F.col("r_base") + F.col("last")), F.lit(-1)) + 1).alias("start"))
    tail = total.where("n_ids > start").select("file", "ordinal", "start", (F.col("n_ids") - F.col("start")).alias("n_tokens"),
                                               F.lit(False).alias("closed"))
    return closed.union(tail)


def count_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, file, ordinal, start of every document, by writing flat files and scanning them."""
    flat = cut(write_flat(docs, id_col, text_col), "flat-tokens", compression="zstd")
    found = cut(separators(flat.where("data IS NOT NULL"), SEPARATOR), "separators")
    order = cut(flat.where("docs IS NOT NULL").select("file", "first", F.posexplode("docs").alias("k", "id"))
                .select("file", (F.col("first") + F.col("k")).alias("ordinal"), "id"), "document-order")
    drop_cut(flat)
    return counts(found).join(order, ["file", "ordinal"]).select(
        F.col("id").alias(id_col), "n_tokens", "file", "ordinal", "start")
