"""Lineage cuts that survive executor loss.

``cut(df)`` writes the frame once as parquet under the session's reliable
checkpoint directory (``spark.checkpoint.dir``: a shared folder on a
cluster) and reads it back.  Unlike ``Dataset.checkpoint`` on an
unpersisted plan, the plan is computed once (an RDD checkpoint recomputes
it to write the files), the copy is columnar and compressed, and the
re-read frame carries file statistics that AQE uses for join planning.

A cut whose rows have been consumed (by a later cut, or by an aggregate
that was collected) is given back with ``drop_cut``.

A cut is read in as many tasks as its files have row groups.  A frame that
came from one file of one row group would be read by one task for good, so
one that costs much per row, such as a training frame, is ``cut_evenly``: a
large one comes out of many tasks anyway and is written by them in files of
bounded rows, a small one is ``dealt`` over all cores.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import ensure_checkpoint_dir


def cut(df: DataFrame, name: str = "cut", compression: str | None = None, by: str | None = None, file_rows: int = 0) -> DataFrame:
    """``df`` written and read again; with ``by`` in a folder per value of that column, so that one value is read without
    the others; with ``file_rows`` in files of at most so many rows."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/ledgerline-cut/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if file_rows:
        writer = writer.option("maxRecordsPerFile", file_rows)
    writer.parquet(path, compression=compression, partitionBy=by)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def dealt(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over at least two parts per core, however few files or row groups they come from."""
    spark = df.sparkSession
    return df.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


#: Rows of a file that is read by one task among many.
FILE_ROWS = 50_000


def cut_evenly(df: DataFrame, name: str) -> DataFrame:
    """A cut that is read in at least two parts per core, of about as many rows each; packed tightly, as it may stay long.

    The rows are written where they are.  Only if that makes fewer than two
    files per core, which bounds their number, are they dealt and written again.
    """
    out = cut(df, name, "zstd", file_rows=FILE_ROWS)
    if len(out.inputFiles()) >= 2 * df.sparkSession.sparkContext.defaultParallelism:
        return out
    again = cut(dealt(out), name, "zstd")
    drop_cut(out)
    return again


#: Rows of a part that an aggregate or a sort keeps in a task's memory.
PART_ROWS = 125_000


def parts_for(rows: int, spark: SparkSession) -> int:
    """Parts for a shuffle of so many rows: the session's number, more if a part would exceed ``PART_ROWS``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PART_ROWS))


def drop_cut(*frames: DataFrame) -> None:
    """Delete the files behind frames returned by ``cut`` (they must not be read again)."""
    for df in frames:
        path = getattr(df, "_cut_path", None)
        if path is None:
            raise ValueError("not a frame returned by cut()")
        spark = df.sparkSession
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
