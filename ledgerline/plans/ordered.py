"""Skew-safe ordered scans (windows over a partition key or over everything).

``Window.partitionBy(k).orderBy(o)`` sends every row of one key to one task,
and a window without ``partitionBy`` sends the whole table to one task.
When one key may hold a third of the rows, that task becomes the job.

``ordered_scan`` computes the same results in a way that splits hot keys:

1. ``repartitionByRange(n, k..., o...)``: range partitions are contiguous
   runs of the (k, o) order, so a hot key spreads over several partitions
   (chunks) while a cold key usually stays inside one.
2. Local windows over ``(k, chunk)``: lag/lead, prior-row and running
   aggregates, row number.  The local frame is then written once to the
   shared ``spark.checkpoint.dir`` and read back (``plans.lineage.cut``), so
   chunk ids stay fixed even if executors are lost and stages are recomputed.
3. Only the first and the last key of a chunk can continue into a
   neighbouring chunk.  One ``groupBy(chunk)`` gives, per chunk, its first
   and last key, the last key's totals (read off the chunk's last row) and
   the edge values -- one row per chunk, so its size is bounded by the
   partition count, not by the data, which is what makes the broadcast
   safe.  Windows over that tiny table give each chunk's first key the
   totals of its earlier chunks; one broadcast join adds them back.  No row
   is dropped or sampled.

Output kinds (``spec`` maps output column -> (kind, input column)):
  ``lag`` / ``lead``        previous / next value of the column
  ``prior_sum`` / ``prior_count`` / ``prior_min`` / ``prior_max``
                              aggregate over strictly earlier rows (SQL
                              semantics: sum/min/max null when no value)
  ``run_sum`` / ``run_count`` same, including the current row
  ``row_number``             1-based position (input column ignored)
``order_by`` must be a total order inside each key (add tie-breakers).

``chunked_scan`` is the cheaper form for per-key windows whose rows carry a
column to cut them by, such as a date: the chunk is a function of the row
(e.g. its month) that never decreases along the order, so nothing has to be
sampled, frozen or written.  The rows are shuffled once, by (key, chunk),
which splits a hot key; totals per (key, chunk) come from one aggregation,
windows over those few rows per key turn them into offsets, and the offsets
are joined on the partitioning that the rows already have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.plans.lineage import cut

_PID = "_chunk"


def _sort_key(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of(date: str) -> Column:
    """A chunk for ``chunked_scan``: months counted through the years."""
    return F.year(date) * 12 + F.month(date)


def chunked_scan(df: DataFrame, partition_by: list[str], order_by: list[str], chunk: Column,
                 spec: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Windows per key, computed per (key, chunk); see the module text.

    ``order_by`` are column names, ascending; ``chunk`` must not decrease
    along them.  Kinds as in ``ordered_scan``; keys may be null, and so may
    the chunk of rows that come first (a struct with a null equals another).
    """
    rows = df.withColumn("_k", F.struct(*partition_by)).withColumn(_PID, F.struct(chunk.alias("c")))
    w = Window.partitionBy("_k", _PID).orderBy(*order_by)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    per_key = Window.partitionBy("_k").orderBy(_PID)
    earlier = per_key.rowsBetween(Window.unboundedPreceding, -1)
    place = F.struct(*order_by)
    n_before, n_earlier = F.row_number().over(w) - 1, F.coalesce(F.sum("_t_rows").over(earlier), F.lit(0))

    local, totals, offsets, out = {"_rn": n_before}, [F.count(F.lit(1)).alias("_t_rows")], [n_earlier.alias("_o_rows")], {}
    if any(kind == "lead" for kind, _ in spec.values()):
        local["_end"] = F.lead(F.lit(1)).over(w).isNull()
    for name, (kind, col) in spec.items():
        c, t, o, here = F.col(col) if col else None, f"_t_{name}", f"_o_{name}", f"_l_{name}"
        if kind in ("lag", "lead"):
            at_edge = F.max if kind == "lag" else F.min
            by_edge = F.max_by if kind == "lag" else F.min_by
            # the edge value of the leading order column is its extreme, which aggregates in place
            totals.append((at_edge(c) if col == order_by[0] else by_edge(c, place)).alias(t))
            offsets.append((F.lag(t) if kind == "lag" else F.lead(t)).over(per_key).alias(o))
            local[here] = (F.lag(c) if kind == "lag" else F.lead(c)).over(w)
            edge = F.col("_rn") == 0 if kind == "lag" else F.col("_end")
            out[name] = F.when(edge, F.col(o)).otherwise(F.col(here))
        elif kind == "row_number":
            out[name] = F.col("_rn") + 1 + F.col("_o_rows")
        elif kind in ("prior_min", "prior_max"):
            agg, pick = (F.min, F.least) if kind == "prior_min" else (F.max, F.greatest)
            totals.append(agg(c).alias(t))
            offsets.append(agg(t).over(earlier).alias(o))
            local[here] = agg(c).over(before)
            out[name] = pick(F.col(o), F.col(here))
        elif kind in ("prior_sum", "run_sum", "prior_count", "run_count"):
            frame = before if kind.startswith("prior") else upto
            totals.append(F.count(c).alias(f"{t}_c"))
            offsets.append(F.coalesce(F.sum(f"{t}_c").over(earlier), F.lit(0)).alias(f"{o}_c"))
            local[f"{here}_c"] = F.count(c).over(frame)
            count = F.col(f"{here}_c") + F.col(f"{o}_c")
            out[name] = count
            if kind.endswith("sum"):
                totals.append(F.sum(c).alias(t))
                offsets.append(F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(o))
                local[here] = F.coalesce(F.sum(c).over(frame), F.lit(0))
                out[name] = F.when(count > 0, F.col(here) + F.col(o))
        else:
            raise ValueError(f"unknown scan kind {kind}")
    per_chunk = rows.groupBy("_k", _PID).agg(*totals).select("_k", _PID, *offsets)
    scanned = rows.withColumns(local).join(per_chunk, ["_k", _PID])
    return scanned.select(*df.columns, *[c.alias(name) for name, c in out.items()])


def ordered_scan(df: DataFrame, partition_by: list[str], order_by: list,
                 spec: dict[str, tuple[str, str | None]],
                 num_ranges: int | None = None) -> DataFrame:
    spark = df.sparkSession
    n = num_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = list(partition_by)
    order_cols = [_sort_key(c) for c in order_by]

    ranged = df.repartitionByRange(n, *[F.col(k) for k in keys], *order_cols)
    ranged = ranged.withColumn(_PID, F.spark_partition_id())

    w = Window.partitionBy(*keys, _PID).orderBy(*order_cols)
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    local = ranged.withColumn("_l_rn", F.row_number().over(w)) \
                  .withColumn("_l_last", F.lead(F.lit(1)).over(w).isNull())
    for out, (kind, col) in spec.items():
        c = F.col(col) if col else None
        if kind == "lag":
            local = local.withColumn(f"_l_{out}", F.lag(c).over(w))
        elif kind == "lead":
            local = local.withColumn(f"_l_{out}", F.lead(c).over(w))
        elif kind in ("prior_sum", "prior_count", "run_sum", "run_count"):
            frame = prior if kind.startswith("prior") else upto
            if kind.endswith("sum"):
                local = local.withColumn(f"_l_{out}_s", F.sum(c).over(frame))
            local = local.withColumn(f"_l_{out}_c", F.count(c).over(frame))
        elif kind == "prior_min":
            local = local.withColumn(f"_l_{out}", F.min(c).over(prior))
        elif kind == "prior_max":
            local = local.withColumn(f"_l_{out}", F.max(c).over(prior))
        elif kind == "row_number":
            pass
        else:
            raise ValueError(f"unknown scan kind {kind}")

    # freeze chunk ids and local results: written once to the shared
    # checkpoint folder and read back (survives executor loss)
    local = cut(local, "ordered-scan")

    # One row per chunk (n rows): its first and last key, the last key's
    # totals inside the chunk (taken from the chunk's last row, whose local
    # frame already covers them) and the values at the chunk edges.
    kstruct = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_all"))
    pos = F.struct(kstruct.alias("k"), F.col("_l_rn").alias("r"))
    last_of = lambda c: F.max_by(c, pos)  # noqa: E731 - value at the chunk's last row
    aggs = [F.min(kstruct).alias("_fk"), F.max(kstruct).alias("_lk"), last_of(F.col("_l_rn")).alias("_t_rows")]
    for out, (kind, col) in spec.items():
        v = F.col(col) if col else None
        if kind in ("prior_sum", "run_sum"):
            s_incl = F.col(f"_l_{out}_s") if kind == "run_sum" else \
                F.when(v.isNull(), F.col(f"_l_{out}_s")).otherwise(F.coalesce(F.col(f"_l_{out}_s"), F.lit(0)) + v)
            c_incl = F.col(f"_l_{out}_c") if kind == "run_sum" else \
                F.col(f"_l_{out}_c") + F.when(v.isNotNull(), 1).otherwise(0)
            aggs += [last_of(s_incl).alias(f"_t_{out}_s"), last_of(c_incl).alias(f"_t_{out}_c")]
        elif kind in ("prior_count", "run_count"):
            c_incl = F.col(f"_l_{out}_c") if kind == "run_count" else \
                F.col(f"_l_{out}_c") + F.when(v.isNotNull(), 1).otherwise(0)
            aggs.append(last_of(c_incl).alias(f"_t_{out}_c"))
        elif kind == "prior_min":
            aggs.append(last_of(F.least(F.col(f"_l_{out}"), v)).alias(f"_t_{out}"))
        elif kind == "prior_max":
            aggs.append(last_of(F.greatest(F.col(f"_l_{out}"), v)).alias(f"_t_{out}"))
        elif kind == "lag":
            aggs.append(last_of(v).alias(f"_t_{out}"))
        elif kind == "lead":
            aggs.append(F.min_by(v, pos).alias(f"_t_{out}"))
    chunks = local.groupBy(_PID).agg(*aggs)

    # Offsets for each chunk's first key: totals of the earlier chunks that
    # end with the same key (they are contiguous), via windows over the
    # n-row chunk table -- its size is bounded by the partition count.
    by_last = Window.partitionBy("_lk").orderBy(_PID).rowsBetween(Window.unboundedPreceding, 0)
    seq = Window.orderBy(_PID)
    cum = [F.sum("_t_rows").over(by_last).alias("_c_rows")]
    for out, (kind, col) in spec.items():
        if kind in ("prior_sum", "run_sum"):
            cum += [F.sum(f"_t_{out}_s").over(by_last).alias(f"_c_{out}_s"),
                    F.sum(f"_t_{out}_c").over(by_last).alias(f"_c_{out}_c")]
        elif kind in ("prior_count", "run_count"):
            cum.append(F.sum(f"_t_{out}_c").over(by_last).alias(f"_c_{out}_c"))
        elif kind == "prior_min":
            cum.append(F.min(f"_t_{out}").over(by_last).alias(f"_c_{out}"))
        elif kind == "prior_max":
            cum.append(F.max(f"_t_{out}").over(by_last).alias(f"_c_{out}"))
    chunks = chunks.select("*", *cum)
    cont = F.lag("_lk").over(seq) == F.col("_fk")        # first key continues from the previous chunk
    carry = F.lead("_fk").over(seq) == F.col("_lk")      # last key continues into the next chunk
    offs = [F.col(_PID), F.col("_fk"), F.col("_lk"),
            F.when(cont, F.lag("_c_rows").over(seq)).alias("_o_rows")]
    for out, (kind, col) in spec.items():
        if kind in ("prior_sum", "run_sum"):
            offs += [F.when(cont, F.lag(f"_c_{out}_s").over(seq)).alias(f"_o_{out}_s"),
                     F.when(cont, F.lag(f"_c_{out}_c").over(seq)).alias(f"_o_{out}_c")]
        elif kind in ("prior_count", "run_count"):
            offs.append(F.when(cont, F.lag(f"_c_{out}_c").over(seq)).alias(f"_o_{out}_c"))
        elif kind in ("prior_min", "prior_max"):
            offs.append(F.when(cont, F.lag(f"_c_{out}").over(seq)).alias(f"_o_{out}"))
        elif kind == "lag":
            offs.append(F.when(cont, F.lag(f"_t_{out}").over(seq)).alias(f"_o_{out}"))
        elif kind == "lead":
            offs.append(F.when(carry, F.lead(f"_t_{out}").over(seq)).alias(f"_o_{out}"))
    offsets = chunks.select(*offs)

    joined = local.join(F.broadcast(offsets), _PID, "left")
    first_key = kstruct == F.col("_fk")
    last_key = kstruct == F.col("_lk")

    def off(c):  # offsets apply to the chunk's first key only
        return F.when(first_key, F.col(c))

    result = joined
    for out, (kind, col) in spec.items():
        if kind == "row_number":
            result = result.withColumn(out, F.col("_l_rn") + F.coalesce(off("_o_rows"), F.lit(0)))
        elif kind == "lag":
            result = result.withColumn(out, F.when(F.col("_l_rn") == 1, off(f"_o_{out}"))
                                       .otherwise(F.col(f"_l_{out}")))
        elif kind == "lead":
            # the next chunk's first row is the lead of this chunk's last row
            result = result.withColumn(out, F.when(F.col("_l_last"), F.when(last_key, F.col(f"_o_{out}")))
                                       .otherwise(F.col(f"_l_{out}")))
        elif kind in ("prior_sum", "run_sum"):
            cnt = F.coalesce(F.col(f"_l_{out}_c"), F.lit(0)) + F.coalesce(off(f"_o_{out}_c"), F.lit(0))
            total = F.coalesce(F.col(f"_l_{out}_s"), F.lit(0)) + F.coalesce(off(f"_o_{out}_s"), F.lit(0))
            result = result.withColumn(out, F.when(cnt > 0, total))
        elif kind in ("prior_count", "run_count"):
            result = result.withColumn(
                out, F.coalesce(F.col(f"_l_{out}_c"), F.lit(0)) + F.coalesce(off(f"_o_{out}_c"), F.lit(0)))
        elif kind == "prior_min":
            result = result.withColumn(out, F.least(F.col(f"_l_{out}"), off(f"_o_{out}")))
        elif kind == "prior_max":
            result = result.withColumn(out, F.greatest(F.col(f"_l_{out}"), off(f"_o_{out}")))
    helper = [c for c in result.columns if c.startswith(("_l_", "_o_", "_t_")) or c in (_PID, "_fk", "_lk")]
    return result.drop(*helper)


def ntile_of(rank: Column, total: Column, buckets: int) -> Column:
    """Spark/SQL NTILE bucket of a 1-based ``rank`` among ``total`` rows.

    The first ``total % buckets`` buckets hold one extra row.
    """
    q = F.floor(total / buckets)
    r = total % buckets
    big = r * (q + 1)
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1) \
            .otherwise(r + F.floor((rank - big - 1) / F.greatest(q, F.lit(1))) + 1).cast("int")


def dense_rank_by(df: DataFrame, partition_by: list[str], value: str, descending: bool = True,
                  out: str = "dense_rank", num_ranges: int | None = None) -> DataFrame:
    """DENSE_RANK of ``value`` inside each key, without a per-key window.

    The distinct (key, value) pairs are numbered by the skew-safe ordered
    scan (row number over distinct values = dense rank), then joined back
    null-safely.  Ties share a rank, as with ``F.dense_rank``.
    """
    order = F.desc_nulls_last(value) if descending else F.asc_nulls_first(value)
    distinct_vals = df.select(*partition_by, value).distinct()
    ranked = ordered_scan(distinct_vals, list(partition_by), [order], {out: ("row_number", None)}, num_ranges)
    ranked = ranked.select(*[F.col(c).alias(f"_r_{c}") for c in [*partition_by, value]],
                           F.col(out).cast("bigint").alias(out))
    cond = [df[c].eqNullSafe(ranked[f"_r_{c}"]) for c in [*partition_by, value]]
    return df.join(ranked, cond).drop(*[f"_r_{c}" for c in [*partition_by, value]])
