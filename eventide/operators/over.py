"""Over-windows (per-row aggregates over a key's event-time ordered rows).

Unbounded frames run as a two-level scan per (key, bucket of rows); bounded
range frames run per (key, bucket) on halo-replicated rows. Neither
partitions a whole key into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import duration_us, epoch_us
from . import sequence as seq


def over_unbounded(df: DataFrame, key, ts: str, value: str, tiebreak: str | None = None,
                   frame: str = "range", prefix: str = "run", rows: int | None = None) -> DataFrame:
    """Running count and sum from the key's first row up to the current one.

    ``frame='range'`` includes rows tied on the timestamp (RANGE BETWEEN
    UNBOUNDED PRECEDING AND CURRENT ROW); ``'rows'`` stops at the current row
    in (ts, tiebreak) order. Adds ``<prefix>_cnt`` and ``<prefix>_sum``.
    ``rows`` is the size of a bucket (``sequence.ROWS_PER_BUCKET``).
    """
    d = seq.cut(df.withColumn("_us", epoch_us(ts)), key, "_us", tiebreak, rows)
    order = ["_us"] + ([tiebreak] if tiebreak else [])
    s = seq.scan(d, key, order, {f"{prefix}_cnt": F.lit(1).cast("long"), f"{prefix}_sum": F.col(value)}, frame)
    return seq.uncut(s).drop("_us")


def over_range_bounded(df: DataFrame, key, ts: str, value: str, preceding, prefix: str = "rng",
                       rows: int | None = None) -> DataFrame:
    """Count and sum over RANGE BETWEEN ``preceding`` PRECEDING AND CURRENT ROW; rows without a time see each other."""
    p_us = duration_us(preceding)
    h = seq.with_halo(seq.cut(df.withColumn("_us", epoch_us(ts)), key, "_us", None, rows, keep_bounds=True), "_us", p_us)
    w = Window.partitionBy(*seq.parts(h, key)).orderBy("_us").rangeBetween(-p_us, 0)
    res = (h.withColumn(f"{prefix}_cnt", F.count(F.lit(1)).over(w))
            .withColumn(f"{prefix}_sum", F.sum(value).over(w))
            .where(~F.col(seq.CONTEXT)))
    return seq.uncut(res).drop("_us")


def over_rows_bounded(df: DataFrame, key, ts: str, value: str, preceding_rows: int, tiebreak: str,
                      prefix: str = "rows", rows: int | None = None) -> DataFrame:
    """Count and sum over ROWS BETWEEN n PRECEDING AND CURRENT ROW.

    Rows are numbered with the scan and cut into blocks of n + 1
    consecutive rows. A frame [rn - n, rn] covers the head of its own block
    up to rn plus, unless rn closes a block, the tail of the previous block
    from rn - n on. Both partial sums come from windows over one block
    (n + 1 rows) and meet through an equi-join on (key, row number), so the
    values are summed directly (no difference of large running sums) and no
    task holds a whole key.
    """
    keys = seq.names(key) or [seq.ALL]
    n1 = preceding_rows + 1
    d = seq.cut(df.withColumn("_us", epoch_us(ts)), key, "_us", tiebreak, rows)
    rn = seq.row_number(d, key, ["_us", tiebreak], "_rn").drop(seq.BUCKET, seq.CUT)
    blk = rn.withColumn("_blk", F.expr(f"(_rn - 1) div {n1}"))
    head = Window.partitionBy(*keys, "_blk").orderBy("_rn").rowsBetween(Window.unboundedPreceding, 0)
    tail = Window.partitionBy(*keys, "_blk").orderBy("_rn").rowsBetween(0, Window.unboundedFollowing)
    parts = (blk.withColumn("_hs", F.sum(value).over(head)).withColumn("_hc", F.count(F.lit(1)).over(head))
                .withColumn("_ts", F.sum(value).over(tail)).withColumn("_tc", F.count(F.lit(1)).over(tail)))
    tails = parts.select(*keys, (F.col("_rn") + F.lit(preceding_rows)).alias("_rn"),
                         F.col("_ts").alias("_ps"), F.col("_tc").alias("_pc"), F.col("_blk").alias("_pblk"))
    j = seq.join_keys(parts, tails, [*keys, "_rn"], "left")
    use_prev = F.col("_pblk").isNotNull() & (F.col("_pblk") != F.col("_blk"))
    return (j.withColumn(f"{prefix}_cnt", (F.col("_hc") + F.when(use_prev, F.col("_pc")).otherwise(0)).cast("long"))
             .withColumn(f"{prefix}_sum", F.when(use_prev & F.col("_ps").isNotNull(), F.coalesce("_hs", F.lit(0.0)) + F.col("_ps")).otherwise(F.col("_hs")))
             .drop("_rn", "_blk", "_hs", "_hc", "_ts", "_tc", "_ps", "_pc", "_pblk", "_us", seq.ALL))
