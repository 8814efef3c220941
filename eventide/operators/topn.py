"""Top-N per window and the text report of the hot-items jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import format_bound, slot_of


def top_n_per_group(df: DataFrame, group, n: int, order_col: str, tie_key, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n per group by ``order_col`` descending, ties by ``tie_key`` ascending.

    ``row_number() <= n`` lets Spark insert a partial per-task group limit
    (WindowGroupLimit) before the exchange, so each task ships at most n rows
    per group: a window with millions of candidates never lands whole on one
    task.
    """
    group = [group] if isinstance(group, str) else list(group)
    tie = [tie_key] if isinstance(tie_key, str) else list(tie_key)
    w = Window.partitionBy(*group).orderBy(F.col(order_col).desc(), *[F.col(t).asc() for t in tie])
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def top_n_per_window(counts: DataFrame, n: int = 3, order_col: str = "cnt", key="item_id",
                     window_col: str = "window_end", rank_col: str = "rank") -> DataFrame:
    return top_n_per_group(counts, window_col, n, order_col, key, rank_col)


def top_n_over_runs(runs: DataFrame, n: int, key="item_id", order_col: str = "cnt", rank_col: str = "rank",
                    block: int = 128) -> DataFrame:
    """Top n of every sliding window from runs of equal counts (``windows.sliding_runs``), expanding the winners only.

    Between two neighbouring bounds of any runs no count changes, so all
    windows of such an elementary interval have the same winners. Runs are cut
    into blocks of window numbers; a block's bounds are at most ``block``
    numbers and deal its runs into elementary intervals, which are ranked (a
    limited ``row_number``) and only then expanded to windows. Returns the key
    columns, ``order_col``, ``w`` (window number) and the rank.
    """
    keys = [key] if isinstance(key, str) else list(key)
    of_block = F.sequence(slot_of(F.col("w"), block), slot_of(F.col("nxt") - 1, block))
    pieces = (runs.withColumn("_blk", F.explode(of_block))
                  .withColumn("_a", F.greatest("w", F.col("_blk") * block)).withColumn("_e", F.least("nxt", (F.col("_blk") + 1) * block)))
    marks = pieces.select("_blk", F.explode(F.array("_a", "_e")).alias("_m")).groupBy("_blk").agg(F.array_sort(F.collect_set("_m")).alias("_ms"))
    at, end = F.array_position("_ms", F.col("_a")).cast("int"), F.array_position("_ms", F.col("_e")).cast("int")
    spans = F.arrays_zip(F.slice("_ms", at, end - at).alias("s"), F.slice("_ms", at + 1, end - at).alias("e"))
    cells = pieces.join(marks, "_blk").select(*keys, order_col, F.inline(spans).alias("_s", "_t"))
    w = Window.partitionBy("_s").orderBy(F.col(order_col).desc(), *[F.col(k).asc() for k in keys])
    best = cells.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
    return best.withColumn("w", F.explode(F.sequence(F.col("_s"), F.col("_t") - 1))).drop("_s", "_t")


def format_report(top: DataFrame, window_col: str = "window_end", key: str = "item_id",
                  count_col: str = "cnt", rank_col: str = "rank", key_label: str = "id",
                  count_label: str = "count") -> DataFrame:
    """One text block per window from a top-N table (window bounds in epoch microseconds).

    Layout: a time header with the window end, then one ``NO<rank>: <key_label>=<key> <count_label>=<count>``
    line per ranked entry, in rank order. Collects at most n rows per window.
    """
    line = F.format_string("NO%d: %s=%s %s=%d", F.col(rank_col), F.lit(key_label), F.col(key).cast("string"),
                           F.lit(count_label), F.col(count_col))
    g = top.groupBy(window_col).agg(F.sort_array(F.collect_list(F.struct(F.col(rank_col), line.alias("l")))).alias("_ls"))
    header = F.concat(F.lit("time: "), format_bound(F.col(window_col)))
    body = F.array_join(F.transform("_ls", lambda s: s["l"]), "\n")
    return g.select(window_col, F.concat_ws("\n", header, body).alias("report"))
