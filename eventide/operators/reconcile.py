"""Reconciliation of two event feeds on a shared key (pays vs receipts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import duration_us, epoch_us
from . import sequence as seq

MATCHED, LEFT_ONLY, RIGHT_ONLY = "matched", "left_only", "right_only"


def reconcile(left: DataFrame, right: DataFrame, key, left_ts: str, right_ts: str,
              tolerance=None, left_prefix: str = "l_", right_prefix: str = "r_",
              unique_keys: bool = False, tiebreak_left: str | None = None,
              tiebreak_right: str | None = None, rows: int | None = None) -> DataFrame:
    """Full outer join of two feeds with an ``outcome`` column; no row is lost or paired twice.

    ``tolerance=None`` matches over the whole input: when a key repeats on a
    side, the n-th row of one side (in event-time order) pairs with the n-th
    of the other. ``unique_keys=True`` asserts at most one row per key and
    side and skips the ranking.

    With a ``tolerance`` the rows of both sides are taken in time order (ties
    by tie-break, then left before right) and each pairs with the oldest row
    of the other side that still waits; a row waits ``tolerance`` (inclusive)
    and is one-sided after that. This is also the rule of the stream form
    (``match_stream``). See ``_pair_in_time``.

    Ranks and clusters come from cut rows (``sequence``), so a hot key is
    spread over tasks. Columns: key columns, ``<prefix><col>`` for both sides,
    ``outcome``.
    """
    keys = seq.names(key)
    if tolerance is not None:
        return _pair_in_time(left, right, keys, left_ts, right_ts, duration_us(tolerance), left_prefix, right_prefix,
                             tiebreak_left, tiebreak_right, rows)

    def side(df: DataFrame, ts: str, tb: str | None, prefix: str) -> DataFrame:
        d = df.withColumn("_us", epoch_us(ts))
        if unique_keys:
            d = d.withColumn("_rank", F.lit(1).cast("long"))
        else:
            d = seq.uncut(seq.row_number(seq.cut(d, keys, "_us", tb, rows), keys, ["_us"] + ([tb] if tb else []), "_rank"))
        ren = [F.col(c).alias(prefix + c) for c in df.columns if c not in keys]
        return d.select(*keys, "_rank", F.lit(True).alias(prefix + "_in"), *ren)

    l, r = side(left, left_ts, tiebreak_left, left_prefix), side(right, right_ts, tiebreak_right, right_prefix)
    on = [*keys, "_rank"]
    # NULL keys are a key as any other, in a full outer join too.
    lk, rk = l.withColumn("_k", F.struct(*on)), r.withColumn("_rk", F.struct(*on)).drop(*on)
    j = lk.join(rk, F.col("_k") == F.col("_rk"), "full_outer")
    j = j.withColumns({c: F.coalesce(F.col(f"_k.`{c}`"), F.col(f"_rk.`{c}`")) for c in on}).drop("_k", "_rk")
    lin, rin = F.col(left_prefix + "_in"), F.col(right_prefix + "_in")
    outcome = F.when(lin & rin, F.lit(MATCHED)).when(lin, F.lit(LEFT_ONLY)).otherwise(F.lit(RIGHT_ONLY))
    return j.withColumn("outcome", outcome).drop("_rank", left_prefix + "_in", right_prefix + "_in")


def _greedy(events: Column, wait: int) -> Column:
    """Pairs (places i < j in the array, either side first) of a sorted array of events (u, side): first in, first out.

    The rows that wait are all of one side: a row of the other side would have taken the oldest of them.
    """
    start = F.struct(F.array().cast("array<struct<u:bigint,side:int,i:int>>").alias("waiting"),
                     F.array().cast("array<struct<i:int,j:int>>").alias("pairs"))

    def step(state: Column, x: Column) -> Column:
        waiting = F.filter(state["waiting"], lambda y: x["u"] - y["u"] <= wait)
        oldest = F.get(waiting, F.lit(0))
        meets = F.coalesce(oldest["side"] != x["side"], F.lit(False))
        return F.struct(
            F.when(meets, F.slice(waiting, 2, F.greatest(F.size(waiting), F.lit(1)))).otherwise(F.concat(waiting, F.array(x))).alias("waiting"),
            F.when(meets, F.concat(state["pairs"], F.array(F.struct(oldest["i"].alias("i"), x["i"].alias("j"))))).otherwise(state["pairs"]).alias("pairs"))

    numbered = F.transform(events, lambda e, i: F.struct(e["u"].alias("u"), e["side"].alias("side"), i.alias("i")))
    return F.aggregate(numbered, start, step, lambda s: s["pairs"])


def _pair_in_time(left, right, keys, left_ts, right_ts, wait, left_prefix, right_prefix, tiebreak_left, tiebreak_right, rows) -> DataFrame:
    """Pairing within ``wait`` by clusters: rows of a key connected by gaps of at most ``wait``.

    Nothing waits across a larger gap, so clusters are independent. They are
    numbered by a running count of such gaps on cut rows, so a busy key is
    spread over tasks by its clusters; a cluster with rows of both sides is
    paired in one array, one with rows of a single side is not paired at all.
    Rows without a time match nothing.
    """
    def side(df: DataFrame, ts: str, tb: str | None, number: int, prefix: str) -> DataFrame:
        payload = F.struct(*[F.col(c).alias(prefix + c) for c in df.columns if c not in keys])
        tie = F.col(tb) if tb else F.xxhash64(*df.columns)
        return df.select(*keys, epoch_us(ts).alias("_us"), tie.alias("_tb"), F.lit(number).alias("_side"), payload.alias(f"_row{number}"))

    both = side(left, left_ts, tiebreak_left, 0, left_prefix).unionByName(side(right, right_ts, tiebreak_right, 1, right_prefix), allowMissingColumns=True)
    d = seq.before(seq.cut(both, keys, "_us", None, rows), keys, ["_us"], "_prev", F.struct("_us"))
    apart = F.when(F.col("_prev").isNull() | F.coalesce(F.col("_us") - F.col("_prev._us") > wait, F.lit(True)), 1).otherwise(0).cast("long")
    d = seq.uncut(seq.scan(d, keys, ["_us"], {"_cluster": apart}, frame="range"))
    event = F.struct(F.col("_us").alias("u"), F.col("_tb").alias("t"), F.col("_side").alias("side"), F.col("_row0").alias("l"), F.col("_row1").alias("r"))
    timed = d.where(F.col("_us").isNotNull()).groupBy(*keys, "_cluster").agg(
        F.array_sort(F.collect_list(event)).alias("_ev"), F.min("_side").alias("_lo"), F.max("_side").alias("_hi"))
    none = F.array().cast("array<struct<i:int,j:int>>")
    timed = timed.withColumn("_pairs", F.when(F.col("_lo") < F.col("_hi"), _greedy(F.col("_ev"), wait)).otherwise(none))
    paired = F.transform("_pairs", lambda p: F.struct(F.coalesce(F.get("_ev", p["i"])["l"], F.get("_ev", p["j"])["l"]).alias("l"),
                                                      F.coalesce(F.get("_ev", p["i"])["r"], F.get("_ev", p["j"])["r"]).alias("r")))
    taken = F.concat(F.transform("_pairs", lambda p: p["i"]), F.transform("_pairs", lambda p: p["j"]))
    alone = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_ev") - 1), taken), lambda i: F.struct(F.get("_ev", i)["l"].alias("l"), F.get("_ev", i)["r"].alias("r")))
    found = timed.select(*keys, F.explode(F.concat(paired, alone)).alias("_x")).select(*keys, "_x.l", "_x.r")
    found = found.unionByName(d.where(F.col("_us").isNull()).select(*keys, F.col("_row0").alias("l"), F.col("_row1").alias("r")))
    outcome = (F.when(F.col("l").isNotNull() & F.col("r").isNotNull(), F.lit(MATCHED))
                .when(F.col("l").isNotNull(), F.lit(LEFT_ONLY)).otherwise(F.lit(RIGHT_ONLY)))
    lcols = [F.col(f"l.`{left_prefix}{c}`") for c in left.columns if c not in keys]
    rcols = [F.col(f"r.`{right_prefix}{c}`") for c in right.columns if c not in keys]
    return found.withColumn("outcome", outcome).select(*keys, *lcols, *rcols, "outcome")
