"""Keyed event-time detectors (batch forms).

All detectors order a key's events by (event time, tie-break column); the
tie-break stands for arrival order among equal timestamps. Timers are read
in ideal event time: a timer due at T fires after every event with
timestamp <= T and before any later one.

Scale: no detector puts a hot key in one task. Look-back and look-ahead
detectors run on cut rows (``sequence``): per (key, bucket of rows), with the
nearest row of other buckets carried over in a small table. Counting detectors
use aggregates or ``row_number() <= k`` filters, which Spark limits per task
before the shuffle (WindowGroupLimit).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import duration_us, epoch_us, utc_day
from . import sequence as seq


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _cond(c) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def _prep(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("_us", epoch_us(ts))


# ------------------------------------------------------------------ D1

def burst_detector(df: DataFrame, key, ts: str, is_fail, within="2 seconds", tiebreak: str | None = None,
                   rows: int | None = None) -> DataFrame:
    """Failure bursts drained by timers.

    Every event of a key sets a timer at ts + within; fails are buffered and
    each timer drains the buffer, emitting the earliest fail when it held
    more than one. The timer that drains a fail at t is the first one at or
    after t, i.e. within + the earliest event time in [t - within, t], so
    fails sharing that value form one drained group. That time is the first
    event after a probe put at t - within.

    Returns the earliest fail row of each group of two or more fails, with
    ``fails_in_burst``.
    """
    keys = _keys(key)
    w_us = duration_us(within)
    d = _prep(df, ts).withColumn("_fail", F.coalesce(_cond(is_fail), F.lit(False)))
    cols = [c for c in d.columns if c != "_fail"]
    # Points in order: 2 * time for a probe, 2 * time + 1 for an event.
    events = d.select(*keys, (F.col("_us") * 2 + 1).alias("_at"), *([F.col(tiebreak).alias("_tb")] if tiebreak else []))
    probes = d.where("_fail").select(*keys, ((F.col("_us") - w_us) * 2).alias("_at"), F.struct(*cols).alias("_row"),
                                     *([F.col(tiebreak).alias("_tb")] if tiebreak else []))
    points = seq.cut(events.unionByName(probes, allowMissingColumns=True), keys, "_at", "_tb" if tiebreak else None, rows)
    drained = seq.after(points, keys, ["_at"], "_drain", F.struct("_at"), F.col("_row").isNull()).where(F.col("_row").isNotNull())
    order = [F.col("_row._us")] + ([F.col(f"_row.{tiebreak}")] if tiebreak else [])
    firsts = drained.groupBy(*keys, "_drain").agg(
        F.count(F.lit(1)).alias("fails_in_burst"), F.min_by("_row", F.struct(*order)).alias("_first"))
    return (firsts.where(F.col("fails_in_burst") > 1)
                  .select(*[F.col(f"_first.`{c}`").alias(c) for c in cols], "fails_in_burst"))


# -------------------------------------------------------------- D2 / D3

def _lag_pairs(df: DataFrame, key, ts: str, tiebreak: str, rows: int | None, carry: list[str]) -> DataFrame:
    """Each row with ``_prev``, the struct of ``carry`` and ``_us`` of the row before it (same key, (ts, tiebreak) order), or null."""
    keys = _keys(key)
    d = seq.cut(_prep(df, ts), keys, "_us", tiebreak, rows)
    return seq.uncut(seq.before(d, keys, ["_us", tiebreak], "_prev", F.struct(*carry, "_us")))


def consecutive_fail(df: DataFrame, key, ts: str, is_fail, within="2 seconds", tiebreak: str = "seq",
                     msg: str | None = None, rows: int | None = None) -> DataFrame:
    """Two fails in a row (no success between) with t2 < t1 + within.

    The state of the reference holds the newest fail and a success clears
    it, so a warning pairs each fail with the directly preceding event of the
    key when that one is a fail too. Output: key columns, ``first_<c>`` /
    ``second_<c>`` for the tie-break and timestamps (epoch microseconds) and ``msg``.
    """
    keys = _keys(key)
    w_us = duration_us(within)
    d = df.withColumn("_fail", _cond(is_fail))
    p = _lag_pairs(d, keys, ts, tiebreak, rows, ["_fail", tiebreak])
    hit = p.where(F.col("_fail") & F.col("_prev._fail") & (F.col("_us") < F.col("_prev._us") + F.lit(w_us)))
    text = msg if msg is not None else f"login fail in {w_us // 1_000_000} seconds."
    return hit.select(*keys,
                      F.col(f"_prev.{tiebreak}").alias(f"first_{tiebreak}"),
                      F.col(tiebreak).alias(f"second_{tiebreak}"),
                      F.col("_prev._us").alias("first_us"), F.col("_us").alias("second_us"),
                      F.lit(text).alias("msg"))


def pattern_next(df: DataFrame, key, ts: str, first, second, within="2 seconds", tiebreak: str = "seq",
                 rows: int | None = None) -> DataFrame:
    """Strict contiguity: an event matching ``first`` directly followed (same
    key, event-time order) by one matching ``second``, less than ``within`` later.

    Output: key columns, ``begin_<tiebreak>``, ``next_<tiebreak>``, ``begin_us``, ``next_us``.
    """
    keys = _keys(key)
    w_us = duration_us(within)
    d = df.withColumn("_p1", _cond(first)).withColumn("_p2", _cond(second))
    p = _lag_pairs(d, keys, ts, tiebreak, rows, ["_p1", tiebreak])
    hit = p.where(F.col("_p2") & F.col("_prev._p1") & (F.col("_us") - F.col("_prev._us") < F.lit(w_us)))
    return hit.select(*keys,
                      F.col(f"_prev.{tiebreak}").alias(f"begin_{tiebreak}"),
                      F.col(tiebreak).alias(f"next_{tiebreak}"),
                      F.col("_prev._us").alias("begin_us"), F.col("_us").alias("next_us"))


# ------------------------------------------------------------------ D4

def pattern_followed_by(df: DataFrame, key, ts: str, start, end, within="15 minutes", tiebreak: str = "seq",
                        rows: int | None = None) -> DataFrame:
    """Relaxed contiguity: each ``start`` event with the first later ``end`` event of its key.

    ``outcome`` is 'success' when that end comes less than ``within`` after
    the start, else 'timeout' (the start's partial match expires). An end
    completes every start still open, and ends without a start yield nothing.
    Output: the start row's columns, ``end_<tiebreak>``, ``end_us``, ``outcome``.
    """
    keys = _keys(key)
    w_us = duration_us(within)
    cols = list(df.columns)
    d = (_prep(df, ts).withColumn("_s", _cond(start)).withColumn("_e", _cond(end))
         .where(F.col("_s") | F.col("_e")))
    d = seq.cut(d, keys, "_us", tiebreak, rows)
    nxt = F.struct(F.col("_us").alias("u"), F.col(tiebreak).alias("t"))
    m = seq.after(d, keys, ["_us", tiebreak], "_next", nxt, F.col("_e")).where("_s")
    ok = F.col("_next").isNotNull() & (F.col("_next.u") - F.col("_us") < F.lit(w_us))
    return m.select(*cols,
                    F.when(ok, F.col("_next.t")).alias(f"end_{tiebreak}"),
                    F.when(ok, F.col("_next.u")).alias("end_us"),
                    F.when(ok, F.lit("success")).otherwise(F.lit("timeout")).alias("outcome"))


# ------------------------------------------------------------------ D5

def deadline_alert(df: DataFrame, key, ts: str, start, end, within="15 minutes", tiebreak: str = "seq",
                   single_start: bool = True) -> DataFrame:
    """'order timeout' for a start with no end by start + within (inclusive).

    The reference arms a timer at start + within unless an end was already
    seen, and an end at any time up to the timer (also before the start)
    suppresses the alert. With one start per key (``single_start``) that is
    exactly: no end of the key at or before start + within. The end side is
    reduced to its earliest time per key first (an aggregate, merged
    map-side), then joined to the starts, so neither side brings a key's
    raw rows together.

    ``single_start=False`` runs the timer state machine for keys with
    several starts (see ``deadline_alert_general``).
    """
    keys = _keys(key)
    w_us = duration_us(within)
    d = _prep(df, ts)
    starts = d.where(_cond(start))
    if not single_start:
        return deadline_alert_general(df, keys, ts, start, end, within, tiebreak)
    ends = d.where(_cond(end)).groupBy(*keys).agg(F.min("_us").alias("_first_end"))
    j = seq.join_keys(starts, ends, keys, "left")
    alert = j.where(F.col("_first_end").isNull() | (F.col("_first_end") > F.col("_us") + F.lit(w_us)))
    return alert.select(*df.columns, F.col("_us").alias("start_us"), F.lit("order timeout").alias("msg"))


def _timers(events: Column, w_us: int) -> Column:
    """Timer state machine over a sorted array of events (u, t, e, row), begun unpaid without timers.

    The state is the paid flag, the pending timers (starts that armed one, a
    due time once) and the starts that have alerted. Result: ``alerts``
    (places in the array) and ``dead``: paid with no timer left to clear it.
    """
    start = F.struct(F.lit(False).alias("paid"), F.array().cast("array<struct<u:bigint,i:int>>").alias("pending"),
                     F.array().cast("array<int>").alias("alerts"))

    def numbers(timers: Column) -> Column:
        return F.transform(timers, lambda p: p["i"])

    def fire(state: Column, fired: Column) -> Column:
        """Alerts after ``fired`` went off in order: while paid, the first only clears the flag."""
        quiet = F.when(state["paid"], F.slice(fired, 2, F.greatest(F.size(fired), F.lit(1)))).otherwise(fired)
        return F.concat(state["alerts"], numbers(quiet))

    def step(state: Column, x: Column) -> Column:
        fired = F.filter(state["pending"], lambda p: p["u"] + w_us < x["u"])
        left = F.filter(state["pending"], lambda p: p["u"] + w_us >= x["u"])
        paid = state["paid"] & (F.size(fired) == 0)
        arms = ~x["e"] & ~paid & ~F.exists(left, lambda p: p["u"] == x["u"])
        pending = F.when(arms, F.concat(left, F.array(F.struct(x["u"].alias("u"), x["i"].alias("i"))))).otherwise(left)
        return F.struct((paid | x["e"]).alias("paid"), pending.alias("pending"), fire(state, fired).alias("alerts"))

    def finish(state: Column) -> Column:
        return F.struct(fire(state, state["pending"]).alias("alerts"), (state["paid"] & (F.size(state["pending"]) == 0)).alias("dead"))

    numbered = F.transform(events, lambda x, i: F.struct(x["u"].alias("u"), x["e"].alias("e"), i.alias("i")))
    return F.aggregate(numbered, start, step, finish)


def deadline_alert_general(df: DataFrame, key, ts: str, start, end, within="15 minutes",
                           tiebreak: str = "seq", rows: int | None = None) -> DataFrame:
    """Timer state machine of the deadline job for any number of starts per key.

    A start arms a timer unless the key is paid; an end sets the paid flag; a
    timer that fires clears the flag, or alerts when it is not set. The state
    need not be carried along a whole key: where two ends are 2 x ``within``
    apart or more, it is known to be one of two. If the key is *alive*, the
    flag was cleared less than ``within`` after the earlier end, so all starts
    in the ``within`` before the later end have armed their timers and nothing
    else is pending. If it is *dead* (an end came with no timer pending), the
    flag stays for good and nothing alerts again.

    So the ends of a key, chained by gaps below 2 x ``within``, form segments
    with the starts around them; every segment is a function of these two
    states: dead stays dead, and alive gives the segment's alerts and the next
    state by replaying its rows alone (``_timers``, a native aggregate over the
    segment's array). The functions compose along the key by the earliest
    segment that kills it. Starts with no end within ``within`` on either side
    are in no segment and alert if the key is alive.

    Ends, segments and their places are found on cut rows, so a busy key is
    spread over tasks; what one task replays is one segment. Output as
    ``deadline_alert`` (one row per alert, attributed to the first start with
    that due time).
    """
    keys = _keys(key)
    w_us = duration_us(within)
    cols = list(df.columns)
    order = ["_us", tiebreak]
    d = (_prep(df, ts).withColumn("_s", F.coalesce(_cond(start), F.lit(False))).withColumn("_e", F.coalesce(_cond(end), F.lit(False)) & ~F.col("_s"))
         .where((F.col("_s") | F.col("_e")) & F.col("_us").isNotNull()))
    c = seq.cut(d, keys, "_us", tiebreak, rows)
    at = F.struct(F.col("_us").alias("u"))
    c = seq.nearest(c, keys, order, before={"_p": (at, F.col("_e")), "_b": (at, F.col("_s"))}, after={"_q": (at, F.col("_e"))})
    gap = F.lit(2 * w_us)
    opens = F.col("_e") & (F.col("_p").isNull() | (F.col("_us") - F.col("_p.u") >= gap))
    c = seq.uncut(seq.scan(c, keys, order, {"_c": F.when(opens, 1).otherwise(0).cast("long")}))
    next_opens = F.col("_p").isNull() | (F.col("_q.u") - F.col("_p.u") >= gap)
    near_next = F.col("_q").isNotNull() & (F.col("_q.u") - F.col("_us") <= w_us)
    near_last = F.col("_p").isNotNull() & (F.col("_us") - F.col("_p.u") <= w_us)
    segment = (F.when(F.col("_e"), F.col("_c")).when(near_next, F.col("_c") + F.when(next_opens, 1).otherwise(0))
                .when(near_last, F.col("_c")))
    c = c.withColumn("_seg", segment)

    row = F.when(F.col("_s"), F.struct(*[F.col(x) for x in cols], F.col("_us").alias("start_us")))
    event = F.struct(F.col("_us").alias("u"), F.col(tiebreak).alias("t"), F.col("_e").alias("e"), row.alias("row"))
    played = (c.where(F.col("_seg").isNotNull()).groupBy(*keys, "_seg")
               .agg(F.array_sort(F.collect_list(event)).alias("_ev"), F.max("_s").alias("_any"))
               .withColumn("_m", F.when(F.col("_any"), _timers(F.col("_ev"), w_us)).otherwise(
                   F.struct(F.array().cast("array<int>").alias("alerts"), F.lit(True).alias("dead")))))  # ends alone kill the key
    dead = played.where("_m.dead").groupBy(*keys).agg(F.min("_seg").alias("_dead"))
    alerts = played.select(*keys, "_seg", F.explode(F.transform("_m.alerts", lambda i: F.get("_ev", i)["row"])).alias("_row"))
    free = c.where(F.col("_seg").isNull() & (F.col("_b").isNull() | (F.col("_b.u") < F.col("_us"))))
    # A start outside of segments comes after all segments up to its own number.
    found = alerts.unionByName(free.select(*keys, (F.col("_c") + 1).alias("_seg"), row.alias("_row")))
    alive = seq.join_keys(found, dead, keys, "left").where(F.col("_dead").isNull() | (F.col("_seg") <= F.col("_dead")))
    return alive.select(*[F.col(f"_row.`{x}`").alias(x) for x in cols], F.col("_row.start_us").alias("start_us"), F.lit("order timeout").alias("msg"))


# -------------------------------------------------------------- D6 / D7

#: Spark cuts ``row_number() <= k`` per task before the shuffle only for k below this (its windowGroupLimitThreshold).
GROUP_LIMIT = 1_000


def _quota_ranked(df: DataFrame, keys, ts: str, tiebreak: str, last: int, rows: int | None = None) -> DataFrame:
    """Rows with their place ``_n`` in their (key, UTC day), of which the first ``last`` matter.

    A small quota is a limited ``row_number``, which every task cuts before
    the shuffle. Beyond Spark's limit a busy (key, day) would be sorted whole
    by one task; its rows are cut into buckets instead, whose totals give each
    bucket's first place and which are numbered side by side.
    """
    keys = _keys(keys)
    d = _prep(df, ts).withColumn("_day", utc_day(ts))
    if last < GROUP_LIMIT and rows is None:
        return d.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_day").orderBy("_us", tiebreak)))
    group = [*keys, "_day"]
    return seq.uncut(seq.row_number(seq.cut(d, group, "_us", tiebreak, rows), group, ["_us", tiebreak], "_n"))


def quota_filter(df: DataFrame, keys, ts: str, max_count: int = 100, tiebreak: str = "seq",
                 rows: int | None = None) -> DataFrame:
    """Rows that pass a per-key daily quota: the first max_count + 1 of each
    (key, UTC day) in event-time order (the reference checks the count before
    incrementing, so one more than the maximum passes)."""
    r = _quota_ranked(df, keys, ts, tiebreak, max_count + 1, rows)
    return r.where(F.col("_n") <= max_count + 1).drop("_us", "_day", "_n")


def quota_alerts(df: DataFrame, keys, ts: str, max_count: int = 100, tiebreak: str = "seq",
                 msg: str | None = None, rows: int | None = None) -> DataFrame:
    """One warning per (key, UTC day): the first blocked row."""
    keys = _keys(keys)
    r = _quota_ranked(df, keys, ts, tiebreak, max_count + 2, rows)
    text = msg if msg is not None else f"Click over {max_count} times today."
    return (r.where(F.col("_n") == max_count + 2)
             .select(*keys, F.col("_day").alias("day"), F.col(tiebreak), F.col("_us").alias("blocked_us"),
                     F.lit(text).alias("msg")))


def quota_outcome(df: DataFrame, keys, ts: str, max_count: int = 100, tiebreak: str = "seq",
                  rows: int | None = None) -> DataFrame:
    """Every row tagged 'pass', 'blocked_first' or 'blocked' (side-output form).

    Of a small quota only the first max_count + 2 rows of a (key, day) carry a
    rank (a limited ``row_number``, cut per task before the shuffle); all rows
    are tagged by an equi-join on (key, day, tie-break), which spreads a hot
    key's rows by their tie-break instead of sorting the whole key in one task.
    Larger quotas number the rows of a key in buckets (``_quota_ranked``).
    """
    keys = _keys(keys)
    out = (F.when(F.col("_n") <= max_count + 1, "pass")
            .when(F.col("_n") == max_count + 2, "blocked_first").otherwise("blocked"))
    ranked = _quota_ranked(df, keys, ts, tiebreak, max_count + 2, rows)
    if max_count + 2 >= GROUP_LIMIT or rows is not None:
        return ranked.withColumn("outcome", out).select(*df.columns, "outcome")
    d = _prep(df, ts).withColumn("_day", utc_day(ts))
    ranked = ranked.select(*keys, "_day", tiebreak, "_n").where(F.col("_n") <= max_count + 2)
    tagged = seq.join_keys(d, ranked, [*keys, "_day", tiebreak], how="left")
    return tagged.withColumn("outcome", out).select(*df.columns, "outcome")


# ------------------------------------------------------------------ D9

def first_seen_daily(df: DataFrame, id_col, ts: str, tiebreak: str = "seq") -> DataFrame:
    """First row of each id per UTC day (earliest event time, then tie-break).

    A ``min_by`` aggregate: partial results merge map-side, so one very
    active id never gathers its rows in one task.
    """
    keys = _keys(id_col)
    cols = list(df.columns)
    d = _prep(df, ts).withColumn("_day", utc_day(ts))
    g = d.groupBy(*keys, "_day").agg(
        F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col("_us"), F.col(tiebreak))).alias("_r"))
    return g.select("_r.*", F.col("_day").alias("day"))
