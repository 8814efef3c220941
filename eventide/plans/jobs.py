"""The reference's analytic jobs, each wired from its own input format.

Every function reads the job's input (header-less CSV or log lines, field
order as in ``FIXTURES.md``), applies the operators with the job's
parameters and returns a DataFrame. With ``live=True`` the same files
are read as a file stream with the job's watermark, and the live form
of the operator is used; start it with a sink from ``sinks.writers``.

Parameters as in the jobs (fixed values): hot items 1 min windows every
10 s, top 3; web log 10 min every 5 s, top 5, static assets dropped; unique
visitors per 1 h; bitmap offsets with seed 61 over 2^29 bits; failed logins
within 2 s (watermark 3 s); orders paid within 15 min; ad clicks per
province 1 h every 15 s, at most 100 clicks per user and ad per day;
marketing counts 1 h every 1 s per channel and behaviour, 1 h every 5 s in
total; sensor counts per 10 s tumbling window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .contract import ALL_CHANNELS_LABEL
from ..operators import aggregates, detect, filters, reconcile, topn, windows
from ..sources.files import parse_access_log, read_delimited, read_lines
from ..live import processors as P
from ..live import watermarks as WM
from ..live import windows as SW

USER_BEHAVIOR = "user_id BIGINT, item_id BIGINT, category_id INT, behavior STRING, timestamp BIGINT"
LOGIN_LOG = "user_id BIGINT, ip STRING, event_type STRING, event_time BIGINT"
ORDER_LOG = "order_id BIGINT, event_type STRING, tx_id STRING, event_time BIGINT"
RECEIPT_LOG = "tx_id STRING, pay_channel STRING, event_time BIGINT"
AD_CLICK_LOG = "user_id BIGINT, ad_id BIGINT, province STRING, city STRING, timestamp BIGINT"
MARKETING = "user_id STRING, behavior STRING, channel STRING, timestamp BIGINT"
SENSOR = "id STRING, ts BIGINT, data DOUBLE"

KEEP = "_keep"


def _read(spark, path, schema, live, ts_col, unit="s", delay="0 seconds", seq: str | None = "seq"):
    df = read_delimited(spark, path, schema, live=live)
    conv = F.timestamp_seconds if unit == "s" else F.timestamp_millis
    df = df.withColumn("ts", conv(F.col(ts_col)))
    if seq:
        # Tie-break among equal timestamps: file position in batch reads; a
        # file stream keeps no line order, so there a content hash is used.
        df = df.withColumn(seq, F.xxhash64(*[F.col(c) for c in df.columns if c != "ts"]) if live
                           else F.monotonically_increasing_id())
    if live:
        df = WM.with_bounded_watermark(df, "ts", delay)
    return df


# ----------------------------------------------------------------- hot items / traffic

def hot_items(spark: SparkSession, path: str, live: bool = False, n: int = 3) -> DataFrame:
    """Top n items by page views per 1 min window sliding by 10 s (one row per ranked item)."""
    ub = _read(spark, path, USER_BEHAVIOR, live, "timestamp", delay="1 second", seq=None)
    if live:
        return SW.windowed_top_n(_page_views(ub), "ts", "item_id", "1 minute", "10 seconds", n, keep=KEEP)
    pv = filters.keep_behaviour(ub, "behavior", "pv")
    counts = windows.sliding_count(pv, "ts", ["item_id"], "1 minute", "10 seconds")
    return topn.top_n_per_window(counts, n, "cnt", "item_id", "window_end")


def _page_views(ub: DataFrame) -> DataFrame:
    """On a stream, rows that are no page view are marked and not dropped: they advance event time."""
    return WM.count_if_keep(ub, F.col("behavior") == "pv", KEEP)


def hot_items_report(spark: SparkSession, path: str, live: bool = False, n: int = 3) -> DataFrame:
    """One text block per window of ``hot_items``."""
    if live:
        ub = _read(spark, path, USER_BEHAVIOR, True, "timestamp", delay="1 second", seq=None)
        return SW.top_n_report(_page_views(ub), "ts", "item_id", "1 minute", "10 seconds", n, "item_id", "views", KEEP)
    return topn.format_report(hot_items(spark, path, False, n), "window_end", "item_id", "cnt", "rank",
                              "item_id", "views")


def network_flow(spark: SparkSession, path: str, live: bool = False, n: int = 5) -> DataFrame:
    """Top n urls per 10 min window sliding by 5 s from an access log."""
    lines = read_lines(spark, path, live=live)
    logs = parse_access_log(lines).withColumnRenamed("event_time", "ts")
    if live:
        logs = WM.with_bounded_watermark(logs, "ts", "1 second")
    if live:
        marked = WM.count_if_keep(logs, F.coalesce(~filters.is_static_asset("url"), F.lit(True)), KEEP)
        return SW.windowed_top_n(marked, "ts", "url", "10 minutes", "5 seconds", n, keep=KEEP)
    runs = windows.sliding_runs(filters.drop_static_assets(logs, "url"), "ts", ["url"], "10 minutes", "5 seconds")
    top = topn.top_n_over_runs(runs, n, "url")
    start = F.col("w") * 5_000_000
    return top.withColumn("window_start", start).withColumn("window_end", start + 600_000_000).drop("w")


def unique_visitors(spark: SparkSession, path: str, live: bool = False) -> DataFrame:
    """Distinct page-viewing users per hour."""
    ub = _read(spark, path, USER_BEHAVIOR, live, "timestamp", seq=None)
    if live:
        return SW.tumbling_distinct(_page_views(ub), "ts", "user_id", "1 hour", keep=KEEP)
    pv = filters.keep_behaviour(ub, "behavior", "pv")
    return windows.tumbling_distinct(pv, "ts", "user_id", "1 hour")


def unique_visitors_bitmap(spark: SparkSession, path: str, per_event: bool = True, live: bool = False) -> DataFrame:
    """Bitmap-offset visitor count per hour: per page view (running) or per window.

    The live form counts per window; the count per page view on a stream is a
    sink of its own (``live.running_distinct.running_distinct_stream``).
    """
    if live:
        ub = _read(spark, path, USER_BEHAVIOR, True, "timestamp", seq=None)
        return SW.hashed_distinct(_page_views(ub), "ts", "user_id", "1 hour", keep=KEEP)
    ub = _read(spark, path, USER_BEHAVIOR, False, "timestamp")
    pv = filters.keep_behaviour(ub, "behavior", "pv")
    if per_event:
        return windows.running_hashed_distinct(pv, "ts", "user_id", "1 hour", "seq")
    return windows.tumbling_hashed_distinct(pv, "ts", "user_id", "1 hour")


# ----------------------------------------------------------------- logins

def _fail(df):
    return F.col("event_type") == "fail"


def login_fail(spark: SparkSession, path: str, live: bool = False) -> DataFrame:
    """First fail of each burst of fails drained by the 2 s timers."""
    df = _read(spark, path, LOGIN_LOG, live, "event_time", delay="3 seconds")
    if live:
        return P.burst_stream(df, "user_id", "ts", _fail(df), "2 seconds", "seq")
    return detect.burst_detector(df, "user_id", "ts", _fail(df), "2 seconds", "seq")


def login_fail_consecutive(spark: SparkSession, path: str, live: bool = False) -> DataFrame:
    """Warnings for two fails in a row less than 2 s apart."""
    df = _read(spark, path, LOGIN_LOG, live, "event_time", delay="3 seconds")
    if live:
        return P.consecutive_fail_stream(df, "user_id", "ts", _fail(df), "2 seconds", "seq")
    return detect.consecutive_fail(df, "user_id", "ts", _fail(df), "2 seconds", "seq")


def login_fail_pattern(spark: SparkSession, path: str, live: bool = False) -> DataFrame:
    """Pattern: fail directly followed by fail within 2 s (on a stream, in event-time order, the consecutive fails)."""
    if live:
        return login_fail_consecutive(spark, path, True)
    df = _read(spark, path, LOGIN_LOG, False, "event_time")
    return detect.pattern_next(df, "user_id", "ts", _fail(df), _fail(df), "2 seconds", "seq")


# ----------------------------------------------------------------- orders

def order_timeout_pattern(spark: SparkSession, path: str, live: bool = False) -> DataFrame:
    """Each create with 'success' (paid within 15 min) or 'timeout'."""
    df = _read(spark, path, ORDER_LOG, live, "event_time")
    c, p = F.col("event_type") == "create", F.col("event_type") == "pay"
    if live:
        return P.followed_by_stream(df, "order_id", "ts", c, p, "15 minutes", "seq")
    return detect.pattern_followed_by(df, "order_id", "ts", c, p, "15 minutes", "seq")


def order_timeout_alert(spark: SparkSession, path: str, live: bool = False) -> DataFrame:
    """'order timeout' for creates not paid by create + 15 min."""
    df = _read(spark, path, ORDER_LOG, live, "event_time")
    c, p = F.col("event_type") == "create", F.col("event_type") == "pay"
    if live:
        return P.deadline_stream(df, "order_id", "ts", c, p, "15 minutes", "seq")
    return detect.deadline_alert(df, "order_id", "ts", c, p, "15 minutes", "seq", single_start=False)


def tx_match(spark: SparkSession, orders_path: str, receipts_path: str, live: bool = False,
             wait="1 hour") -> DataFrame:
    """Pays matched with receipts by transaction id (outcome matched / left_only / right_only), at most ``wait`` apart.

    Batch and stream pair by the same rule (``reconcile`` within a tolerance);
    ``wait=None`` matches a batch over the whole input.
    """
    orders = _read(spark, orders_path, ORDER_LOG, live, "event_time")
    pays = filters.non_empty(orders.where(F.col("event_type") == "pay"), "tx_id")
    receipts = filters.non_empty(_read(spark, receipts_path, RECEIPT_LOG, live, "event_time"), "tx_id")
    if live:
        return P.match_stream(pays, receipts, "tx_id", "ts", "seq", wait)
    return reconcile.reconcile(pays, receipts, "tx_id", "ts", "ts", wait, tiebreak_left="seq", tiebreak_right="seq")


# ----------------------------------------------------------------- ads and marketing

def ad_clicks_by_province(spark: SparkSession, path: str, live: bool = False) -> DataFrame:
    df = _read(spark, path, AD_CLICK_LOG, live, "timestamp", seq=None)
    if live:
        return SW.sliding_count(df, "ts", ["province"], "1 hour", "15 seconds")
    return windows.with_bounds(windows.sliding_count(df, "ts", ["province"], "1 hour", "15 seconds"), "text")


def ad_clicks_blacklist(spark: SparkSession, path: str, max_count: int = 100, live: bool = False) -> tuple[DataFrame, DataFrame]:
    """(counts per province of the clicks that pass the daily quota, blacklist warnings)."""
    if live:
        clicks = _read(spark, path, AD_CLICK_LOG, True, "timestamp")
        keys = ["user_id", "ad_id"]
        counts = P.quota_then_sliding_count(clicks, keys, "ts", max_count, "seq", ["province"], "1 hour", "15 seconds")
        tagged = P.quota_stream(clicks, keys, "ts", max_count, "seq").where(F.col("outcome") == "blocked_first")
        text = F.lit(f"Click over {max_count} times today.")
        return counts, tagged.select(*keys, F.col("t_us").alias("blocked_us"), text.alias("msg"))
    df = _read(spark, path, AD_CLICK_LOG, False, "timestamp")
    passed = detect.quota_filter(df, ["user_id", "ad_id"], "ts", max_count, "seq")
    counts = windows.with_bounds(windows.sliding_count(passed, "ts", ["province"], "1 hour", "15 seconds"), "text")
    return counts, detect.quota_alerts(df, ["user_id", "ad_id"], "ts", max_count, "seq")


def marketing_by_channel(spark: SparkSession, path: str, live: bool = False) -> DataFrame:
    """Counts per (channel, behaviour) in 1 h windows every 1 s, uninstalls dropped; bounds as text."""
    df = _read(spark, path, MARKETING, live, "timestamp", unit="ms", seq=None)
    if live:
        return SW.sliding_count(_installed(df), "ts", ["channel", "behavior"], "1 hour", "1 second", keep=KEEP)
    kept = filters.drop_behaviour(df, "behavior", "UNINSTALL")
    c = windows.sliding_count(kept, "ts", ["channel", "behavior"], "1 hour", "1 second")
    return windows.with_bounds(c, "text")


def _installed(df: DataFrame) -> DataFrame:
    return WM.count_if_keep(df, F.col("behavior") != "UNINSTALL", KEEP)


def marketing_total(spark: SparkSession, path: str, live: bool = False) -> DataFrame:
    """Counts per behaviour over all channels in 1 h windows every 5 s; bounds as text (of a stream as numbers)."""
    df = _read(spark, path, MARKETING, live, "timestamp", unit="ms", seq=None)
    if live:
        c = SW.sliding_count(_installed(df), "ts", ["behavior"], "1 hour", "5 seconds", keep=KEEP)
        return c.withColumn("channel", F.lit(ALL_CHANNELS_LABEL))
    kept = filters.drop_behaviour(df, "behavior", "UNINSTALL")
    c = windows.with_bounds(windows.sliding_count(kept, "ts", ["behavior"], "1 hour", "5 seconds"), "text")
    return c.withColumn("channel", F.lit(ALL_CHANNELS_LABEL))


# ----------------------------------------------------------------- words and table demos

def word_count(spark: SparkSession, path: str, live: bool = False) -> DataFrame:
    lines = read_lines(spark, path, live=live)
    if live:
        return SW.word_count(lines)
    return aggregates.word_count(lines, "value")


def sensor_tumbling_count(spark: SparkSession, path: str, live: bool = False) -> DataFrame:
    """Readings per sensor per 10 s tumbling window (watermark 10 s on streams)."""
    df = _read(spark, path, SENSOR, live, "ts", delay="10 seconds", seq=None)
    if live:
        return SW.tumbling_count(df, "ts", ["id"], "10 seconds")
    return windows.tumbling_count(df, "ts", ["id"], "10 seconds")
