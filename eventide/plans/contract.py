"""Contract queries on the driver tables.

Each function takes (spark, sf_dir) and returns a DataFrame whose columns
and values equal the matching DuckDB SQL in ``plans.oracle``. Stand-ins for
the reference's record types (fixed mapping): ``view`` plays a page view;
the JSON item key ``k`` plays the item id; ``error`` plays a failed login
and the uninstall behaviour; ``signup``/``purchase`` play order create/pay;
``view`` plays a receipt; the order/transaction key is (user_id, k);
``event_type`` plays province and behaviour. The reference's second-scale
gaps are scaled to the table's pace (about one event per 4 minutes at
sf0.01). Time columns are returned as epoch numbers or text so both engines
agree exactly. Every query reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import udfs
from ..functions.hashing import hash_code as _hash_code
from ..functions.time import duration_us, epoch_us
from ..operators import aggregates, changelog as chg, detect, filters, lateral, over, reconcile, topn, windows
from ..sources.files import parse_access_log, parse_json_records
from ..sources.tables import driver_table, events

# Marketing channel names and the label of the all-channel total (fixed values).
CHANNELS = ["AppStore", "XiaomiStore", "HuaweiStore", "weibo", "wechat", "tieba"]
ALL_CHANNELS_LABEL = "全部渠道"

HOUR_US = 3_600_000_000


def _ms(c: str):
    return (F.col(c) / 1000).cast("long")


# ------------------------------------------------------------ hot items

def hot_items(spark: SparkSession, sf_dir: str, size: str = "1 minute", slide: str = "10 seconds",
              n: int = 3) -> DataFrame:
    """Most viewed items per sliding window (top 3, ties by item id)."""
    ev = events(spark, sf_dir).where(F.col("event_type") == "view").select("ts", F.col("k").alias("item_id"))
    counts = windows.sliding_count(ev, "ts", ["item_id"], size, slide, out="view_count")
    top = topn.top_n_per_window(counts, n, "view_count", "item_id", "window_end")
    return top.select(_ms("window_end").alias("window_end"), "item_id", "view_count",
                      F.col("rank").cast("int").alias("rank"))


def hot_items_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hot_items(spark, sf_dir, "1 hour", "5 minutes", 3)


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text block per window of the hourly hot items."""
    ev = events(spark, sf_dir).where(F.col("event_type") == "view").select("ts", F.col("k").alias("item_id"))
    counts = windows.sliding_count(ev, "ts", ["item_id"], "1 hour", "5 minutes", out="view_count")
    top = topn.top_n_per_window(counts, 3, "view_count", "item_id", "window_end")
    rep = topn.format_report(top, "window_end", "item_id", "view_count", "rank", "item_id", "views")
    return rep.select(_ms("window_end").alias("window_end"), "report")


# ------------------------------------------------------------ access log

def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access-log lines rendered from ``events`` (ip, user, time, method, url)."""
    ev = events(spark, sf_dir)
    url = F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), F.col("k").cast("string"),
                   F.when(F.col("k") % 10 == 3, F.lit(".css")).when(F.col("k") % 10 == 7, F.lit(".js"))
                   .otherwise(F.lit("")))
    method = F.when(F.col("event_type") == "purchase", F.lit("POST")).otherwise(F.lit("GET"))
    line = F.concat_ws(" ", F.concat(F.lit("10.0.0."), (F.col("user_id") % 250).cast("string")), F.lit("-"),
                       F.col("user_id").cast("string"), F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
                       F.lit("+0000"), method, url)
    return ev.select(line.alias("value"))


def hot_urls(spark: SparkSession, sf_dir: str, slide: str = "1 minute") -> DataFrame:
    logs = parse_access_log(access_lines(spark, sf_dir))
    pages = filters.drop_static_assets(logs, "url")
    if duration_us(slide) < 60_000_000:  # finer than the pages change: rank runs of windows, not windows
        runs = windows.sliding_runs(pages, "event_time", ["url"], "10 minutes", slide, out="hits")
        top = topn.top_n_over_runs(runs, 5, "url", "hits")
        top = top.withColumn("window_end", F.col("w") * duration_us(slide) + duration_us("10 minutes"))
    else:
        counts = windows.sliding_count(pages, "event_time", ["url"], "10 minutes", slide, out="hits")
        top = topn.top_n_per_window(counts, 5, "hits", "url", "window_end")
    return top.select(_ms("window_end").alias("window_end"), "url", "hits", F.col("rank").cast("int").alias("rank"))


def hot_urls_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web-log job at its own parameters: 10 min windows every 5 s (120 per event), top 5."""
    return hot_urls(spark, sf_dir, "5 seconds")


# ------------------------------------------------------------ unique visitors

def _views(spark, sf_dir):
    return events(spark, sf_dir).where(F.col("event_type") == "view")


def uv_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    uv = windows.tumbling_distinct(_views(spark, sf_dir), "ts", "user_id", "1 hour")
    return uv.select(_ms("window_end").alias("window_end"), "uv")


def uv_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    uv = windows.tumbling_hashed_distinct(_views(spark, sf_dir), "ts", "user_id", "1 hour")
    return uv.select(_ms("window_end").alias("window_end"), "uv")


def uv_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _views(spark, sf_dir).select("event_id", "ts", "user_id")
    r = windows.running_hashed_distinct(v, "ts", "user_id", "1 hour", "event_id")
    return r.select(_ms("window_end").alias("window_end"), "event_id", "uv")


# ------------------------------------------------------------ marketing (A2 A3)

def _marketing(spark, sf_dir):
    ev = events(spark, sf_dir)
    ev = filters.drop_behaviour(ev, "event_type", "error")
    channel = F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), (F.col("k") % len(CHANNELS) + 1).cast("int"))
    return ev.select("ts", channel.alias("channel"), F.col("event_type").alias("behavior"))


def marketing_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = windows.sliding_count(_marketing(spark, sf_dir), "ts", ["channel", "behavior"], "1 hour", "5 minutes")
    c = windows.with_bounds(c, "text")
    return c.select("window_start", "window_end", "channel", "behavior", "cnt")


def marketing_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = windows.sliding_count(_marketing(spark, sf_dir), "ts", ["behavior"], "1 hour", "5 minutes")
    c = windows.with_bounds(c, "text")
    return c.select("window_start", "window_end", F.lit(ALL_CHANNELS_LABEL).alias("channel"), "behavior", "cnt")


def _daily(df, keys: list[str], slide: str):
    """Every 1 hour window of a fine slide, summed up per key and day of the window's start."""
    c = windows.with_bounds(windows.sliding_summary(df, "ts", keys, "1 hour", slide), "text")
    return c.select(F.substring("window_start", 1, 10).alias("day"), *keys, "n_windows", "sum_cnt", "max_cnt",
                    F.col("window_start").alias("first_start"), F.col("window_end").alias("last_end"))


def marketing_channel_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's own 1 hour windows every second (3600 per event), all of them, per day."""
    keys = ["channel", "behavior"]
    return _daily(_marketing(spark, sf_dir), keys, "1 second")


def marketing_total_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's own 1 hour windows every 5 seconds, per day."""
    return _daily(_marketing(spark, sf_dir), ["behavior"], "5 seconds").withColumn("channel", F.lit(ALL_CHANNELS_LABEL))


# ------------------------------------------------------------ ad statistics

def ad_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).select("ts", F.col("event_type").alias("province"))
    c = windows.sliding_count(ev, "ts", ["province"], "1 hour", "5 minutes")
    c = windows.with_bounds(c, "text")
    return c.select("window_start", "window_end", "province", "cnt")


QUOTA_KEYS = ["user_id", "event_type"]
QUOTA_MAX = 2


def quota_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    p = detect.quota_filter(ev, QUOTA_KEYS, "ts", QUOTA_MAX, "event_id")
    return p.select("event_id", "user_id", "event_type")


def quota_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    a = detect.quota_alerts(ev, QUOTA_KEYS, "ts", QUOTA_MAX, "event_id")
    return a.select("user_id", "event_type", "day", "event_id", "blocked_us", "msg")


def _within_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    passed = detect.quota_filter(ev, QUOTA_KEYS, "ts", QUOTA_MAX, "event_id")
    return passed.withColumnRenamed("event_type", "province")


def ad_geo_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = windows.sliding_count(_within_quota(spark, sf_dir), "ts", ["province"], "1 hour", "5 minutes")
    c = windows.with_bounds(c, "text")
    return c.select("window_start", "window_end", "province", "cnt")


def ad_geo_15s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's own 1 hour windows every 15 seconds, per day."""
    ev = events(spark, sf_dir).select("ts", F.col("event_type").alias("province"))
    return _daily(ev, ["province"], "15 seconds")


def ad_geo_filtered_15s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``ad_geo_15s`` after the daily quota."""
    return _daily(_within_quota(spark, sf_dir), ["province"], "15 seconds")


# ------------------------------------------------------------ logins

def _logins(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")


def fail_burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = detect.burst_detector(_logins(spark, sf_dir), "user_id", "ts", F.col("event_type") == "error",
                              "2 hours", "event_id")
    return b.select("event_id", "user_id", epoch_us("ts").alias("ts_us"), "fails_in_burst")


def fail_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.consecutive_fail(_logins(spark, sf_dir), "user_id", "ts", F.col("event_type") == "error",
                                   "2 hours", "event_id")


def fail_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_fail = F.col("event_type") == "error"
    return detect.pattern_next(_logins(spark, sf_dir), "user_id", "ts", is_fail, is_fail, "2 hours", "event_id")


# ------------------------------------------------------------ orders

def order_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    m = detect.pattern_followed_by(ev, "user_id", "ts", F.col("event_type") == "signup",
                                   F.col("event_type") == "purchase", "1 day", "event_id")
    return m.select("event_id", "user_id", epoch_us("ts").alias("start_us"), "end_event_id", "end_us", "outcome")


def order_deadline(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", "k", "event_type")
    first_create = (ev.where(F.col("event_type") == "signup").groupBy("user_id", "k")
                      .agg(F.min_by(F.struct("event_id", "ts", "event_type"), F.struct("ts", "event_id")).alias("r"))
                      .select("r.event_id", "r.ts", "user_id", "k", "r.event_type"))
    pays = ev.where(F.col("event_type") == "purchase").select("event_id", "ts", "user_id", "k", "event_type")
    a = detect.deadline_alert(first_create.unionByName(pays), ["user_id", "k"], "ts",
                              F.col("event_type") == "signup", F.col("event_type") == "purchase", "1 day",
                              "event_id", single_start=True)
    return a.select("user_id", "k", "event_id", "start_us", "msg")


def order_deadline_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5 with every signup of a (user_id, k) key (several per key): the timer state machine."""
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", "k", "event_type")
    a = detect.deadline_alert(ev, ["user_id", "k"], "ts", F.col("event_type") == "signup",
                              F.col("event_type") == "purchase", "1 day", "event_id", single_start=False)
    return a.select("user_id", "k", "event_id", "start_us", "msg")


# Queries without an SQL twin (checked against brute force in tests instead).
NO_ORACLE: set[str] = set()


def _tx(spark, sf_dir):
    """All purchases against all views: the n-th of a key with the n-th, in time order."""
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", "k", "event_type")
    pays = ev.where(F.col("event_type") == "purchase").drop("event_type")
    receipts = ev.where(F.col("event_type") == "view").drop("event_type")
    return reconcile.reconcile(pays, receipts, ["user_id", "k"], "ts", "ts",
                               tiebreak_left="event_id", tiebreak_right="event_id")


def tx_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_tx(spark, sf_dir).where(F.col("outcome") == "matched")
            .select("user_id", "k", F.col("l_event_id").alias("pay_event_id"),
                    F.col("r_event_id").alias("receipt_event_id")))


def tx_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_tx(spark, sf_dir).where(F.col("outcome") == "left_only")
            .select("user_id", "k", F.col("l_event_id").alias("pay_event_id")))


def tx_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_tx(spark, sf_dir).where(F.col("outcome") == "right_only")
            .select("user_id", "k", F.col("r_event_id").alias("receipt_event_id")))


def tx_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All purchases against all views of a user (many of both), each with the oldest that waits, for 2 hours at most."""
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    pays = ev.where(F.col("event_type") == "purchase").drop("event_type")
    receipts = ev.where(F.col("event_type") == "view").drop("event_type")
    m = reconcile.reconcile(pays, receipts, "user_id", "ts", "ts", "2 hours", tiebreak_left="event_id", tiebreak_right="event_id")
    return m.select("user_id", F.col("l_event_id").alias("pay_event_id"), F.col("r_event_id").alias("receipt_event_id"), "outcome")


# ------------------------------------------------------------ words

def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = driver_table(spark, sf_dir, "documents").select("text")
    return aggregates.word_count(docs, "text", " ")


def word_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = driver_table(spark, sf_dir, "documents").select("doc_id", "text")
    r = aggregates.running_word_count(docs, "text", "doc_id", " ")
    return r.select("doc_id", F.col("pos").cast("long").alias("pos"), "word", "cnt")


# ------------------------------------------------------------ projection, filter, group

def filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = driver_table(spark, sf_dir, "events")
    return ev.where(F.col("event_type") == "click").select("event_id", "user_id", "value")


def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = driver_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return filters.not_null(cu, ["c_name", "c_acctbal", "c_mktsegment"])


def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.group_count(driver_table(spark, sf_dir, "events").select("user_id"), "user_id")


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = driver_table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    recs = parse_json_records(ev, "k INT")
    return aggregates.group_count(recs, "k")


def computed_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rowtime computed from epoch seconds (TO_TIMESTAMP(FROM_UNIXTIME(ts)))."""
    ev = driver_table(spark, sf_dir, "events").select("event_id", "ts")
    secs = F.floor(epoch_us("ts") / 1_000_000).cast("long")
    rt = F.timestamp_seconds(secs)
    return ev.select("event_id", secs.alias("ts_s"),
                     F.date_format(rt.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("rt"))


# ------------------------------------------------------------ table windows

def hourly_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = driver_table(spark, sf_dir, "events").select("ts", F.lower("event_type").alias("etype"), "value")
    a = windows.tumbling_avg(ev, "ts", ["etype"], "1 hour", "value", "avg_value")
    return a.select(_ms("window_end").alias("window_end"), "etype", F.round("avg_value", 6).alias("avg_value"))


def tumble_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = driver_table(spark, sf_dir, "events").select("ts", "event_type")
    c = windows.tumbling_count(ev, "ts", ["event_type"], "1 hour")
    return c.select(_ms("window_start").alias("window_start"), "event_type", "cnt")


def sql_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tumbling count written as SQL text over a temp view."""
    driver_table(spark, sf_dir, "events").createOrReplaceTempView("ev_sql_tumble")
    return spark.sql("""
        SELECT CAST(unix_micros(CAST(window.start AS TIMESTAMP)) / 1000 AS BIGINT) AS window_start,
               event_type, count(*) AS cnt
        FROM ev_sql_tumble
        GROUP BY event_type, window(ts, '1 hour')
    """)


def slide_10h(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = driver_table(spark, sf_dir, "events").select("ts", "event_type")
    c = windows.sliding_count(ev, "ts", ["event_type"], "10 hours", "1 hour")
    return c.select(_ms("window_start").alias("window_start"), "event_type", "cnt")


def slide_10h_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table job's own 10 hour windows every 5 minutes."""
    ev = driver_table(spark, sf_dir, "events").select("ts", "event_type")
    c = windows.sliding_count(ev, "ts", ["event_type"], "10 hours", "5 minutes")
    return c.select(_ms("window_start").alias("window_start"), "event_type", "cnt")


def session_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = driver_table(spark, sf_dir, "events").select("ts", "user_id")
    s = windows.session_windows(ev, "ts", "10 minutes", ["user_id"])
    return s.select("user_id", "window_start", "window_end", "cnt")


def rows_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = driver_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    r = windows.tumbling_rows(ev, "user_id", "ts", "event_id", 10)
    return r.select("user_id", "row_group", "first_us", "last_us", "cnt")


def rows_slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = driver_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    r = windows.sliding_rows(ev, "user_id", "ts", "event_id", 10, 5)
    return r.select("user_id", "end_row", "first_us", "last_us", "cnt")


# ------------------------------------------------------------ over windows

def _over_input(spark, sf_dir):
    return driver_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")


def over_range_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = over.over_unbounded(_over_input(spark, sf_dir), "user_id", "ts", "value", "event_id", frame="range")
    return o.select("event_id", "user_id", "run_cnt", F.round("run_sum", 6).alias("run_sum"))


def over_rows_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = over.over_unbounded(_over_input(spark, sf_dir), "user_id", "ts", "value", "event_id", frame="rows")
    return o.select("event_id", "user_id", "run_cnt", F.round("run_sum", 6).alias("run_sum"))


def over_range_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = over.over_range_bounded(_over_input(spark, sf_dir), "user_id", "ts", "value", "1 hour")
    return o.select("event_id", "user_id", "rng_cnt", F.round("rng_sum", 6).alias("rng_sum"))


def over_rows_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = over.over_rows_bounded(_over_input(spark, sf_dir), "user_id", "ts", "value", 10, "event_id")
    return o.select("event_id", "user_id", "rows_cnt", F.round("rows_sum", 6).alias("rows_sum"))


# ------------------------------------------------------------ lateral, UDF semantics

def split_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = driver_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return lateral.lateral_split(p, "p_brand", "#").select("p_partkey", "word", "length")


def split_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = driver_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return lateral.lateral_split(p, "p_brand", "#", outer=True).select("p_partkey", "word", "length")


def hash_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = driver_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return p.select("p_partkey", "p_brand", _hash_code("p_brand", 10).alias("hash_code"))


def avg_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = driver_table(spark, sf_dir, "events").select("event_type", "value")
    return aggregates.avg_long(ev, "event_type", (F.col("value") * 100).cast("long"), "avg_temp")


def top2(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = driver_table(spark, sf_dir, "events").select("user_id", "value")
    return aggregates.top2(ev, "user_id", "value", "temp", "rank")


# ------------------------------------------------------------ user functions called from SQL text

def hash_code_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    driver_table(spark, sf_dir, "part").createOrReplaceTempView("part_sql")
    udfs.register_hash_code(spark, 10, "hash_code_10")
    return spark.sql("SELECT p_partkey, p_brand, hash_code_10(p_brand) AS hash_code FROM part_sql")


def split_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2 in a LATERAL join: rows without words are left out."""
    driver_table(spark, sf_dir, "part").createOrReplaceTempView("part_sql")
    udfs.register_split(spark, "#", "split_hash")
    return spark.sql("SELECT p_partkey, word, length FROM part_sql, LATERAL split_hash(nullif(p_brand, 'Brand#13'))")


def split_outer_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2 in a LEFT JOIN LATERAL: rows without words stay, with nulls."""
    driver_table(spark, sf_dir, "part").createOrReplaceTempView("part_sql")
    udfs.register_split(spark, "#", "split_hash")
    return spark.sql("SELECT p_partkey, word, length FROM part_sql "
                     "LEFT JOIN LATERAL split_hash(nullif(p_brand, 'Brand#13')) ON true")


def avg_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    driver_table(spark, sf_dir, "events").createOrReplaceTempView("events_sql")
    call = udfs.register_aggregate(spark, udfs.AvgTemp(), "avg_temp_of", "avg_temp BIGINT")
    return spark.sql(call.format(rows="SELECT event_type, CAST(value * 100 AS BIGINT) AS v FROM events_sql"))


def top2_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    driver_table(spark, sf_dir, "events").createOrReplaceTempView("events_sql")
    call = udfs.register_aggregate(spark, udfs.Top2(), "top2_of", "temp DOUBLE, rank INT")
    return spark.sql(call.format(rows="SELECT user_id, value FROM events_sql"))


def top40_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More ranks than some (user, type) groups have rows, so that missing ranks occur."""
    driver_table(spark, sf_dir, "events").createOrReplaceTempView("events_sql")
    call = udfs.register_aggregate(spark, udfs.TopK(40), "top40_of", "temp DOUBLE, rank INT")
    return spark.sql(call.format(rows="SELECT user_id, event_type, value FROM events_sql"))


def first_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = driver_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    f = detect.first_seen_daily(ev, "user_id", "ts", "event_id")
    return f.select("user_id", "day", "event_id")


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = driver_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return chg.count_changelog(ev, "event_type", "ts", "event_id").select("event_type", "event_id", "is_add", "cnt")


QUERIES = {
    "hot_items": hot_items,
    "hot_items_hourly": hot_items_hourly,
    "report": report,
    "hot_urls": hot_urls,
    "hot_urls_5s": hot_urls_5s,
    "marketing_channel_1s": marketing_channel_1s,
    "marketing_total_5s": marketing_total_5s,
    "ad_geo_15s": ad_geo_15s,
    "ad_geo_filtered_15s": ad_geo_filtered_15s,
    "slide_10h_5m": slide_10h_5m,
    "uv_exact": uv_exact,
    "uv_hashed": uv_hashed,
    "uv_running": uv_running,
    "marketing_channel": marketing_channel,
    "marketing_total": marketing_total,
    "ad_geo": ad_geo,
    "ad_geo_filtered": ad_geo_filtered,
    "quota_pass": quota_pass,
    "quota_alert": quota_alert,
    "fail_burst": fail_burst,
    "fail_consecutive": fail_consecutive,
    "fail_pattern": fail_pattern,
    "order_pattern": order_pattern,
    "order_deadline": order_deadline,
    "order_deadline_all": order_deadline_all,
    "tx_pairs": tx_pairs,
    "tx_left": tx_left,
    "tx_right": tx_right,
    "tx_tolerance": tx_tolerance,
    "word_count": word_count,
    "word_running": word_running,
    "filter_project": filter_project,
    "not_null": not_null,
    "group_count": group_count,
    "json_props": json_props,
    "computed_ts": computed_ts,
    "hourly_avg": hourly_avg,
    "tumble_count": tumble_count,
    "sql_tumble": sql_tumble,
    "slide_10h": slide_10h,
    "session_10m": session_10m,
    "rows_tumble": rows_tumble,
    "rows_slide": rows_slide,
    "over_range_all": over_range_all,
    "over_rows_all": over_rows_all,
    "over_range_1h": over_range_1h,
    "over_rows_10": over_rows_10,
    "split_inner": split_inner,
    "split_outer": split_outer,
    "hash_code": hash_code,
    "avg_long": avg_long,
    "top2": top2,
    "hash_code_sql": hash_code_sql,
    "split_sql": split_sql,
    "split_outer_sql": split_outer_sql,
    "avg_sql": avg_sql,
    "top2_sql": top2_sql,
    "top40_sql": top40_sql,
    "first_daily": first_daily,
    "changelog": changelog,
}


def sliding_1h_15s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline probe: count per event type, 1 h windows sliding by 15 s."""
    ev = driver_table(spark, sf_dir, "events").select("ts", "event_type")
    c = windows.sliding_count(ev, "ts", ["event_type"], "1 hour", "15 seconds")
    return c.select("window_start", "event_type", "cnt")


QUERIES["sliding_1h_15s"] = sliding_1h_15s
