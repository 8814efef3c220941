"""

Fixture rows are split into several files, read as a file stream one file
per trigger and run to completion with ``availableNow``. The last file holds
a far-future sentinel row so the final watermark closes every window and
fires every timer; sentinel keys are excluded from the comparison.
"""

import os
import uuid

from pyspark.sql import functions as F

from fixture_rows import fixture_path, read_fixture
from eventide.operators import changelog, detect, windows
from eventide.session import checkpoint_location
from eventide.live import processors as P
from eventide.live import watermarks as WM
from eventide.live import windows as SW

LOGIN = "user_id BIGINT, ip STRING, event_type STRING, event_time BIGINT, seq BIGINT"
ORDER = "order_id BIGINT, event_type STRING, tx_id STRING, event_time BIGINT, seq BIGINT"
RECEIPT = "tx_id STRING, pay_channel STRING, event_time BIGINT, seq BIGINT"
ADCLICK = "user_id BIGINT, ad_id BIGINT, province STRING, city STRING, ts_s BIGINT, seq BIGINT"


def _split_files(tmp_path, name, sentinel: str, parts=4):
    with open(fixture_path(name)) as f:
        lines = [ln.rstrip("\n") for ln in f if ln.strip()]
    lines = [f"{ln},{i}" for i, ln in enumerate(lines)]
    d = tmp_path / f"{name}-{uuid.uuid4().hex[:6]}"
    d.mkdir()
    step = -(-len(lines) // parts)
    chunks = [lines[p * step:(p + 1) * step] for p in range(parts)] + [[sentinel]]
    for p, chunk in enumerate(chunks):
        f = d / f"part-{p:02d}.csv"
        f.write_text("\n".join(chunk) + "\n")
        # The file source takes files in modification-time order.
        os.utime(f, (1_700_000_000 + p * 10, 1_700_000_000 + p * 10))
    return str(d)


def _stream(spark, path, ddl, ts_expr, delay="1 hour"):
    df = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).csv(path)
    df = df.withColumn("ts", F.expr(ts_expr))
    return WM.with_bounded_watermark(df, "ts", delay)


def _run(df, mode="append"):
    name = f"t_{uuid.uuid4().hex[:8]}"
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
           .option("checkpointLocation", checkpoint_location(df.sparkSession, name))
           .trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.table(name)


def _logins_batch(spark):
    return read_fixture(spark, "LoginLog.csv", LOGIN.rsplit(",", 1)[0]).withColumn(
        "ts", F.timestamp_seconds("event_time"))


def test_burst_stream(spark, tmp_path):
    path = _split_files(tmp_path, "LoginLog.csv", "0,0.0.0.0,success,1800000000")
    s = _run(P.burst_stream(_stream(spark, path, LOGIN, "timestamp_seconds(event_time)"), "user_id", "ts",
                            F.col("event_type") == "fail", "2 seconds", "seq"))
    b = detect.burst_detector(_logins_batch(spark), "user_id", "ts", F.col("event_type") == "fail", "2 seconds", "seq")
    assert sorted((r.user_id, r.t_tb) for r in s.collect()) == sorted((r.user_id, r.seq) for r in b.collect())
    assert s.count() == 1


def test_consecutive_stream(spark, tmp_path):
    path = _split_files(tmp_path, "LoginLog.csv", "0,0.0.0.0,success,1800000000")
    s = _run(P.consecutive_fail_stream(_stream(spark, path, LOGIN, "timestamp_seconds(event_time)"), "user_id",
                                       "ts", F.col("event_type") == "fail", "2 seconds", "seq"))
    b = detect.consecutive_fail(_logins_batch(spark), "user_id", "ts", F.col("event_type") == "fail",
                                "2 seconds", "seq")
    assert sorted((r.user_id, r.first_tb, r.second_tb) for r in s.collect()) == \
        sorted((r.user_id, r.first_seq, r.second_seq) for r in b.collect())


def _orders_batch(spark):
    return read_fixture(spark, "OrderLog.csv", ORDER.rsplit(",", 1)[0]).withColumn(
        "ts", F.timestamp_seconds("event_time"))


def test_followed_by_and_deadline_stream(spark, tmp_path):
    path = _split_files(tmp_path, "OrderLog.csv", "0,other,,1800000000")
    src = _stream(spark, path, ORDER, "timestamp_seconds(event_time)")
    is_c, is_p = F.col("event_type") == "create", F.col("event_type") == "pay"
    s = _run(P.followed_by_stream(src, "order_id", "ts", is_c, is_p, "15 minutes", "seq"))
    b = detect.pattern_followed_by(_orders_batch(spark), "order_id", "ts", is_c, is_p, "15 minutes", "seq")
    assert sorted((r.order_id, r.start_tb, r.end_tb, r.outcome) for r in s.collect()) == \
        sorted((r.order_id, r.seq, r.end_seq, r.outcome) for r in b.collect())
    src2 = _stream(spark, path, ORDER, "timestamp_seconds(event_time)")
    s2 = _run(P.deadline_stream(src2, "order_id", "ts", is_c, is_p, "15 minutes", "seq"))
    assert sorted(r.order_id for r in s2.collect()) == [52021, 52032]


def test_quota_stream(spark, tmp_path):
    path = _split_files(tmp_path, "AdClickLog.csv", "0,0,none,none,1800000000")
    src = _stream(spark, path, ADCLICK, "timestamp_seconds(ts_s)")
    s = _run(P.quota_stream(src, ["user_id", "ad_id"], "ts", 100, "seq")).where("user_id != 0")
    counts = {r.outcome: r["count"] for r in s.groupBy("outcome").count().collect()}
    assert counts == {"pass": 123, "blocked_first": 1}


def test_match_stream(spark, tmp_path):
    op = _split_files(tmp_path, "OrderLog.csv", "0,other,zzz,1800000000")
    rp = _split_files(tmp_path, "ReceiptLog.csv", "yyy,none,1800000000")
    pays = _stream(spark, op, ORDER, "timestamp_seconds(event_time)").where(
        (F.col("event_type") == "pay") | (F.col("order_id") == 0))
    receipts = _stream(spark, rp, RECEIPT, "timestamp_seconds(event_time)")
    s = _run(P.match_stream(pays, receipts, "tx_id", "ts", "seq", "30 minutes")).where(
        ~F.col("tx_id").isin("zzz", "yyy"))
    rows = s.collect()
    assert sum(1 for r in rows if r.outcome == "matched") == 38
    assert sorted(r.tx_id for r in rows if r.outcome == "left_only") == ["tx9676f", "txonly1"]
    assert sorted(r.tx_id for r in rows if r.outcome == "right_only") == ["txlost01", "txlost02"]


def test_changelog_stream(spark, tmp_path):
    path = _split_files(tmp_path, "LoginLog.csv", "0,0.0.0.0,sentinel,1800000000")
    s = _run(P.changelog_stream(_stream(spark, path, LOGIN, "timestamp_seconds(event_time)"), "event_type",
                                "ts", "seq")).where("event_type != 'sentinel'")
    b = changelog.count_changelog(_logins_batch(spark), "event_type", "ts", "seq")
    assert sorted((r.event_type, r.t_tb, r.is_add, r.cnt) for r in s.collect()) == \
        sorted((r.event_type, r.seq, r.is_add, r.cnt) for r in b.collect())


def _clicks_batch(spark):
    return read_fixture(spark, "AdClickLog.csv", ADCLICK.rsplit(",", 1)[0]).withColumn(
        "ts", F.timestamp_seconds("ts_s"))


def test_window_streams(spark, tmp_path):
    path = _split_files(tmp_path, "AdClickLog.csv", "0,0,zz_sentinel,none,1800000000")
    src = _stream(spark, path, ADCLICK, "timestamp_seconds(ts_s)")
    s = _run(SW.sliding_count(src, "ts", ["province"], "1 hour", "15 seconds")).where("province != 'zz_sentinel'")
    b = windows.sliding_count(_clicks_batch(spark), "ts", ["province"], "1 hour", "15 seconds")
    cols = ["province", "window_start", "window_end", "cnt"]
    assert sorted(s.select(*cols).collect()) == sorted(b.select(*cols).collect())

    src = _stream(spark, path, ADCLICK, "timestamp_seconds(ts_s)").where("province != 'zz_sentinel' or ts_s > 0")
    uv = _run(SW.tumbling_distinct(src, "ts", "user_id", "1 hour"))
    ub = windows.tumbling_distinct(_clicks_batch(spark), "ts", "user_id", "1 hour")
    got = {(r.window_start, r.uv) for r in uv.collect() if r.window_start < 1800000000 * 10**6 - 3600 * 10**6}
    assert got == {(r.window_start, r.uv) for r in ub.collect()}


def test_live_top_n(spark, tmp_path):
    path = _split_files(tmp_path, "AdClickLog.csv", "0,0,zz_sentinel,none,1800000000")
    src = _stream(spark, path, ADCLICK, "timestamp_seconds(ts_s)")
    s = _run(SW.windowed_top_n(src, "ts", "province", "1 hour", "5 minutes", 2))
    s = s.where(F.col("window_end") < 1800000000 * 10**6 - 3600 * 10**6)
    from eventide.operators import topn
    c = windows.sliding_count(_clicks_batch(spark), "ts", ["province"], "1 hour", "5 minutes")
    b = topn.top_n_per_window(c, 2, "cnt", "province", "window_end")
    assert sorted((r.window_end, r.province, r.cnt, r.rank) for r in s.collect()) == \
        sorted((r.window_end, r.province, r.cnt, r.rank) for r in b.collect())


def test_first_seen_stream(spark, tmp_path):
    path = _split_files(tmp_path, "AdClickLog.csv", "0,0,none,none,1800000000")
    src = _stream(spark, path, ADCLICK, "timestamp_seconds(ts_s)")
    s = _run(SW.first_seen(src, "user_id", "ts")).where("user_id != 0")
    b = _clicks_batch(spark).select("user_id", F.floor(F.col("ts_s") / 86400).alias("day")).distinct()
    assert sorted((r.user_id, r.day) for r in s.collect()) == sorted((r.user_id, r.day) for r in b.collect())


def test_over_and_row_windows_stream(spark, tmp_path):
    from eventide.operators import over
    path = _split_files(tmp_path, "AdClickLog.csv", "0,0,none,none,1800000000")
    clicks = _clicks_batch(spark).withColumn("v", (F.col("ad_id") % 7).cast("double"))

    def src():
        return _stream(spark, path, ADCLICK, "timestamp_seconds(ts_s)").withColumn(
            "v", (F.col("ad_id") % 7).cast("double"))
    rows = _run(P.over_stream(src(), "province", "ts", "v", "seq", "rows_unbounded")).where("province != 'none'")
    b = over.over_unbounded(clicks, "province", "ts", "v", "seq", frame="rows")
    assert sorted((r.t_tb, r.cnt, round(r.total, 6)) for r in rows.collect()) == \
        sorted((r.seq, r.run_cnt, round(r.run_sum, 6)) for r in b.collect())
    rng = _run(P.over_stream(src(), "province", "ts", "v", "seq", ("range", "10 minutes"))).where(
        "province != 'none'")
    b = over.over_range_bounded(clicks, "province", "ts", "v", "10 minutes")
    assert sorted((r.t_tb, r.cnt) for r in rng.collect()) == sorted((r.seq, r.rng_cnt) for r in b.collect())
    unb = _run(P.over_stream(src(), "province", "ts", "v", "seq", "range_unbounded")).where("province != 'none'")
    b = over.over_unbounded(clicks, "province", "ts", "v", "seq", frame="range")
    assert sorted((r.t_tb, r.cnt) for r in unb.collect()) == sorted((r.seq, r.run_cnt) for r in b.collect())
    rw = _run(P.row_windows_stream(src(), "province", "ts", "seq", 10, 5)).where("province != 'none'")
    b = windows.sliding_rows(clicks, "province", "ts", "seq", 10, 5)
    assert sorted((r.province, r.end_row, r.cnt) for r in rw.collect()) == \
        sorted((r.province, r.end_row, r.cnt) for r in b.collect())
    rt = _run(P.row_windows_stream(src(), "province", "ts", "seq", 10)).where("province != 'none'")
    b = windows.tumbling_rows(clicks, "province", "ts", "seq", 10)
    assert sorted((r.province, r.cnt, r.first_us) for r in rt.collect()) == \
        sorted((r.province, r.cnt, r.first_us) for r in b.collect())


def test_top2_and_hashed_distinct_stream(spark, tmp_path):
    from eventide.operators import aggregates
    path = _split_files(tmp_path, "AdClickLog.csv", "0,0,zz_sentinel,none,1800000000")
    src = _stream(spark, path, ADCLICK, "timestamp_seconds(ts_s)").withColumn("v", (F.col("ad_id") % 97).cast("double"))
    ch = _run(P.top2_stream(src, "province", "ts", "v", "seq")).where("province != 'zz_sentinel'")
    # Replaying the changelog in event order leaves exactly the batch table aggregate.
    final, place = {}, {r.seq: (r.ts_s, r.seq) for r in _clicks_batch(spark).collect()}
    for r in sorted(ch.collect(), key=lambda r: (place[r.t_tb], r.is_add)):
        if r.is_add:
            final[(r.province, r.rank)] = r.temp
    clicks = _clicks_batch(spark).withColumn("v", (F.col("ad_id") % 97).cast("double"))
    exp = {(r.province, r.rank): r.temp for r in aggregates.top2(clicks, "province", "v").collect()}
    assert final == exp
    src = _stream(spark, path, ADCLICK, "timestamp_seconds(ts_s)")
    hd = _run(SW.hashed_distinct(src, "ts", "user_id", "1 hour"))
    got = {(r.window_start, r.uv) for r in hd.collect() if r.window_start < 1_500_000_000 * 10**6 + 10**15}
    exp = {(r.window_start, r.uv) for r in windows.tumbling_hashed_distinct(clicks, "ts", "user_id", "1 hour").collect()}
    assert {g for g in got if g[0] < 1800000000 * 10**6 - 3600 * 10**6} == exp


def test_word_count_stream_update(spark, tmp_path):
    src = tmp_path / "wc"
    src.mkdir()
    (src / "a.txt").write_text(open(fixture_path("word.log")).read() + "\n")
    lines = spark.readStream.text(str(src))
    out = _run(SW.word_count(lines), mode="update")
    assert {r.word: r.cnt for r in out.collect()} == {"spark": 3, "owl": 2, "night": 1, "plan": 2}


def test_running_distinct_stream(spark, tmp_path):
    from eventide.live.running_distinct import running_distinct_stream
    with open(fixture_path("AdClickLog.csv")) as f:
        rows = [ln.strip().split(",") for ln in f if ln.strip()]
    rows = sorted(rows, key=lambda r: int(r[4]))
    d = tmp_path / "clicks_sorted"
    d.mkdir()
    for p in range(4):
        chunk = rows[p * 36:(p + 1) * 36]
        f = d / f"part-{p}.csv"
        f.write_text("\n".join(",".join(r + [str(p * 36 + i)]) for i, r in enumerate(chunk)) + "\n")
        os.utime(f, (1_700_000_000 + p, 1_700_000_000 + p))
    src = spark.readStream.schema(ADCLICK).option("maxFilesPerTrigger", 1).csv(str(d)).withColumn(
        "ts", F.timestamp_seconds("ts_s"))
    out = str(tmp_path / "uv_out")
    q = running_distinct_stream(src, "ts", "user_id", "1 hour", "seq", out,
                                name=f"rd_{uuid.uuid4().hex[:6]}", trigger={"availableNow": True})
    q.awaitTermination()
    got = sorted((r.seq, r.window_end, r.uv) for r in spark.read.parquet(out).collect())
    batch = spark.createDataFrame([tuple(r) + (i,) for i, r in enumerate(rows)],
                                  "user_id STRING, ad_id STRING, province STRING, city STRING, ts_s STRING, seq BIGINT")
    batch = batch.withColumn("user_id", F.col("user_id").cast("long")).withColumn(
        "ts", F.timestamp_seconds(F.col("ts_s").cast("long")))
    exp = windows.running_hashed_distinct(batch, "ts", "user_id", "1 hour", "seq")
    assert got == sorted((r.seq, r.window_end, r.uv) for r in exp.collect())
    assert len(got) == 143


def test_quota_then_sliding_count_stream(spark, tmp_path):
    path = _split_files(tmp_path, "AdClickLog.csv", "0,0,zz_sentinel,none,1800000000")
    src = _stream(spark, path, ADCLICK, "timestamp_seconds(ts_s)")
    s = _run(P.quota_then_sliding_count(src, ["user_id", "ad_id"], "ts", 100, "seq", ["province"],
                                        "1 hour", "15 seconds")).where("province != 'zz_sentinel'").collect()
    assert len(s) == 4007
    assert sum(r.cnt for r in s) == 29520
    assert max(r.cnt for r in s) == 104
