"""Jobs on streams give the batch's rows, and rows that a job filters out still advance its event time."""

import os
import random
import uuid

from pyspark.sql import functions as F

from eventide.live import processors as P
from eventide.live import watermarks as WM
from eventide.operators import reconcile
from eventide.plans import jobs
from eventide.session import checkpoint_location
from fixture_rows import fixture_path


def _folder(tmp_path, name, chunks):
    """A file per chunk of lines, to be taken in that order."""
    d = tmp_path / f"{name}-{uuid.uuid4().hex[:6]}"
    d.mkdir()
    for k, lines in enumerate(chunks):
        (d / f"p{k:02d}.csv").write_text("\n".join(lines) + "\n")
        os.utime(d / f"p{k:02d}.csv", (1_700_000_000 + 10 * k, 1_700_000_000 + 10 * k))
    return str(d)


def _run(df):
    name = f"j_{uuid.uuid4().hex[:8]}"
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
           .option("checkpointLocation", checkpoint_location(df.sparkSession, name)).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.table(name)


def _behaviour(n=120, seed=5):
    rnd = random.Random(seed)
    t, out = 1_511_658_000, []
    for i in range(n):
        t += rnd.randint(0, 9)
        out.append(f"{rnd.randint(1, 9)},{rnd.randint(100, 112)},5,{rnd.choice(['pv', 'pv', 'cart', 'buy'])},{t}")
    return out


LATER = "1,1,1,cart,1611658000"  # no page view: only a marked row can close the windows before it


def test_hot_items_and_report_close_by_rows_that_are_filtered_out(spark, tmp_path):
    rows = _behaviour()
    live, batch = _folder(tmp_path, "ub", [rows, [LATER]]), _folder(tmp_path, "ub", [rows])
    cols = ["window_end", "item_id", "cnt", "rank"]
    got = _run(jobs.hot_items(spark, live, live=True)).select(*cols).collect()
    want = jobs.hot_items(spark, batch).select(*cols).collect()
    assert sorted(got) == sorted(want) and len(got) > 50
    rep = {r.window_end: r.report for r in _run(jobs.hot_items_report(spark, live, live=True)).collect()}
    assert rep == {r.window_end: r.report for r in jobs.hot_items_report(spark, batch).collect()}


def test_visitors_close_by_rows_that_are_filtered_out(spark, tmp_path):
    rows = _behaviour(60)
    live, batch = _folder(tmp_path, "ub", [rows, [LATER]]), _folder(tmp_path, "ub", [rows])
    cols = ["window_start", "uv"]
    want = sorted(jobs.unique_visitors(spark, batch).select(*cols).collect())
    assert sorted(_run(jobs.unique_visitors(spark, live, live=True)).select(*cols).collect()) == want
    assert sorted(_run(jobs.unique_visitors_bitmap(spark, live, live=True)).select(*cols).collect()) == want


def test_web_log_on_a_stream(spark, tmp_path):
    rnd = random.Random(3)
    line = lambda s, url: f"10.0.0.1 - u {s} +0000 GET {url}"
    stamp = lambda k: f"17/05/2015:10:{k // 60:02d}:{k % 60:02d}"
    rows = [line(stamp(k), rnd.choice(["/a", "/b", "/c", "/d.css", "/e", "/f", "/g.js", "/h"])) for k in range(0, 240, 7)]
    live = _folder(tmp_path, "log", [rows, [line("18/05/2016:00:00:00", "/late.css")]])
    cols = ["window_end", "url", "cnt", "rank"]
    got = _run(jobs.network_flow(spark, live, live=True, n=2)).select(*cols).collect()
    assert sorted(got) == sorted(jobs.network_flow(spark, _folder(tmp_path, "log", [rows]), n=2).select(*cols).collect())


def test_marketing_total_on_a_stream(spark, tmp_path):
    rows = [f"u{k},{'UNINSTALL' if k % 4 == 0 else 'CLICK'},weibo,{1_600_000_000_000 + 700 * k}" for k in range(12)]
    live = _folder(tmp_path, "mk", [rows, ["u,UNINSTALL,weibo,1700000000000"]])
    got = _run(jobs.marketing_total(spark, live, live=True)).groupBy("behavior", "channel").agg(F.count("*").alias("n"), F.sum("cnt").alias("s")).collect()
    want = jobs.marketing_total(spark, _folder(tmp_path, "mk", [rows])).groupBy("behavior", "channel").agg(F.count("*").alias("n"), F.sum("cnt").alias("s")).collect()
    assert sorted(got) == sorted(want)


def test_pattern_and_blacklist_on_streams(spark, tmp_path):
    with open(fixture_path("LoginLog.csv")) as f:
        logins = f.read().split()
    live = _folder(tmp_path, "lg", [logins, ["0,0.0.0.0,success,1800000000"]])
    assert _run(jobs.login_fail_pattern(spark, live, live=True)).count() == jobs.login_fail_pattern(spark, fixture_path("LoginLog.csv")).count() == 2
    with open(fixture_path("AdClickLog.csv")) as f:
        clicks = f.read().split()
    live = _folder(tmp_path, "ad", [clicks, ["0,0,none,none,1800000000"]])
    warned = _run(jobs.ad_clicks_blacklist(spark, live, live=True)[1]).collect()
    assert [(r.user_id, r.ad_id, r.msg) for r in warned] == [(r.user_id, r.ad_id, r.msg) for r in jobs.ad_clicks_blacklist(spark, fixture_path("AdClickLog.csv"))[1].collect()]


def test_reconciliation_has_one_rule(spark, tmp_path):
    """Repeats on both sides, ties and rows beyond the wait: the stream pairs as the batch does."""
    rnd = random.Random(9)
    t0 = 1_700_000_000
    rows = {side: [(i, rnd.choice("abc"), t0 + rnd.randint(0, 400)) for i in range(lo, lo + 70)] for side, lo in (("l", 0), ("r", 1000))}
    ddl = "id BIGINT, tx STRING, t BIGINT"
    streams, frames = [], []
    for side in "lr":
        lines = [",".join(map(str, r)) for r in rows[side]]
        path = _folder(tmp_path, side, [lines[:35], lines[35:], [f"{9000 + (side == 'r')},z{side},{t0 + 10**8}"]])
        s = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).csv(path).withColumn("ts", F.timestamp_seconds("t"))
        streams.append(WM.with_bounded_watermark(s, "ts", "1 hour"))
        frames.append(spark.createDataFrame(rows[side], ddl).withColumn("ts", F.timestamp_seconds("t")))
    got = _run(P.match_stream(*streams, "tx", "ts", "id", "20 seconds")).where("tx NOT LIKE 'z%'").collect()
    want = reconcile.reconcile(*frames, "tx", "ts", "ts", "20 seconds", tiebreak_left="id", tiebreak_right="id").collect()
    assert sorted(((r.tx, r.l_tb, r.r_tb, r.outcome) for r in got), key=repr) == sorted(((r.tx, r.l_id, r.r_id, r.outcome) for r in want), key=repr)
