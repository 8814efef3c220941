"""The reference's jobs wired from their own input files (fixture goldens)."""

import os
import uuid


from fixture_rows import fixture_path
from eventide.plans import jobs
from eventide.session import checkpoint_location


def test_login_jobs(spark):
    p = fixture_path("LoginLog.csv")
    assert [(r.user_id, r.event_time) for r in jobs.login_fail(spark, p).collect()] == [(7013, 1700000140)]
    assert jobs.login_fail_consecutive(spark, p).count() == 2
    assert jobs.login_fail_pattern(spark, p).count() == 2


def test_order_jobs(spark):
    p = fixture_path("OrderLog.csv")
    rows = jobs.order_timeout_pattern(spark, p).collect()
    assert sum(r.outcome == "success" for r in rows) == 37
    assert sorted(r.order_id for r in rows if r.outcome == "timeout") == [52021, 52032]
    assert sorted(r.order_id for r in jobs.order_timeout_alert(spark, p).collect()) == [52021, 52032]
    tx = jobs.tx_match(spark, p, fixture_path("ReceiptLog.csv")).collect()
    assert sum(r.outcome == "matched" for r in tx) == 38
    assert sorted(r.tx_id for r in tx if r.outcome != "matched") == ["tx9676f", "txlost01", "txlost02", "txonly1"]


def test_ad_jobs(spark):
    p = fixture_path("AdClickLog.csv")
    c = jobs.ad_clicks_by_province(spark, p).collect()
    assert len(c) == 4007 and sum(r.cnt for r in c) == 34320
    counts, alerts = jobs.ad_clicks_blacklist(spark, p)
    rows = counts.collect()
    assert len(rows) == 4007 and sum(r.cnt for r in rows) == 29520 and max(r.cnt for r in rows) == 104
    assert [(a.user_id, a.ad_id, a.msg) for a in alerts.collect()] == [(880017, 1203, "Click over 100 times today.")]


def test_word_and_sensor_jobs(spark, tmp_path):
    got = {r.word: r.cnt for r in jobs.word_count(spark, fixture_path("word.log")).collect()}
    assert got == {"spark": 3, "owl": 2, "night": 1, "plan": 2}
    sensor = tmp_path / "sensor.txt"
    sensor.write_text("sensor_1,1547718199,35.8\nsensor_1,1547718201,15.4\nsensor_6,1547718201,15.4\n"
                      "sensor_1,1547718212,6.7\n")
    c = {(r.id, r.window_start // 10**6): r.cnt for r in jobs.sensor_tumbling_count(spark, str(sensor)).collect()}
    assert c == {("sensor_1", 1547718190): 1, ("sensor_1", 1547718200): 1, ("sensor_6", 1547718200): 1,
                 ("sensor_1", 1547718210): 1}


def test_user_behavior_and_marketing_jobs(spark, tmp_path):
    ub = tmp_path / "UserBehavior.csv"
    ub.write_text("1,100,5,pv,1511658000\n2,100,5,pv,1511658005\n3,200,5,pv,1511658006\n"
                  "1,300,5,cart,1511658007\n1,100,5,pv,1511661700\n")
    top = jobs.hot_items(spark, str(ub)).collect()
    first = sorted((r.window_end, r.rank, r.item_id, r.cnt) for r in top)[0]
    assert first == (1511658010 * 10**6, 1, 100, 2)
    uv = {r.window_start // 10**6: r.uv for r in jobs.unique_visitors(spark, str(ub)).collect()}
    assert uv == {1511658000: 3, 1511661600: 1}
    run = jobs.unique_visitors_bitmap(spark, str(ub)).collect()
    assert sorted(r.uv for r in run) == [1, 1, 2, 3]
    mk = tmp_path / "marketing.csv"
    mk.write_text("u1,CLICK,weibo,1600000000000\nu2,UNINSTALL,weibo,1600000000500\nu3,CLICK,weibo,1600000001000\n")
    m = jobs.marketing_by_channel(spark, str(mk)).collect()
    assert max(r.cnt for r in m) == 2 and {r.behavior for r in m} == {"CLICK"}
    assert {r.channel for r in jobs.marketing_total(spark, str(mk)).collect()} == {jobs.ALL_CHANNELS_LABEL}


def test_login_job_live(spark, tmp_path):
    d = tmp_path / "logins"
    d.mkdir()
    lines = open(fixture_path("LoginLog.csv")).read().strip().split("\n")
    (d / "a.csv").write_text("\n".join(lines) + "\n")
    os.utime(d / "a.csv", (1_700_000_000, 1_700_000_000))
    (d / "b.csv").write_text("0,0.0.0.0,success,1800000000\n")
    os.utime(d / "b.csv", (1_700_000_100, 1_700_000_100))
    df = jobs.login_fail(spark, str(d), live=True)
    name = f"job_{uuid.uuid4().hex[:6]}"
    q = (df.writeStream.format("memory").queryName(name).option("checkpointLocation", checkpoint_location(spark, name))
           .trigger(availableNow=True).start())
    q.awaitTermination()
    assert [r.user_id for r in spark.table(name).collect()] == [7013]


def test_cli_batch_to_parquet(spark, tmp_path):
    from eventide import cli
    out = str(tmp_path / "alerts")
    assert cli.main(["order_timeout_alert", fixture_path("OrderLog.csv"), "--out", out]) == 0
    assert sorted(r.order_id for r in spark.read.parquet(out).collect()) == [52021, 52032]
    assert "tx_match" in cli.JOBS and "login_fail" in cli.JOBS
