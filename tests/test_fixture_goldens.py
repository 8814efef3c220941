
from pyspark.sql import functions as F

from fixture_rows import fixture_path, read_fixture
from eventide.operators import aggregates, detect, reconcile, windows
from eventide.sources.files import parse_json_records, read_lines

LOGIN = "user_id BIGINT, ip STRING, event_type STRING, event_time BIGINT"
ORDER = "order_id BIGINT, event_type STRING, tx_id STRING, event_time BIGINT"
RECEIPT = "tx_id STRING, pay_channel STRING, event_time BIGINT"
ADCLICK = "user_id BIGINT, ad_id BIGINT, province STRING, city STRING, ts_s BIGINT"


def _logins(spark):
    return read_fixture(spark, "LoginLog.csv", LOGIN).withColumn("ts", F.timestamp_seconds("event_time"))


def _orders(spark):
    return read_fixture(spark, "OrderLog.csv", ORDER).withColumn("ts", F.timestamp_seconds("event_time"))


def _clicks(spark):
    return read_fixture(spark, "AdClickLog.csv", ADCLICK).withColumn("ts", F.timestamp_seconds("ts_s"))


def test_fixture_sizes(spark):
    assert _logins(spark).count() == 48
    assert _orders(spark).count() == 79
    assert read_fixture(spark, "ReceiptLog.csv", RECEIPT).count() == 40
    assert _clicks(spark).count() == 143


def test_burst_detector(spark):
    r = detect.burst_detector(_logins(spark), "user_id", "ts", F.col("event_type") == "fail", "2 seconds", "seq")
    rows = [(x.user_id, x.ip, x.event_time) for x in r.collect()]
    assert rows == [(7013, "10.20.13.16", 1700000140)]


def test_consecutive_fail(spark):
    r = detect.consecutive_fail(_logins(spark), "user_id", "ts", F.col("event_type") == "fail", "2 seconds", "seq")
    got = sorted((x.user_id, x.first_us // 10**6, x.second_us // 10**6) for x in r.collect())
    assert got == [(7013, 1700000140, 1700000141), (7013, 1700000141, 1700000142)]
    assert {x.msg for x in r.collect()} == {"login fail in 2 seconds."}


def test_pattern_next(spark):
    is_fail = F.col("event_type") == "fail"
    r = detect.pattern_next(_logins(spark), "user_id", "ts", is_fail, is_fail, "2 seconds", "seq")
    got = sorted((x.user_id, x.begin_us // 10**6, x.next_us // 10**6) for x in r.collect())
    assert got == [(7013, 1700000140, 1700000141), (7013, 1700000141, 1700000142)]


def test_order_pattern(spark):
    r = detect.pattern_followed_by(_orders(spark), "order_id", "ts", F.col("event_type") == "create",
                                   F.col("event_type") == "pay", "15 minutes", "seq")
    rows = r.collect()
    assert sum(1 for x in rows if x.outcome == "success") == 37
    timeouts = sorted(x.order_id for x in rows if x.outcome == "timeout")
    assert timeouts == [52021, 52032]
    assert 52100 not in {x.order_id for x in rows}


def test_order_deadline(spark):
    r = detect.deadline_alert(_orders(spark), "order_id", "ts", F.col("event_type") == "create",
                              F.col("event_type") == "pay", "15 minutes", "seq")
    assert sorted(x.order_id for x in r.collect()) == [52021, 52032]
    assert {x.msg for x in r.collect()} == {"order timeout"}


def test_order_deadline_general_matches_single(spark):
    r = detect.deadline_alert(_orders(spark), "order_id", "ts", F.col("event_type") == "create",
                              F.col("event_type") == "pay", "15 minutes", "seq", single_start=False)
    assert sorted(x.order_id for x in r.collect()) == [52021, 52032]


def test_tx_match(spark):
    pays = _orders(spark).where((F.col("event_type") == "pay") & (F.col("tx_id") != ""))
    receipts = read_fixture(spark, "ReceiptLog.csv", RECEIPT).withColumn("ts", F.timestamp_seconds("event_time"))
    r = reconcile.reconcile(pays, receipts, "tx_id", "ts", "ts", tiebreak_left="seq", tiebreak_right="seq")
    rows = r.collect()
    assert sum(1 for x in rows if x.outcome == "matched") == 38
    left = sorted((x.tx_id, x.l_order_id) for x in rows if x.outcome == "left_only")
    assert left == [("tx9676f", 52006), ("txonly1", 52100)]
    right = sorted(x.tx_id for x in rows if x.outcome == "right_only")
    assert right == ["txlost01", "txlost02"]


def test_ad_geo_sliding(spark):
    c = windows.sliding_count(_clicks(spark), "ts", ["province"], "1 hour", "15 seconds")
    rows = c.collect()
    assert len(rows) == 4007
    assert sum(x.cnt for x in rows) == 34320
    assert max(x.cnt for x in rows) == 123
    best = {(x.province, x.window_start // 10**6) for x in rows if x.cnt == 123}
    assert ("alpha", 1700024895) in best


def test_ad_geo_sliding_native_equals_slots(spark):
    a = windows.sliding_count(_clicks(spark), "ts", ["province"], "1 hour", "15 seconds", strategy="slots")
    b = windows.sliding_count(_clicks(spark), "ts", ["province"], "1 hour", "15 seconds", strategy="native")
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())


def test_quota(spark):
    clicks = _clicks(spark)
    passed = detect.quota_filter(clicks, ["user_id", "ad_id"], "ts", 100, "seq")
    assert passed.count() == 123
    alerts = detect.quota_alerts(clicks, ["user_id", "ad_id"], "ts", 100, "seq").collect()
    assert [(a.user_id, a.ad_id, a.blocked_us // 10**6, a.msg) for a in alerts] == [
        (880017, 1203, 1700027929, "Click over 100 times today.")]
    c = windows.sliding_count(passed, "ts", ["province"], "1 hour", "15 seconds").collect()
    assert len(c) == 4007
    assert sum(x.cnt for x in c) == 29520
    assert max(x.cnt for x in c) == 104


def test_quota_outcome_tags(spark):
    tagged = detect.quota_outcome(_clicks(spark), ["user_id", "ad_id"], "ts", 100, "seq")
    counts = {r.outcome: r["count"] for r in tagged.groupBy("outcome").count().collect()}
    assert counts == {"pass": 123, "blocked_first": 1, "blocked": 19}


def test_word_count(spark):
    lines = read_lines(spark, fixture_path("word.log"))
    got = {r.word: r.cnt for r in aggregates.word_count(lines, "value").collect()}
    assert got == {"spark": 3, "owl": 2, "night": 1, "plan": 2}


def test_student_json(spark):
    lines = read_lines(spark, fixture_path("student.log"))
    schema = "school STRING, it ARRAY<STRUCT<id: STRING, name: STRING, age: INT>>"
    recs = parse_json_records(lines, schema, explode_field="it")
    assert recs.count() == 9
    assert set(recs.columns) == {"school", "id", "name", "age"}
