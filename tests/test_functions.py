"""Scalar functions, UDF surface and their native twins."""

import random

from pyspark.sql import functions as F

from eventide.functions import hashing, udfs
from eventide.operators import aggregates, lateral
from eventide.sources.files import parse_access_log, parse_delimited, split_like_jvm


def test_java_hash_values(spark):
    words = ["sensor_1", "", "Brand#13", "héllo", "a😀b", "𝄞x"]
    df = spark.createDataFrame([(w,) for w in words], "s STRING")
    got = [r.h for r in df.select(hashing.java_string_hash("s").alias("h")).collect()]
    exp = [udfs._java_hash(x) for x in words]
    assert got == exp
    assert got[0] == 1262115052


def test_hash_code_native_sql_pandas_agree(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcXYZ#_09 é😀") for _ in range(rnd.randint(0, 12))) for _ in range(200)]
    df = spark.createDataFrame([(w,) for w in words], "s STRING")
    udfs.register_hash_code(spark, 10, "hash10")
    df.createOrReplaceTempView("hash_words")
    native = [r.h for r in df.select(hashing.hash_code("s", 10).alias("h")).collect()]
    sql = [r.h for r in spark.sql("SELECT hash10(s) AS h FROM hash_words").collect()]
    pdu = [r.h for r in df.select(udfs.hash_code_pandas(10)("s").alias("h")).collect()]
    exp = []
    for w in words:
        v = (udfs._java_hash(w) * 10) & 0xFFFFFFFF
        exp.append(v - (1 << 32) if v >= 1 << 31 else v)
    assert native == sql == pdu == exp


def test_poly_hash_mask(spark):
    words = ["0", "7", "123456", "987654321", "u😀"]
    df = spark.createDataFrame([(w,) for w in words], "s STRING")
    got = [r.h for r in df.select(hashing.poly_hash("s").alias("h")).collect()]
    exp = []
    for s in words:
        acc = 0
        data = s.encode("utf-16-le")
        for i in range(0, len(data), 2):
            acc = (acc * 61 + (data[i] | data[i + 1] << 8)) & 0xFFFFFFFF
        exp.append(acc & ((1 << 29) - 1))
    assert got == exp


def test_split_like_jvm(spark):
    cases = ["a#b", "a##b", "a#b##", "###", "", "#a", "x"]
    df = spark.createDataFrame([(c,) for c in cases], "s STRING")
    got = [r.p for r in df.select(split_like_jvm("s", "#").alias("p")).collect()]
    # JVM String.split: trailing empty strings removed, all-separator string -> []
    assert got == [["a", "b"], ["a", "", "b"], ["a", "b"], [], [""], ["", "a"], ["x"]]


def test_udtf_matches_native(spark):
    udfs.register_split(spark, "#", "split_hash")
    df = spark.createDataFrame([("1", "a#bb#"), ("2", "###"), ("3", "ccc")], "id STRING, s STRING")
    df.createOrReplaceTempView("split_src")
    inner = spark.sql("SELECT id, word, length FROM split_src, LATERAL split_hash(s)").collect()
    native = lateral.lateral_split(df, "s", "#").select("id", "word", "length").collect()
    assert sorted(inner) == sorted(native) == sorted([("1", "a", 1), ("1", "bb", 2), ("3", "ccc", 3)])
    outer = lateral.lateral_split(df, "s", "#", outer=True).select("id", "word").collect()
    assert ("2", None) in [tuple(r) for r in outer]


def test_accumulator_aggregates_match_native(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(1, 6), rnd.randint(-500, 5000)) for _ in range(600)] + [(99, 7)]
    df = spark.createDataFrame(rows, "k BIGINT, v BIGINT").repartition(5)
    a = {r.k: r.avg_temp for r in udfs.avg_temp(df, "k", "v").collect()}
    b = {r.k: r.avg_temp for r in aggregates.avg_long(df, "k", "v", "avg_temp").collect()}
    assert a == b
    udfs.register_avg_temp(spark, "avg_temp_udf")
    df.createOrReplaceTempView("acc_src")
    c = {r.k: r.a for r in spark.sql("SELECT k, avg_temp_udf(v) AS a FROM acc_src GROUP BY k").collect()}
    assert a == c
    dd = df.withColumn("v", F.col("v").cast("double"))
    t1 = sorted(tuple(r) for r in udfs.top2_temp(dd, "k", "v").collect())
    t2 = sorted(tuple(r) for r in aggregates.top2(dd, "k", "v").select("k", "temp", "rank").collect())
    assert t1 == t2
    assert (99, aggregates.DOUBLE_MIN, 2) in t1


def test_parse_delimited_modes(spark):
    import pytest
    lines = spark.createDataFrame([("1,a,2.5",), ("x,b,1.0",), ("3,c",)], "value STRING")
    ok = parse_delimited(lines, "id BIGINT, name STRING, v DOUBLE", mode="PERMISSIVE")
    rows = ok.collect()
    assert [r._malformed for r in rows] == [False, True, True]
    with pytest.raises(Exception):
        parse_delimited(lines, "id BIGINT, name STRING, v DOUBLE").collect()
    sub = parse_delimited(spark.createDataFrame([("34729,create,,1558430842",)], "value STRING"),
                          "order_id BIGINT, event_type STRING, event_time BIGINT", positions=[0, 1, 3])
    assert tuple(sub.first()) == (34729, "create", 1558430842)


def test_access_log(spark):
    lines = spark.createDataFrame([("83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash.js",)],
                                  "value STRING")
    r = parse_access_log(lines).first()
    assert (r.ip, r.user_id, r.method, r.url) == ("83.149.9.216", "-", "GET", "/presentations/logstash.js")
    assert r.event_time.strftime("%Y-%m-%d %H:%M:%S") == "2015-05-17 10:05:03"
