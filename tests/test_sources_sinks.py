"""Sources (S1-S10) and sinks (K1-K14) on local folders."""

import glob
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from fixture_rows import fixture_path
from eventide.session import checkpoint_dir
from eventide.sinks import documents as I
from eventide.sinks import upserts as U
from eventide.sinks import writers as W
from eventide.sources import files, kafka, tables


def test_read_lines_and_delimited(spark):
    lines = files.read_lines(spark, fixture_path("LoginLog.csv"))
    assert lines.count() == 48
    df = files.read_delimited(spark, fixture_path("LoginLog.csv"),
                              "user_id BIGINT, ip STRING, event_type STRING, event_time BIGINT")
    assert df.where("event_type = 'fail'").count() == 9
    assert df.select("user_id").distinct().count() == 25


def test_table_source_and_sql(spark):
    tables.table_source(spark, "logins_tbl", fixture_path("LoginLog.csv"),
                        "user_id BIGINT, ip STRING, event_type STRING, event_time BIGINT")
    r = spark.sql("SELECT user_id, count(*) AS n FROM logins_tbl WHERE event_type = 'fail' "
                  "GROUP BY user_id ORDER BY n DESC, user_id LIMIT 1").first()
    assert (r.user_id, r.n) == (7013, 3)


def test_create_csv_table_with_computed_rowtime(spark):
    df = tables.create_csv_table(spark, "orders_ddl", fixture_path("OrderLog.csv"),
                                 [("id", "BIGINT"), ("kind", "STRING"), ("tx", "STRING"), ("ts", "BIGINT")],
                                 computed={"rt": "timestamp_seconds(ts)"})
    r = spark.sql("SELECT kind, count(*) AS n, min(rt) AS first FROM orders_ddl GROUP BY kind ORDER BY kind").collect()
    assert [(x.kind, x.n) for x in r] == [("create", 39), ("pay", 40)]
    assert "rt" in df.columns


def test_with_event_time_and_proctime(spark):
    df = spark.createDataFrame([(1, 1558430842)], "id INT, ts BIGINT")
    e = tables.with_proctime(tables.with_event_time(df, "ts", "s", "rowtime"))
    r = e.first()
    assert r.rowtime.strftime("%Y-%m-%d %H:%M:%S") == "2019-05-21 09:27:22"
    assert r.proctime is not None


def test_csv_sink_and_insert_into(spark, tmp_path):
    df = spark.createDataFrame([("1", "a", 3), ("2", "b", 4)], "id STRING, name STRING, age INT")
    out = str(tmp_path / "students")
    W.to_csv(df, out, mode="overwrite")
    back = spark.read.schema("id STRING, name STRING, age INT").csv(out)
    assert sorted(back.collect()) == sorted(df.collect())
    spark.sql("DROP TABLE IF EXISTS student_out")
    spark.sql(f"CREATE TABLE student_out (id STRING, name STRING, age INT) USING parquet "
              f"LOCATION '{tmp_path / 'student_tbl'}'")
    W.insert_into(df, "student_out")
    assert spark.table("student_out").count() == 2


def test_upsert_newest_wins(spark, tmp_path):
    target = str(tmp_path / "upsert")
    b1 = spark.createDataFrame([("a", 1, 10), ("b", 1, 20), (None, 1, 1)], "k STRING, v BIGINT, ts BIGINT")
    b2 = spark.createDataFrame([("a", 2, 30), ("a", 3, 25), ("b", 9, 5), ("c", 1, None)], "k STRING, v BIGINT, ts BIGINT")
    U.upsert_into(target, b1, "k", "ts")
    before = U.manifest(spark, target)
    U.upsert_into(target, b2, "k", "ts")
    got = {r.k: r.v for r in U.read_upserted(spark, target).collect()}
    assert got == {"a": 2, "b": 1, "c": 1, None: 1}  # b's row of order 5 does not replace the one of order 20
    after = U.manifest(spark, target)
    moved = [b for b in after["buckets"] if after["buckets"][b] != before["buckets"].get(b)]
    assert len(moved) <= 3 and after["version"] == before["version"] + 1


def test_upsert_crash_conflict_and_replay(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "upsert")
    mk = lambda rows: spark.createDataFrame(rows, "k STRING, v BIGINT, ts BIGINT")
    U.upsert_into(target, mk([("a", 1, 1)]), "k", "ts", "s", 0)
    real = U.commit
    monkeypatch.setattr(U, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost driver")))
    with pytest.raises(OSError):
        U.upsert_into(target, mk([("a", 2, 2)]), "k", "ts", "s", 1)
    assert [r.v for r in U.read_upserted(spark, target).collect()] == [1]  # as before the crash
    # Another writer takes the version first: the merge starts again on its result.
    monkeypatch.setattr(U, "commit", real)
    calls = []

    def racing(spark_, target_, new):
        if not calls:
            calls.append(1)
            U.upsert_into(target, mk([("b", 5, 5)]), "k", "ts", "other", 7)
        real(spark_, target_, new)
    monkeypatch.setattr(U, "commit", racing)
    U.upsert_into(target, mk([("a", 2, 2)]), "k", "ts", "s", 1)
    assert {r.k: r.v for r in U.read_upserted(spark, target).collect()} == {"a": 2, "b": 5}
    version = U.manifest(spark, target)["version"]
    U.upsert_into(target, mk([("a", 99, 99)]), "k", "ts", "s", 1)  # replayed batch
    assert U.manifest(spark, target)["version"] == version
    # A manifest that was cut short does not count, and its number is used again.
    with open(f"{target}/_manifests/{version + 1:012d}.json", "w") as f:
        f.write('{"version": ')
    assert U.manifest(spark, target)["version"] == version
    U.upsert_into(target, mk([("a", 3, 3)]), "k", "ts", "s", 2)
    assert {r.k: r.v for r in U.read_upserted(spark, target).collect()} == {"a": 3, "b": 5}


def _documents(out):
    return [json.loads(x) for f in sorted(glob.glob(f"{out}/*.jsonl")) for x in open(f)]


def test_index_documents(spark, tmp_path):
    df = spark.createDataFrame([(i, f"n{i}", None if i == 3 else i) for i in range(25)], "id INT, name STRING, age INT")
    out = str(tmp_path / "index")
    for _ in range(2):  # the second run replays the batch
        I.index_documents(df.repartition(2), out, id_col="id", chunk=4)
        docs = _documents(out)
        assert sorted(int(d["_id"]) for d in docs) == list(range(25)) and {d["doc"]["age"] for d in docs if d["_id"] == "3"} == {None}
    files = glob.glob(f"{out}/*.jsonl")
    assert len(files) >= 7 and all(sum(1 for _ in open(f)) <= 4 for f in files) and not glob.glob(f"{out}/_staged*")
    I.index_documents(df.repartition(3), str(tmp_path / "own"))
    assert len({d["_id"] for d in _documents(tmp_path / "own")}) == 25
    I.index_documents(df.limit(0), str(tmp_path / "none"))
    assert _documents(tmp_path / "none") == []


def test_retried_task_leaves_no_duplicate(tmp_path):
    from pyspark.sql import Row
    rows = [Row(id=str(i), doc='{"i": %d}' % i) for i in range(10)]
    w = I.IndexWriter({"path": str(tmp_path / "ix"), "batch": "3", "chunk": "4"})
    w.write(iter(rows[:7]))          # an attempt that was lost
    kept = w.write(iter(rows))       # its retry
    w.write(iter(rows))              # a speculative copy that came too late
    w.commit([kept, None])
    assert sorted(int(d["_id"]) for d in _documents(tmp_path / "ix")) == list(range(10))
    w.write(iter(rows))
    w.abort([None])
    assert len(_documents(tmp_path / "ix")) == 10 and not glob.glob(str(tmp_path / "ix" / "_staged*"))


def test_side_outputs(spark, tmp_path):
    df = spark.createDataFrame([(1, "pass"), (2, "blocked_first"), (3, "pass")], "id INT, outcome STRING")
    paths = {"pass": str(tmp_path / "main"), "blocked_first": str(tmp_path / "alerts")}
    W.side_outputs(df, "outcome", paths)
    assert spark.read.parquet(paths["pass"] + "/batch=0").count() == 2
    assert spark.read.parquet(paths["blocked_first"] + "/batch=0").count() == 1


def test_text_batches_stream(spark, tmp_path):
    src = tmp_path / "words"
    src.mkdir()
    (src / "a.txt").write_text("hello world\nhadoop\n")
    stream = files.read_lines(spark, str(src), live=True)
    out = str(tmp_path / "out")
    q = W.to_text_batches(stream, out, name=f"text_{uuid.uuid4().hex[:6]}", trigger={"availableNow": True})
    q.awaitTermination()
    assert sorted(r.value for r in spark.read.text(out + "/batch=*").collect()) == ["hadoop", "hello world"]


def test_checkpoint_dir_is_shared_setting(spark):
    d = checkpoint_dir(spark)
    assert d == spark.conf.get("spark.checkpoint.dir")
    assert os.path.isdir(d) or d.startswith(("hdfs:", "s3", "gs:", "abfs"))


def test_kafka_options_and_encoding(spark):
    o = kafka.kafka_options("host:9092", "sensor", "earliest", "g1")
    assert o["subscribe"] == "sensor" and o["startingOffsets"] == "earliest" and o["kafka.group.id"] == "g1"
    df = spark.createDataFrame([("sensor_1", 1547718199, 35.8)], "id STRING, ts BIGINT, temp DOUBLE")
    v = kafka.to_kafka_frame(df, key_col="id").first()
    assert (v.key, v.value) == ("sensor_1", "sensor_1,1547718199,35.8")


def test_live_upsert_and_side_outputs(spark, tmp_path):
    src = tmp_path / "kv"
    src.mkdir()
    (src / "a.csv").write_text("a,1,10\nb,1,20\na,2,30\n")
    os.utime(src / "a.csv", (1_700_000_000, 1_700_000_000))
    (src / "b.csv").write_text("a,3,25\nc,1,5\n")
    os.utime(src / "b.csv", (1_700_000_010, 1_700_000_010))
    stream = spark.readStream.schema("k STRING, v BIGINT, ts BIGINT").option("maxFilesPerTrigger", 1).csv(str(src))
    target = str(tmp_path / "upserted")
    q = U.upsert(stream, "k", "ts", target, name=f"ups_{uuid.uuid4().hex[:6]}", trigger={"availableNow": True})
    q.awaitTermination()
    # a@25 arrives after a@30 and does not replace it
    assert {r.k: r.v for r in U.read_upserted(spark, target).collect()} == {"a": 2, "b": 1, "c": 1}
    tagged = spark.readStream.schema("k STRING, v BIGINT, ts BIGINT").csv(str(src)).withColumn(
        "outcome", F.when(F.col("v") > 1, "side").otherwise("main"))
    paths = {"main": str(tmp_path / "main"), "side": str(tmp_path / "side")}
    q = W.side_outputs(tagged, "outcome", paths, name=f"side_{uuid.uuid4().hex[:6]}", trigger={"availableNow": True})
    q.awaitTermination()
    assert spark.read.parquet(paths["main"] + "/batch=*").count() == 3
    assert spark.read.parquet(paths["side"] + "/batch=*").count() == 2
