"""Typed replay state: NULLs, ties and large integers on a stream that is stopped and started again, against the batch operators."""

import os
import random
import uuid

from pyspark.sql import functions as F

from eventide.live import processors as P
from eventide.live import watermarks as WM
from eventide.operators import detect, over
from eventide.session import checkpoint_location

DDL = "k STRING, us BIGINT, seq BIGINT, v DOUBLE, status STRING"
BIG = 2**60  # beyond what floating point holds exactly


def _rows(n=240, seed=11):
    rnd = random.Random(seed)
    return [(rnd.choice(["a", "a", "a", "b"]), 10**12 + (i // 3) * 20_000_000, BIG + i, rnd.choice([None, float(rnd.randint(-9, 9))]),
             rnd.choice(["fail", "ok", "fail", None])) for i in range(n)]


def _write(folder, n, rows):
    f = folder / f"part-{n:02d}.csv"
    f.write_text("".join(",".join("" if x is None else str(x) for x in r) + "\n" for r in rows))
    os.utime(f, (1_700_000_000 + n * 10, 1_700_000_000 + n * 10))


def _run_twice(spark, tmp_path, build):
    """Run over half of the files, then a new query over the rest from the same checkpoint."""
    folder, out, name = tmp_path / "in", str(tmp_path / "out"), f"st_{uuid.uuid4().hex[:8]}"
    folder.mkdir()
    rows = _rows()
    files = [rows[:70], rows[70:125], rows[125:190], rows[190:] + [("sentinel", 10**15, BIG + 999, 0.0, "ok")]]
    for part in ((0, 1), (2, 3)):
        for n in part:
            shuffled = files[n][:]
            random.Random(n).shuffle(shuffled)
            _write(folder, n, shuffled)
        src = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).csv(str(folder)).withColumn("ts", F.timestamp_micros("us"))
        q = (build(WM.with_bounded_watermark(src, "ts", "1 minute")).writeStream.queryName(name).outputMode("append").format("parquet")
             .option("checkpointLocation", checkpoint_location(spark, name)).trigger(availableNow=True).start(out))
        q.awaitTermination()
    batch = spark.createDataFrame(rows, DDL).withColumn("ts", F.timestamp_micros("us"))
    return spark.read.parquet(out).where("k <> 'sentinel'"), batch


def test_over_range_with_nulls_and_ties_after_a_restart(spark, tmp_path):
    live, batch = _run_twice(spark, tmp_path, lambda s: P.over_stream(s, "k", "ts", "v", "seq", ("range", "3 minutes")))
    exp = {}
    for k, us, seq, _, _ in _rows():
        frame = [v for key, t, _, v, _ in _rows() if key == k and us - 180_000_000 <= t <= us]
        exp[seq] = (len(frame), sum(v or 0.0 for v in frame))
    assert {r.t_tb: (r.cnt, r.total) for r in live.collect()} == exp
    assert over.over_range_bounded(batch, "k", "ts", "v", "3 minutes", "seq").count() == len(exp)


def test_consecutive_fails_with_null_status_after_a_restart(spark, tmp_path):
    live, batch = _run_twice(spark, tmp_path, lambda s: P.consecutive_fail_stream(s, "k", "ts", "status = 'fail'", "45 seconds", "seq"))
    exp, last = set(), {}
    for k, us, seq, _, status in sorted(_rows(), key=lambda r: (r[1], r[2])):
        if status == "fail":
            if k in last and us < last[k][0] + 45_000_000:
                exp.add((k, last[k][1], seq))
            last[k] = (us, seq)
        else:
            last.pop(k, None)
    assert exp and {(r.k, r.first_tb, r.second_tb) for r in live.collect()} == exp


def test_state_that_no_row_needs_expires():
    m = P.ConsecutiveFailMachine(5, "f")
    m.on_event({"f": True, "t_us": 10, "t_tb": 1})
    assert m.expires() == 15
    q = P.QuotaMachine(1)
    q.on_event({"t_us": P.DAY_US + 3, "t_tb": 1})
    assert q.expires() == 2 * P.DAY_US
    assert P.ChangelogMachine().expires() is None
