"""Running distinct counts on a stream: random rows against a plain loop, restart, replay, bounded state."""

import os
import random
import uuid

from pyspark.sql import functions as F

from eventide.live import running_distinct as RD
from eventide.session import checkpoint_location

DDL = "user STRING, us BIGINT, seq BIGINT"
HOUR = 3_600_000_000


def _write(folder, n, rows):
    f = folder / f"part-{n:02d}.csv"
    f.write_text("".join(",".join("" if x is None else str(x) for x in r) + "\n" for r in rows))
    os.utime(f, (1_700_000_000 + n * 10, 1_700_000_000 + n * 10))


def _random_batches(n, seed=3):
    """Batches over three hours with ties in time, a busy visitor, null visitors and one null tie-break per batch."""
    rnd, seq, out = random.Random(seed), 0, []
    for _ in range(n):
        rows = []
        for i in range(120):
            seq += 1
            user = "7" if rnd.random() < 0.4 else rnd.choice([None, *map(str, range(10, 60))])
            rows.append((user, rnd.randrange(0, 3 * 360) * 10_000_000 + 5, None if i == 50 else seq))
        rnd.shuffle(rows)
        out.append(rows)
    return out


def _expected(batches):
    seen, out = {}, []
    for rows in batches:
        for user, us, seq in sorted(rows, key=lambda r: (r[1], -1 if r[2] is None else r[2])):
            users = seen.setdefault(us // HOUR, set())
            if user is not None:
                users.add(user)
            out.append((us // HOUR * HOUR, -1 if seq is None else seq, len(users)))
    return sorted(out)


def _start(spark, folder, out, name, delay):
    src = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).csv(str(folder)).withColumn("ts", F.timestamp_micros("us"))
    RD.running_distinct_stream(src, "ts", "user", "1 hour", "seq", out, name=name, trigger={"availableNow": True}, delay=delay).awaitTermination()
    return sorted((r.window_start, -1 if r.seq is None else r.seq, r.uv) for r in spark.read.parquet(out).collect())


def test_random_batches_restart_and_state(spark, tmp_path):
    folder, out, name = tmp_path / "in", str(tmp_path / "out"), f"rd_{uuid.uuid4().hex[:6]}"
    folder.mkdir()
    batches = _random_batches(5)
    for n, rows in enumerate(batches[:3]):
        _write(folder, n, rows)
    assert _start(spark, folder, out, name, "10 hours") == _expected(batches[:3])
    for n, rows in enumerate(batches[3:], start=3):  # a new query goes on from the checkpoint
        _write(folder, n, rows)
    assert _start(spark, folder, out, name, "10 hours") == _expected(batches)
    kept = os.listdir(checkpoint_location(spark, name).removeprefix("file:") + "/_tables")
    assert len([f for f in kept if f.startswith("totals-")]) <= 2 and not [f for f in kept if f.startswith("rows-")]


def test_windows_behind_the_watermark_are_dropped(spark, tmp_path):
    folder, out, name = tmp_path / "in", str(tmp_path / "out"), f"rd_{uuid.uuid4().hex[:6]}"
    folder.mkdir()
    on_time = [[("1", 5, 1), ("2", 5, 2)], [("1", 9 * HOUR, 3)], [("5", 9 * HOUR + 7, 5)]]
    late = ("3", 6, 4)  # its window was dropped two batches ago
    for n, rows in enumerate([*on_time[:2], [("1", 9 * HOUR + 1, 9)], [*on_time[2], late]]):
        _write(folder, n, rows)
    got = _start(spark, folder, out, name, "30 minutes")
    assert got == [(0, 1, 1), (0, 2, 2), (9 * HOUR, 3, 1), (9 * HOUR, 5, 2), (9 * HOUR, 9, 1)]
    tables = checkpoint_location(spark, name).removeprefix("file:") + "/_tables"
    newest = max((f for f in os.listdir(tables) if f.startswith("totals-")), key=lambda f: int(f.split("-")[1]))
    assert [tuple(r)[:2] for r in spark.read.parquet(f"{tables}/{newest}").collect()] == [(9, 2)]


def test_a_replayed_batch_gives_the_same_rows(spark, tmp_path):
    rows = spark.createDataFrame([(0, 5, 1, RD.FIRST), (0, 5, 1, RD.EVENT), (0, 8, 2, RD.EVENT)], "slot BIGINT, us BIGINT, tb BIGINT, kind INT")
    more = spark.createDataFrame([(0, 9, 3, RD.FIRST), (0, 9, 3, RD.EVENT)], "slot BIGINT, us BIGINT, tb BIGINT, kind INT")
    args = (str(tmp_path / "t"), "1 hour", "1 hour", "seq", "bigint")
    for _ in range(2):
        assert sorted(r.uv for r in RD.count_batch(rows, 0, *args).collect()) == [1, 1]
    for _ in range(2):
        assert [r.uv for r in RD.count_batch(more, 1, *args).collect()] == [2]
