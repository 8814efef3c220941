"""NULL values, NULL ids and far timestamps: the same answers on every path."""

from pyspark.sql import functions as F

from eventide.functions.time import slot_of
from eventide.operators import over, windows


def test_running_sums_skip_nulls_on_bucketed_path(spark):
    rows = [(i, "k", None if i in (0, 3, 4, 5, 9) else 1.0) for i in range(14)]
    df = spark.createDataFrame(rows, "id bigint, key string, v double").withColumn("ts", F.timestamp_seconds("id"))
    plain = over.over_unbounded(df, "key", "ts", "v", "id", frame="rows")
    cut = over.over_unbounded(df, "key", "ts", "v", "id", frame="rows", rows=2)
    cols = [c for c in plain.columns if c.endswith("_sum")] or plain.columns
    assert plain.orderBy("id").select(*cols).collect() == cut.orderBy("id").select(*cols).collect()


def test_row_frames_skip_nulls(spark):
    rows = [(i, "k", v) for i, v in enumerate([1.0, 1.0, None, None, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "id bigint, key string, v double").withColumn("ts", F.timestamp_seconds("id"))
    got = [r["rows_sum"] for r in over.over_rows_bounded(df, "key", "ts", "v", 2, "id").orderBy("id").collect()]
    assert got == [1.0, 2.0, 2.0, 1.0, 1.0, 2.0]


def test_null_is_no_visitor(spark):
    rows = [(0, "a"), (1, None), (2, "b"), (3, "a")]
    df = spark.createDataFrame(rows, "id bigint, u string").withColumn("ts", F.timestamp_seconds("id"))
    got = [r["uv"] for r in windows.running_hashed_distinct(df, "ts", "u", "1 hour", "id").orderBy("id").collect()]
    assert got == [1, 1, 2, 2]


def test_slots_are_exact(spark):
    hour = 3_600_000_000
    values = [253402300799999999, -1, 0, hour - 1, hour, -hour, -hour - 1]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "us bigint").select(slot_of(F.col("us"), hour)).collect()]
    assert got == [v // hour for v in values]
