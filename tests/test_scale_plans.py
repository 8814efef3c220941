"""Physical-plan properties the design relies on at scale (plans only, no large runs)."""

import re

import pytest
from pyspark.sql import functions as F

from eventide.operators import windows
from eventide.plans import contract as C

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _window_partitions(plan: str) -> list[str]:
    """Partition-by lists of every Window operator in the plan text."""
    return re.findall(r"Window \[.*?\], \[(.*?)\], \[", plan)


def test_top_n_limits_before_shuffle(spark):
    p = _plan(C.hot_items(spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_quota_limits_before_shuffle(spark):
    p = _plan(C.quota_alert(spark, SF))
    assert re.search(r"WindowGroupLimit .* Partial", p)


@pytest.mark.parametrize("name", ["fail_burst", "fail_consecutive", "fail_pattern", "order_pattern",
                                  "over_range_1h", "over_rows_10", "over_range_all", "rows_slide",
                                  "uv_running", "word_running", "session_10m", "changelog"])
def test_sequential_operators_partition_by_bucket(spark, monkeypatch, name):
    """On inputs of more than one task's size, no window sees a whole hot key."""
    from eventide.operators import sequence
    monkeypatch.setattr(sequence, "WHOLE_BYTES", -1)
    p = _plan(C.QUERIES[name](spark, SF))
    parts = _window_partitions(p)
    assert parts, p
    # Every window that sees raw rows is keyed by a bucket too; windows over the
    # small per-bucket tables (partitioned by the key alone) are ordered by bucket.
    for part in parts:
        if "_bkt" not in part and "_b#" not in part and "_blk" not in part:
            assert re.search(r"Window \[[^\]]*\], \[" + re.escape(part) + r"\], \[(_bkt|_b)#", p), part


def test_tables_of_cut_keys_are_bounded(spark, monkeypatch):
    """What is broadcast has at most 4 * MAX_BUCKETS rows, however many rows and heavy keys there are."""
    from eventide.operators import sequence
    monkeypatch.setattr(sequence, "MAX_BUCKETS", 5)
    df = spark.range(4000).selectExpr("id % 40 AS key", "id div 900 AS t", "id AS seq")
    found = sequence.bounds(df, "key", "t", "seq", rows=1).selectExpr("size(_bnd) AS n").collect()
    assert sum(r.n for r in found) <= 4 * 5
    monkeypatch.setattr(sequence, "MAX_BUCKETS", 1000)
    found = sequence.bounds(df, "key", "t", "seq", rows=10).selectExpr("size(_bnd) AS n").collect()
    assert len(found) == 40 and all(7 <= r.n <= 22 for r in found)


def test_scan_prunes_and_pushes(spark):
    p = _plan(C.hot_items(spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(ts), EqualTo(event_type,view)]" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in p


def test_sliding_runs_has_no_per_window_row_copies(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    p = _plan(windows.sliding_count(ev, "ts", ["event_type"], "1 hour", "15 seconds"))
    # The runs strategy expands only non-zero runs (sequence over [w, next)), never slot - n + 1 .. slot.
    assert not re.search(r"sequence\(\(_slot#\d+L? - 239\)", p) and "lead(" in p


def test_no_python_in_core_queries(spark):
    for name in ["hot_items", "uv_hashed", "fail_burst", "order_deadline", "order_deadline_all", "tx_tolerance", "word_count", "hash_code", "top2"]:
        p = _plan(C.QUERIES[name](spark, SF))
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p and "FlatMapGroupsInPandas" not in p, name


def test_plain_window_when_no_key_is_hot(spark):
    """An input that one task can sort whole is not cut: one plain window, no per-bucket join."""
    p = _plan(C.QUERIES["over_rows_all"](spark, SF))
    assert "_bkt" not in p and "ShuffledHashJoin" not in p
