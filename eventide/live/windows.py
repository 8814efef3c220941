"""Live forms of the window operators (append mode under a watermark).

Inputs must carry a watermark on ``ts`` (``watermarks.with_bounded_watermark``).
Outputs use the same column names as the batch operators (window bounds in
epoch microseconds) so a stream can be compared with its batch replay.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..functions.time import duration_us, format_bound, slot_of


def _bounds(df: DataFrame, w: str = "window") -> DataFrame:
    return (df.withColumn("window_start", F.unix_micros(F.col(f"{w}.start")))
              .withColumn("window_end", F.unix_micros(F.col(f"{w}.end"))).drop(w))


def _names(keys):
    return [keys] if isinstance(keys, str) else list(keys or [])


def sliding_count(df: DataFrame, ts: str, keys, size, slide=None, out: str = "cnt",
                  keep: str | None = None, pre_slot: bool = True) -> DataFrame:
    """Count per (window, keys); one row per window once the watermark closes it.

    With ``pre_slot`` (default, when size is a multiple of slide) rows are
    first counted per (slide slot, keys); each closed slot is then assigned,
    through its ``window_time``, to the size/slide windows that contain it
    and summed in a second, chained aggregation. State updates grow with
    slots, not with events x windows per event.
    ``keep`` names a boolean column (see ``watermarks.count_if_keep``): rows
    where it is false still advance event time but are not counted.
    """
    slide = slide or size
    size_us, slide_us = duration_us(size), duration_us(slide)
    keys = _names(keys)
    agg = F.count_if(F.col(keep)) if keep else F.count(F.lit(1))
    if pre_slot and size_us != slide_us and size_us % slide_us == 0:
        slots = (df.groupBy(F.window(F.col(ts), f"{slide_us} microseconds").alias("_slot"), *keys)
                   .agg(agg.alias("_c")))
        w = F.window(F.window_time("_slot"), f"{size_us} microseconds", f"{slide_us} microseconds")
        g = slots.groupBy(w.alias("window"), *keys).agg(F.sum("_c").alias(out))
    else:
        w = F.window(F.col(ts), f"{size_us} microseconds", f"{slide_us} microseconds")
        g = df.groupBy(w.alias("window"), *keys).agg(agg.alias(out))
    if keep:
        g = g.where(F.col(out) > 0)
    return _bounds(g)


def tumbling_count(df: DataFrame, ts: str, keys, size, out: str = "cnt") -> DataFrame:
    return sliding_count(df, ts, keys, size, size, out)


def session_count(df: DataFrame, ts: str, gap, keys, out: str = "cnt") -> DataFrame:
    sw = F.session_window(F.col(ts), f"{duration_us(gap)} microseconds")
    return _bounds(df.groupBy(sw.alias("window"), *_names(keys)).agg(F.count(F.lit(1)).alias(out)))


def tumbling_distinct(df: DataFrame, ts: str, col: str, size, out: str = "uv", keep: str | None = None) -> DataFrame:
    """Exact distinct count per window on a stream.

    ``keep`` as in ``sliding_count``: other rows advance event time and are no visit.

    Exact ``count(DISTINCT)`` is not supported on streams; deduplicating
    (window, value) under the watermark and then counting per window is,
    and both state stores are evicted when the window closes.
    """
    w = F.window(F.col(ts), f"{duration_us(size)} microseconds")
    value = F.when(F.col(keep), F.col(col)) if keep else F.col(col)
    d = df.withColumn("window", w).withColumn("_value", value).dropDuplicates(["window", "_value"])
    return _bounds(d.groupBy("window").agg(F.count("_value").alias(out)).where(F.col(out) > 0))


class BestOfWindow(StatefulProcessor):
    """The n best (count, key) of a window's share of keys; the state never holds more than n entries."""

    def __init__(self, n: int, key_type: str) -> None:
        self.n, self.key_type = n, key_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", f"c BIGINT, k {self.key_type}")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        found = [tuple(r) for r in self.best.get()] if self.best.exists() else []
        for part in rows:
            new = [(int(c), k.item() if hasattr(k, "item") else k) for c, k in zip(part["c"], part["k"])]
            found = sorted(found + new, key=lambda r: (-r[0], r[1]))[: self.n]
        self.best.put(found)
        self.handle.registerTimer(-(-int(key[0]) // 1000))
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        found = [tuple(r) for r in self.best.get()] if self.best.exists() else []
        self.best.clear()
        end = int(key[0])
        yield pd.DataFrame({"window_end": [end] * len(found), "c": [c for c, _ in found], "k": [k for _, k in found],
                            "at": pd.to_datetime([end - 1] * len(found), unit="us", utc=True)})

    def close(self) -> None:
        pass


#: Shares that a window's keys are dealt into before the last n are chosen.
SHARES = 16


def _best(counts: DataFrame, n: int, count: str, key: str) -> DataFrame:
    """(``window_end``, ``top``: sorted array of (neg, k, c)) of a stream of counts that still has its ``window`` struct.

    Every share of a window's keys keeps its n best as state; the last
    aggregation sees at most n of each share.
    """
    kind = counts.schema[key].dataType.simpleString()
    dealt = counts.select(F.window_time("window").alias("at"), F.unix_micros(F.col("window.end")).alias("window_end"),
                          F.pmod(F.xxhash64(key), F.lit(SHARES)).alias("share"), F.col(count).alias("c"), F.col(key).alias("k"))
    best = dealt.groupBy("window_end", "share").transformWithStateInPandas(
        statefulProcessor=BestOfWindow(n, kind), outputStructType=f"window_end BIGINT, c BIGINT, k {kind}, at TIMESTAMP",
        outputMode="Append", timeMode="EventTime", eventTimeColumnName="at")
    entry = F.struct((-F.col("c")).alias("neg"), F.col("k"), F.col("c"))
    return best.groupBy("at", "window_end").agg(F.slice(F.sort_array(F.collect_list(entry)), 1, n).alias("top")).drop("at")


def _windowed_counts(df: DataFrame, ts: str, key: str, size, slide, out: str, keep: str | None) -> DataFrame:
    """Counts per (``window``, key). When size is a multiple of slide, rows are first counted per slide slot (as in
    ``sliding_count``), so state updates grow with slots, not events."""
    size_us, slide_us = duration_us(size), duration_us(slide)
    agg = F.count_if(F.col(keep)) if keep else F.count(F.lit(1))
    if size_us != slide_us and size_us % slide_us == 0:
        slots = df.groupBy(F.window(F.col(ts), f"{slide_us} microseconds").alias("_slot"), key).agg(agg.alias("_c"))
        w = F.window(F.window_time("_slot"), f"{size_us} microseconds", f"{slide_us} microseconds")
        counts = slots.groupBy(w.alias("window"), key).agg(F.sum("_c").alias(out))
    else:
        w = F.window(F.col(ts), f"{size_us} microseconds", f"{slide_us} microseconds")
        counts = df.groupBy(w.alias("window"), key).agg(agg.alias(out))
    return counts.where(F.col(out) > 0) if keep else counts


def windowed_top_n(df: DataFrame, ts: str, key: str, size, slide, n: int, out: str = "cnt", keep: str | None = None) -> DataFrame:
    """Chained stateful operators: counts per (window, key), then the n best per window (count descending, key ascending).

    They run in append mode under one watermark; each sees a window once, when
    the one before emits it. ``keep`` as in ``sliding_count``.
    """
    size_us = duration_us(size)
    top = _best(_windowed_counts(df, ts, key, size, slide, out, keep), n, out, key).select("window_end", F.posexplode("top").alias("pos", "e"))
    return top.select((F.col("window_end") - size_us).alias("window_start"), "window_end", F.col("e.k").alias(key), F.col("e.c").alias(out), (F.col("pos") + 1).alias("rank"))


def top_n_report(df: DataFrame, ts: str, key: str, size, slide, n: int, key_label: str, count_label: str, keep: str | None = None) -> DataFrame:
    """N3 on a stream: one text block per window, as ``topn.format_report`` writes it."""
    top = _best(_windowed_counts(df, ts, key, size, slide, "_n", keep), n, "_n", key)
    lines = F.transform("top", lambda e, i: F.format_string("NO%d: %s=%s %s=%d", i + 1, F.lit(key_label), e["k"].cast("string"), F.lit(count_label), e["c"]))
    header = F.concat(F.lit("time: "), format_bound(F.col("window_end")))
    return top.select("window_end", F.concat_ws("\n", header, F.array_join(lines, "\n")).alias("report"))


def first_seen(df: DataFrame, id_col: str, ts: str, day_col: str = "day") -> DataFrame:
    """First arriving row per (id, UTC day), with state evicted when the day closes.

    The day is a 1-day tumbling window on the watermarked event time, so the
    deduplication state of a day is dropped once the watermark passes it.
    """
    d = df.withColumn("_day_w", F.window(F.col(ts), "1 day"))
    # One event-time column per stream: the day window carries it from here on.
    d = d.withColumn(ts, F.col(ts) + F.expr("INTERVAL 0 SECONDS"))
    d = d.dropDuplicates([id_col, "_day_w"])
    return (d.withColumn(day_col, slot_of(F.unix_micros(F.col("_day_w.start")), 86_400_000_000))
             .drop("_day_w"))


def hashed_distinct(df: DataFrame, ts: str, col: str, size, seed: int = 61, bits: int = 29,
                    out: str = "uv", keep: str | None = None) -> DataFrame:
    """A5 on a stream: per window, OR-merged 32768-bit bitmap chunks of the
    offsets, then a second (chained) aggregation sums the chunk popcounts.
    State per (window, chunk) is one 4 KiB bitmap."""
    from ..functions.hashing import poly_hash
    w = F.window(F.col(ts), f"{duration_us(size)} microseconds")
    off = poly_hash((F.when(F.col(keep), F.col(col)) if keep else F.col(col)).cast("string"), seed, bits)
    chunks = (df.select(w.alias("window"), off.alias("_off"))
                .groupBy("window", F.expr("bitmap_bucket_number(_off)").alias("_chunk"))
                .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_off))").alias("_bm")))
    g = chunks.groupBy("window").agg(F.sum(F.expr("bitmap_count(_bm)")).alias(out))
    return _bounds(g.where(F.col(out) > 0) if keep else g)


def word_count(lines: DataFrame, col: str = "value", sep: str = " ", out: str = "cnt") -> DataFrame:
    """G1 on a stream: running count per token; run with output mode 'update'
    (each micro-batch emits the words whose count changed)."""
    from ..sources.files import split_like_jvm
    words = lines.select(F.explode(split_like_jvm(F.col(col), sep)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias(out))
