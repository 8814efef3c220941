"""Per-event running distinct count on a stream (A6, U9), seen offsets as bitmaps in the state store.

The reference fires a window function on every element and keeps the seen
offsets of a window in an external bitmap, with all events of a window on
one task. Here the bitmap of a window is dealt into chunks of 32768 offsets,
one state entry per (window, chunk):

* Rows are first reduced inside each Arrow batch to one row per (window,
  offset), so a busy visitor sends one row per batch to its chunk.
* The chunk's processor answers which offsets are new and marks them. A
  timer at the window's end drops the chunk once the watermark is there.
* The events themselves pass through under salted keys that hold no state.
* Per micro-batch a bucketed scan adds the new offsets up to each event to
  the window's total before the batch; a busy window is cut over many tasks.
  The totals are a small table per batch with one row per window that the
  watermark has not passed; only the two newest are kept.

Events are counted in arrival order (batch, then event time and tie-break
inside a batch), like the reference's per-element trigger. A batch that is
replayed after a failure starts from the totals of the batch before and
overwrites its own, so it gives the same rows. Rows at or behind the
watermark are dropped; rows without an event time have no window and are
left out; a NULL visitor is no visitor, but its event still gets a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from ..functions.hashing import poly_hash
from ..functions.time import duration_us, epoch_us, slot_of
from ..operators import sequence as seq
from ..session import checkpoint_location

#: Offsets per bitmap chunk: 4 KiB of state.
CHUNK = 32_768
#: Keys per window under which events pass through.
SALTS = 64
#: Kinds of rows: a first occurrence; an event; an event whose tie-break is NULL.
FIRST, EVENT, EVENT_NO_TB = 0, 1, 3


class SeenOffsets(StatefulProcessor):
    """Bitmap of one (window, chunk); emits the offsets of a batch that it has not seen, each at its first event."""

    def __init__(self, size_us: int):
        self.size_us = size_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bits = handle.getValueState("bits", "bits BINARY")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        slot, chunk = key
        if chunk < 0:  # events on their way through
            for pdf in rows:
                yield pdf[["slot", "us", "tb", "kind"]]
            return
        state = self.bits.get() if self.bits.exists() else None
        bits = np.frombuffer(state[0], np.uint8).copy() if state else np.zeros(CHUNK // 8, np.uint8)
        new = None
        for pdf in rows:
            pos = pdf["off"].to_numpy() % CHUNK
            unseen = pdf[(bits[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1 == 0]
            new = _firsts(unseen if new is None else pd.concat([new, unseen]), ["off"])
        if new is None or not len(new):
            return
        pos = new["off"].to_numpy() % CHUNK
        np.bitwise_or.at(bits, pos >> 3, np.left_shift(1, pos & 7).astype(np.uint8))
        self.bits.update((bits.tobytes(),))
        if state is None:
            self.handle.registerTimer(-(-(int(slot) + 1) * self.size_us // 1000))
        yield new[["slot", "us", "tb", "kind"]]

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.bits.clear()
        return iter([])

    def close(self) -> None:
        pass


def _firsts(pdf: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    return pdf.sort_values(["us", "tb"], kind="stable").drop_duplicates(by)


def _dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Events under salted keys, and the batch's first event of every (window, offset) under the offset's chunk."""
    for n, pdf in enumerate(batches):
        yield pdf.assign(chunk=-1 - (np.arange(len(pdf)) + n) % SALTS)
        seen = _firsts(pdf[pdf["off"] >= 0], ["slot", "off"])
        yield seen.assign(chunk=seen["off"] // CHUNK, kind=FIRST)


def seen_offsets(df: DataFrame, ts: str, col: str, size, tiebreak: str, delay, seed: int = 61, bits: int = 29) -> DataFrame:
    """Stream of (slot, us, tb, kind): every event, and a FIRST row for each offset that its window had not seen."""
    tb_type = df.schema[tiebreak].dataType
    if not isinstance(tb_type, (T.IntegralType, T.StringType)):
        raise ValueError(f"the tie-break has to be an integer or a string, not {tb_type.simpleString()}")
    least, kept = (F.lit(""), "string") if isinstance(tb_type, T.StringType) else (F.lit(-2**63), "bigint")
    off = F.when(F.col(col).isNotNull(), poly_hash(F.col(col).cast("string"), seed, bits))
    size_us = duration_us(size)
    rows = (df.where(F.col(ts).isNotNull())
              .select(slot_of(epoch_us(ts), size_us).cast("long").alias("slot"), F.lit(0).cast("long").alias("chunk"),
                      F.coalesce(off.cast("long"), F.lit(-1)).alias("off"), epoch_us(ts).alias("us"),
                      F.coalesce(F.col(tiebreak).cast(kept), least).alias("tb"),
                      F.when(F.col(tiebreak).isNull(), EVENT_NO_TB).otherwise(EVENT).alias("kind")))
    dealt = rows.mapInPandas(_dealt, T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields]))
    timed = dealt.withColumn("at", F.timestamp_micros("us")).withWatermark("at", f"{duration_us(delay)} microseconds")
    return timed.groupBy("slot", "chunk").transformWithStateInPandas(
        statefulProcessor=SeenOffsets(size_us), outputStructType=f"slot BIGINT, us BIGINT, tb {kept}, kind INT",
        outputMode="Append", timeMode="EventTime")


def _drop(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def count_batch(rows: DataFrame, batch_id: int, state_dir: str, size, delay, tiebreak: str, tb_type: str) -> DataFrame:
    """Counts of a micro-batch's events; ``rows`` are written first, as reading a stateful batch twice would run it twice."""
    spark, size_us, delay_us = rows.sparkSession, duration_us(size), duration_us(delay)
    rows.write.mode("overwrite").parquet(f"{state_dir}/rows-{batch_id}")
    rows = spark.read.schema(rows.schema).parquet(f"{state_dir}/rows-{batch_id}")
    totals = "slot BIGINT, total BIGINT, high BIGINT"
    before = spark.read.schema(totals).parquet(f"{state_dir}/totals-{batch_id - 1}") if batch_id else spark.createDataFrame([], totals)
    # Windows behind the watermark get no more rows; `high` is the latest event time so far.
    sums = (before.unionByName(rows.select("slot", (F.col("kind") == FIRST).cast("long").alias("total"), F.col("us").alias("high")))
                  .groupBy("slot").agg(F.sum("total").alias("total"), F.max("high").alias("high")))
    latest = sums.agg(F.max("high")).first()[0]
    live = sums.where((F.col("slot") + 1) * size_us > F.lit((latest or 0) - delay_us))
    live.select("slot", "total", "high").coalesce(1).write.mode("overwrite").parquet(f"{state_dir}/totals-{batch_id}")
    marks = seq.cut(rows, "slot", "us", "tb")
    scanned = seq.uncut(seq.scan(marks, "slot", ["us", "tb", "kind"], {"new": (F.col("kind") == FIRST).cast("long")}))
    return (scanned.where(F.col("kind") != FIRST).join(before.select("slot", "total"), "slot", "left")
                   .select((F.col("slot") * size_us).alias("window_start"), ((F.col("slot") + 1) * size_us).alias("window_end"),
                           F.when(F.col("kind") == EVENT, F.col("tb")).cast(tb_type).alias(tiebreak),
                           (F.coalesce("total", F.lit(0)) + F.col("new")).alias("uv")))


def running_distinct_stream(df: DataFrame, ts: str, col: str, size, tiebreak: str, out_path: str,
                            name: str = "running_distinct", trigger: dict | None = None, delay="1 hour", **kw):
    """Start the stream; each batch's per-event counts land in ``out_path/batch=<id>``.

    ``delay`` is how far a row may be behind the latest one; a watermark that
    ``df`` already has counts too if it waits longer.
    """
    spark = df.sparkSession
    state_dir = checkpoint_location(spark, name) + "/_tables"
    own = df.schema[ts].metadata.get("spark.watermarkDelayMs", 0)
    delay = f"{max(duration_us(delay), own * 1000)} microseconds"
    tb_type = df.schema[tiebreak].dataType.simpleString()

    def each(batch: DataFrame, batch_id: int):
        res = count_batch(batch, batch_id, state_dir, size, delay, tiebreak, tb_type)
        res.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
        for old in (f"rows-{batch_id}", f"totals-{batch_id - 2}"):
            _drop(batch.sparkSession, f"{state_dir}/{old}")

    w = (seen_offsets(df, ts, col, size, tiebreak, delay, **kw).writeStream.queryName(name).outputMode("append")
           .option("checkpointLocation", checkpoint_location(spark, name)).foreachBatch(each))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
