"""Non-windowed aggregates: word count, group count, truncating average, top-2."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import split_like_jvm
from . import sequence as seq

# Padding of the top-2 table aggregate when a group has one value (fixed
# value: the most negative finite double).
DOUBLE_MIN = -1.7976931348623157e308


def tokenize(df: DataFrame, col: str, sep: str = " ", out: str = "word", with_position: bool = False) -> DataFrame:
    """One row per token of ``col`` split on ``sep`` (JVM split: trailing empties dropped)."""
    parts = split_like_jvm(F.col(col), sep)
    if with_position:
        return df.select("*", F.posexplode(parts).alias("pos", out))
    return df.select("*", F.explode(parts).alias(out))


def word_count(df: DataFrame, col: str, sep: str = " ", out: str = "cnt") -> DataFrame:
    """Occurrences per token; counts merge map-side before the shuffle."""
    return tokenize(df.select(col), col, sep).groupBy("word").agg(F.count(F.lit(1)).alias(out))


def running_word_count(df: DataFrame, col: str, order: str, sep: str = " ", out: str = "cnt",
                       rows: int | None = None) -> DataFrame:
    """Per token occurrence, the word's count so far (the live word count's
    output when it emits after every element), in (``order``, position) order.

    The running count is a two-level scan per (word, bucket of occurrences):
    a word with more occurrences than a bucket holds is cut along its documents.
    """
    toks = tokenize(df.select(order, col), col, sep, with_position=True).drop(col)
    d = seq.cut(toks, "word", order, "pos", rows)
    return seq.uncut(seq.row_number(d, "word", [order, "pos"], out))


def group_count(df: DataFrame, key, out: str = "cnt") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def avg_long(df: DataFrame, key, value, out: str = "avg") -> DataFrame:
    """Integer average: sum of longs div count, truncating toward zero."""
    keys = [key] if isinstance(key, str) else list(key)
    v = (F.col(value) if isinstance(value, str) else value).cast("long")
    return (df.withColumn("_v", v).groupBy(*keys)
              .agg(F.expr("sum(_v) div count(_v)").alias(out)))


def top2(df: DataFrame, key, value: str, value_out: str = "temp", rank_out: str = "rank") -> DataFrame:
    """Table aggregate emitting (highest, 1) and (second highest, 2) per key.

    Duplicates of the maximum count twice; a key with one value gets the
    most negative double as its second. ``row_number() <= 2`` is limited per
    task before the shuffle, so a hot key ships at most two rows per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc())
    best = df.where(F.col(value).isNotNull()).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= 2)
    g = best.groupBy(*keys).agg(F.max(F.when(F.col("_r") == 1, F.col(value))).alias("_v1"),
                                F.max(F.when(F.col("_r") == 2, F.col(value))).alias("_v2"))
    pairs = F.array(F.struct(F.col("_v1").alias("v"), F.lit(1).alias("r")),
                    F.struct(F.coalesce(F.col("_v2"), F.lit(DOUBLE_MIN)).alias("v"), F.lit(2).alias("r")))
    return g.select(*keys, F.inline(pairs)).withColumnRenamed("v", value_out).withColumnRenamed("r", rank_out)
