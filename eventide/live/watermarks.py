"""Event-time attributes and watermarks for unbounded DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import duration_us


def rowtime(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Make ``col`` a TIMESTAMP usable as event time (watermarks reject TIMESTAMP_NTZ)."""
    out = out or col
    return df.withColumn(out, F.col(col).cast("timestamp"))


def with_bounded_watermark(df: DataFrame, col: str, delay="1 second") -> DataFrame:
    """Bounded out-of-orderness: rows more than ``delay`` behind the max event time are late."""
    d = rowtime(df, col)
    return d.withWatermark(col, f"{duration_us(delay) // 1000} milliseconds")


def with_ascending_watermark(df: DataFrame, col: str) -> DataFrame:
    """Input declared ordered: zero delay."""
    return rowtime(df, col).withWatermark(col, "0 seconds")


def with_proctime(df: DataFrame, out: str = "proctime") -> DataFrame:
    """Processing-time attribute for windows over arrival time."""
    return df.withColumn(out, F.current_timestamp())


def count_if_keep(df: DataFrame, cond, out: str = "_keep") -> DataFrame:
    """Mark rows instead of filtering them before an aggregate.

    A filter on another column is pushed below the watermark node, so
    dropped rows would no longer advance event time. Aggregating
    ``count_if(_keep)`` and dropping zero rows afterwards keeps every row in
    the watermark computation (the reference filters after assigning
    timestamps).
    """
    c = F.expr(cond) if isinstance(cond, str) else cond
    return df.withColumn(out, c)
