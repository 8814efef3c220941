"""Retract changelog of an updating aggregate (batch form)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_us
from . import sequence as seq


def count_changelog(df: DataFrame, key, ts: str, tiebreak: str, out: str = "cnt", rows: int | None = None) -> DataFrame:
    """(is_add, key, count) rows of a running ``count(*) group by key`` in event order.

    Each input row moves its key's count from c-1 to c: a retraction
    (False, key, c-1) when c > 1, then the addition (True, key, c). The
    running count is the two-level scan, so a hot key is spread over its
    buckets. ``tiebreak`` identifies the input row that caused the change.
    """
    keys = seq.names(key)
    d = seq.cut(df.select(*keys, tiebreak, epoch_us(ts).alias("_us")), keys, "_us", tiebreak, rows)
    run = seq.row_number(d, keys, ["_us", tiebreak], "_c")
    changes = F.array(
        F.struct(F.lit(False).alias("is_add"), (F.col("_c") - 1).alias(out)),
        F.struct(F.lit(True).alias("is_add"), F.col("_c").alias(out)))
    found = run.select(*keys, tiebreak, F.inline(changes))
    return found.where(F.col("is_add") | (F.col(out) > 0))
