"""Lateral table functions: one input row to n output rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import split_like_jvm


def lateral_split(df: DataFrame, col: str, sep: str = "#", outer: bool = False,
                  word: str = "word", length: str = "length") -> DataFrame:
    """Join each row with the (token, token length) rows of ``col`` split on ``sep``.

    ``outer=True`` keeps rows without tokens with nulls (LEFT JOIN LATERAL ... ON TRUE).
    Runs as a Generate node inside the scan's stage: no shuffle.
    """
    parts = split_like_jvm(F.col(col), sep)
    gen = F.explode_outer(parts) if outer else F.explode(parts)
    out = df.select("*", gen.alias(word))
    return out.withColumn(length, F.length(word))
