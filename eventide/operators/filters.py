"""Row filters of the jobs (all pushed into the scan stage by Catalyst)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Static-asset suffixes dropped from page-view counts (fixed values).
STATIC_SUFFIX_PATTERN = r"\.(css|js)$"


def keep_behaviour(df: DataFrame, col: str, value: str) -> DataFrame:
    """Keep one behaviour (e.g. page views)."""
    return df.where(F.col(col) == value)


def drop_behaviour(df: DataFrame, col: str, value: str) -> DataFrame:
    return df.where(F.col(col) != value)


def is_static_asset(url) -> Column:
    u = F.col(url) if isinstance(url, str) else url
    return u.rlike(STATIC_SUFFIX_PATTERN)


def drop_static_assets(df: DataFrame, url: str) -> DataFrame:
    """Drop urls ending in .css / .js (case-sensitive); empty urls stay."""
    return df.where(~is_static_asset(url) | F.col(url).isNull())


def non_empty(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull() & (F.col(col) != ""))


def not_null(df: DataFrame, cols) -> DataFrame:
    return df.dropna(how="any", subset=[cols] if isinstance(cols, str) else list(cols))
