"""Named tables: parquet driver tables, declared-schema file tables, event-time views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import pin_utc


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables under ``sf_dir`` (columns pruned by the scan)."""
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table with the item key of its JSON props (``k``) as a column."""
    df = driver_table(spark, sf_dir, "events")
    return df.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


def table_source(spark: SparkSession, name: str, path: str, schema: T.StructType | str,
                 fmt: str = "csv", sep: str = ",", live: bool = False) -> DataFrame:
    """Declared-schema file table registered as a temp view ``name``."""
    r = spark.readStream if live else spark.read
    r = r.format(fmt).schema(schema)
    if fmt == "csv":
        r = r.option("sep", sep).option("header", "false")
    df = r.load(path)
    df.createOrReplaceTempView(name)
    return df


def with_event_time(df: DataFrame, col: str, unit: str = "s", out: str = "rowtime",
                    watermark_delay: str | None = None) -> DataFrame:
    """Add a rowtime attribute from an epoch column; optionally a bounded watermark.

    The watermark only affects live plans (it is a no-op in batch).
    """
    from ..functions.time import to_event_time
    res = df.withColumn(out, to_event_time(col, unit))
    if watermark_delay is not None and df.isStreaming:
        res = res.withWatermark(out, watermark_delay)
    return res


def with_proctime(df: DataFrame, out: str = "proctime") -> DataFrame:
    """Processing-time attribute (wall clock at evaluation)."""
    return df.withColumn(out, F.current_timestamp())


def create_csv_table(spark: SparkSession, name: str, path: str, columns: list[tuple[str, str]],
                     computed: dict[str, str] | None = None, watermark: tuple[str, str] | None = None,
                     live: bool = False) -> DataFrame:
    """``CREATE TABLE ... WITH (filesystem, csv)`` equivalent.

    ``columns`` are (name, SQL type); ``computed`` maps new column names to SQL
    expressions (e.g. ``{"rt": "timestamp_seconds(ts)"}``); ``watermark`` is
    (column, delay) as in ``WATERMARK FOR rt AS rt - INTERVAL '5' SECOND``.
    """
    ddl = ", ".join(f"{n} {t}" for n, t in columns)
    df = table_source(spark, f"{name}_raw", path, ddl, "csv", live=live)
    for n, e in (computed or {}).items():
        df = df.withColumn(n, F.expr(e))
    if watermark and live:
        df = df.withWatermark(*watermark)
    df.createOrReplaceTempView(name)
    return df
