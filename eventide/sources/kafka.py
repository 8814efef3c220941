"""Kafka source and sink.

The Kafka connector jar is not part of a plain PySpark install; these
functions build the reader/writer with the options the jobs use and fail
at ``load``/``start`` when the connector is missing. Offsets live in the
live checkpoint (exactly-once with idempotent sinks), not in Kafka
consumer-group commits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_options(servers: str, topic: str, offsets: str = "latest", group_id: str | None = None,
                  extra: dict | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": offsets,
            "failOnDataLoss": "true"}
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update(extra or {})
    return opts


def kafka_source(spark: SparkSession, servers: str, topic: str, offsets: str = "latest",
                 group_id: str | None = None, live: bool = True, extra: dict | None = None) -> DataFrame:
    """String key/value records of a topic (plus topic, partition, offset, timestamp)."""
    r = spark.readStream if live else spark.read
    df = r.format("kafka").options(**kafka_options(servers, topic, offsets, group_id, extra)).load()
    return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                     "topic", "partition", "offset", "timestamp")


def kafka_table_source(spark: SparkSession, name: str, servers: str, topic: str, schema: T.StructType | str,
                       offsets: str = "latest", live: bool = True) -> DataFrame:
    """Topic of CSV rows parsed with a declared schema and registered as ``name``."""
    raw = kafka_source(spark, servers, topic, offsets, live=live)
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    df = raw.select(F.from_csv("value", ddl).alias("r")).select("r.*")  # undoes the quoting of to_kafka_frame
    df.createOrReplaceTempView(name)
    return df


def to_kafka_frame(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Rows encoded as CSV text in ``value`` (and an optional key) for the Kafka sink."""
    value = F.to_csv(F.struct(*[F.col(c) for c in df.columns]))
    cols = [value.alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


def to_kafka(df: DataFrame, servers: str, topic: str, key_col: str | None = None,
             checkpoint: str | None = None):
    """Write CSV-encoded rows to a topic (batch or stream); Kafka delivery is at-least-once."""
    out = to_kafka_frame(df, key_col)
    if not df.isStreaming:
        out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
        return None
    from ..session import checkpoint_location
    return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
               .option("checkpointLocation", checkpoint or checkpoint_location(df.sparkSession, f"kafka_{topic}"))
               .start())
