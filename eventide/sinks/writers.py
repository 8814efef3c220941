"""Sinks for batch and live results.

Live writers always name a ``checkpointLocation`` under the shared
checkpoint folder (``session.checkpoint_location``), so a restarted query
resumes from its offsets and state, and every ``foreachBatch`` writer is
idempotent per batch id (it overwrites the batch's own output), so a batch
replayed after an executor or driver loss does not duplicate rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_location


def _stream_writer(df: DataFrame, name: str, output_mode: str, trigger: dict | None):
    w = (df.writeStream.queryName(name).outputMode(output_mode)
           .option("checkpointLocation", checkpoint_location(df.sparkSession, name)))
    if trigger:
        w = w.trigger(**trigger)
    return w


# K1 / K2 -------------------------------------------------------------------

def to_console(df: DataFrame, n: int | None = None, name: str = "console", output_mode: str = "append",
               trigger: dict | None = None):
    """Print all rows, or the first ``n`` of a batch (of each micro-batch on a stream, which returns the query).

    Rows come to the driver partition by partition and are not held there.
    """
    def show(batch: DataFrame, _id: int) -> None:
        for row in (batch if n is None else batch.limit(n)).toLocalIterator():
            print("\t".join("null" if v is None else str(v) for v in row))
    return for_each_batch(df, show, name, output_mode, trigger)


def print_sample(df: DataFrame, n: int = 100, name: str = "sample", trigger: dict | None = None):
    """First ``n`` rows of every micro-batch."""
    return for_each_batch(df, lambda b, _id: b.show(n, truncate=False), name, trigger=trigger)


# K3 / K8 -------------------------------------------------------------------

def to_files(df: DataFrame, path: str, fmt: str = "csv", name: str | None = None, output_mode: str = "append",
             trigger: dict | None = None, partition_by: list[str] | None = None, mode: str = "append", **options):
    """File sink (csv, json, parquet, text). Batch: ``write``; stream: file sink with a checkpoint."""
    if not df.isStreaming:
        w = df.write.mode(mode).format(fmt).options(**options)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(path)
        return None
    # A stable default name: the checkpoint folder must be the same on restart.
    import hashlib
    default = "files_" + hashlib.sha1(path.encode()).hexdigest()[:12]
    w = _stream_writer(df, name or default, output_mode, trigger).format(fmt) \
        .options(**options).option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start()


def to_csv(df: DataFrame, path: str, **kw):
    return to_files(df, path, "csv", **kw)


def insert_into(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """``INSERT INTO`` an existing table by position (the table API's insertInto)."""
    df.write.insertInto(table, overwrite=overwrite)


def to_text_batches(df: DataFrame, path: str, name: str = "text_batches", trigger: dict | None = None):
    """Each micro-batch saved as text under ``path/batch=<id>`` (one string column)."""
    def write(batch: DataFrame, batch_id: int):
        col = batch.columns[0] if len(batch.columns) == 1 else None
        text = batch.select(F.col(col).cast("string")) if col else batch.select(F.to_json(F.struct("*")))
        text.write.mode("overwrite").text(f"{path}/batch={batch_id}")
    return for_each_batch(df, write, name, trigger=trigger)


# K9 / K13 / K14 ------------------------------------------------------------

def for_each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], name: str,
                   output_mode: str = "append", trigger: dict | None = None):
    """Run ``fn(batch_df, batch_id)`` per micro-batch (or once, id 0, for a batch frame)."""
    if not df.isStreaming:
        fn(df, 0)
        return None
    return _stream_writer(df, name, output_mode, trigger).foreachBatch(fn).start()


def side_outputs(df: DataFrame, tag_col: str, paths: dict[str, str], fmt: str = "parquet",
                 name: str = "side_outputs", trigger: dict | None = None):
    """Write each tag of ``tag_col`` to its own folder (main + side outputs of one job).

    Per batch id the output of every tag is overwritten, so replays are idempotent.
    """
    def write(batch: DataFrame, batch_id: int):
        batch.persist()
        try:
            for tag, path in paths.items():
                (batch.where(F.col(tag_col) == tag).write.mode("overwrite").format(fmt)
                      .save(f"{path}/batch={batch_id}"))
        finally:
            batch.unpersist()
    return for_each_batch(df, write, name, trigger=trigger)


def checkpointed(df: DataFrame, name: str, fn: Callable[[DataFrame, int], None],
                 interval: str = "5 seconds"):
    """Processing-time micro-batches every ``interval`` with a durable checkpoint."""
    return for_each_batch(df, fn, name, trigger={"processingTime": interval})


# K5 / K6: see ``upserts`` and ``documents`` ----------------------------------

# K7 ------------------------------------------------------------------------

def to_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None, mode: str = "append",
            name: str = "jdbc", trigger: dict | None = None):
    """Append into a JDBC table; credentials come only from ``properties``.

    On a stream this is at-least-once: a micro-batch replayed after a failure
    appends again, so give the target table a key and de-duplicate (or
    upsert) there when exactly-once matters.
    """
    props = dict(properties or {})

    def write(batch: DataFrame, _id: int):
        batch.write.jdbc(url, table, mode=mode, properties=props)
    return for_each_batch(df, write, name, trigger=trigger)


# K10 / K11 / K12 ------------------------------------------------------------

def append_stream(df: DataFrame, name: str, sink: str = "memory", trigger: dict | None = None):
    """Insert-only result as an append stream."""
    return _stream_writer(df, name, "append", trigger).format(sink).start()


def update_stream(df: DataFrame, name: str, sink: str = "memory", trigger: dict | None = None):
    """Updating result: each changed row emitted again (the additions of a retract stream)."""
    return _stream_writer(df, name, "update", trigger).format(sink).start()
