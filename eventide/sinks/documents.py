"""Document index (K6): a data source that writes rows as JSON documents in bulk requests.

Each task streams its rows into requests of at most ``chunk`` documents, so no
partition is ever held whole. Requests go to a staging folder under a name that
no other attempt shares, and a task reports the names it wrote. When all tasks
are done the requests of the reported attempts, and only those, move to their
final names ``batch-<id>-part-<p>-<k>.jsonl``; a retried or speculative task's
other requests are dropped, and so is everything if the write is aborted. A
replayed batch replaces its own files. Documents carry the caller's id, or
``<batch>-<partition>-<row>``, which a replay gives again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from .writers import for_each_batch

CHUNK = 1_000


@dataclass
class Requests(WriterCommitMessage):
    partition: int
    names: list[str]


def _files(path: str):
    """(file system, path in it) of a local path or a URI, as the driver and the executors see it."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class IndexWriter(DataSourceWriter):
    def __init__(self, options) -> None:
        self.path, self.batch = options["path"].rstrip("/"), options.get("batch", "0")
        self.chunk = int(options.get("chunk", CHUNK))
        self.staged = f"{self.path}/_staged-{self.batch}"

    def write(self, iterator: Iterator[Row]) -> Requests:
        from pyspark import TaskContext
        task = TaskContext.get()
        partition = task.partitionId() if task else 0
        files, staged = _files(self.staged)
        files.create_dir(staged, recursive=True)
        attempt, names, held, n = uuid.uuid4().hex, [], [], 0

        def send() -> None:
            names.append(f"{attempt}-{len(names)}")
            with files.open_output_stream(f"{staged}/{names[-1]}") as out:
                out.write("".join(held).encode())
            held.clear()

        for row in iterator:
            doc_id = row["id"] if row["id"] is not None else f"{self.batch}-{partition}-{n}"
            held.append(json.dumps({"_id": doc_id, "doc": json.loads(row["doc"])}) + "\n")
            n += 1
            if len(held) == self.chunk:
                send()
        if held:
            send()
        return Requests(partition, names)

    def commit(self, messages: list[Requests | None]) -> None:
        from pyarrow.fs import FileSelector, FileType
        files, path = _files(self.path)
        _, staged = _files(self.staged)
        files.create_dir(path, recursive=True)
        for info in files.get_file_info(FileSelector(path)):  # of an earlier run of this batch
            if info.type == FileType.File and info.base_name.startswith(f"batch-{self.batch}-"):
                files.delete_file(info.path)
        for message in messages:
            for k, name in enumerate(message.names if message else []):
                files.move(f"{staged}/{name}", f"{path}/batch-{self.batch}-part-{message.partition:05d}-{k:05d}.jsonl")
        self.abort(messages)

    def abort(self, messages: list[Requests | None]) -> None:
        from pyarrow.fs import FileType
        files, staged = _files(self.staged)
        if files.get_file_info(staged).type == FileType.Directory:
            files.delete_dir(staged)


class DocumentIndex(DataSource):
    """Write-only source ``document_index``: options path, batch, chunk; columns id and doc (JSON text)."""

    @classmethod
    def name(cls) -> str:
        return "document_index"

    def schema(self) -> str:
        return "id string, doc string"

    def writer(self, schema: StructType, overwrite: bool) -> IndexWriter:
        return IndexWriter(self.options)


def index_documents(df: DataFrame, path: str, id_col: str | None = None, chunk: int = CHUNK,
                    name: str = "index_documents", trigger: dict | None = None):
    """Bulk-index rows as JSON documents into the folder or URI ``path``, which driver and executors share.

    Ids may be of any type (rendered as text); without ``id_col`` they are
    given by batch, partition and row. An empty batch writes nothing.
    """
    df.sparkSession.dataSource.register(DocumentIndex)

    def send(batch: DataFrame, batch_id: int) -> None:
        ids = F.col(id_col).cast("string") if id_col else F.lit(None).cast("string")
        docs = batch.select(ids.alias("id"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("doc"))
        docs.write.format("document_index").mode("append").option("path", path).option("batch", str(batch_id)).option("chunk", str(chunk)).save()
    return for_each_batch(df, send, name, trigger=trigger)
