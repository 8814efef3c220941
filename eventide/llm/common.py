"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Texts are worked on in slices of about this many bytes, which bounds the memory of a task.
SLICE_BYTES = 1_500_000
#: The same for operators that make many arrays of 8 bytes for each byte of text.
SMALL_SLICE = 500_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local master without one gets a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="eventide-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_listed: list[list[str]] = []


@contextmanager
def listed_tables() -> Iterator[list[str]]:
    """The paths of the tables that are materialized inside, for ``drop_tables`` once what was made of them is written."""
    _listed.append([])
    try:
        yield _listed[-1]
    finally:
        _listed.pop()


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _listed:
        paths.append(path)
    df.write.parquet(path)
    if _listed:
        _release(spark)
    return spark.read.schema(df.schema).parquet(path)


def _release(spark: SparkSession) -> None:
    """Let go of what led to a table that is written: Spark removes shuffle files once the driver has collected their owners as garbage."""
    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch at rows so that each part has about ``limit`` bytes of ``column`` (one row at least)."""
    arr = batch.column(column).cast(pa.large_string())
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    i = 0
    while i < batch.num_rows:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), batch.num_rows)
        yield batch.slice(i, j - i)
        i = j


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values one after another, and where each value starts (one more entry than values). Null: empty."""
    arr = column.cast(pa.large_string()).fill_null("")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    arr = pa.concat_arrays([arr])
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class RollingHash:
    """64-bit polynomial hashes of any substrings of one byte buffer, by prefix sums."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, buf: np.ndarray, seed: int = 1) -> None:
        n = len(buf)
        rnd = np.random.Generator(np.random.PCG64(seed))
        letters = rnd.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._inv = self._powers(pow(self.BASE, -1, 2**64), n + 1)
        self._sums = np.empty(n + 1, np.uint64)
        self._sums[0] = 0
        scaled = letters[buf]
        scaled *= self._powers(self.BASE, n + 1)[:n]
        np.cumsum(scaled, out=self._sums[1:])

    _kept: dict[int, np.ndarray] = {}

    @classmethod
    def _powers(cls, base: int, n: int) -> np.ndarray:
        """The first ``n`` powers; those of a usual slice are kept for the next one."""
        kept = cls._kept.get(base)
        if kept is None or len(kept) < n:
            kept = np.full(max(n, SMALL_SLICE * 5 // 4), np.uint64(base), np.uint64)
            kept[0] = 1
            np.cumprod(kept, out=kept)
            if len(kept) <= 2 * SLICE_BYTES:
                cls._kept[base] = kept
        return kept[:n]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of ``buf[start:end]`` for arrays of bounds."""
        return mix((self._sums[end] - self._sums[start]) * self._inv[start] + (end - start).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run without ASCII white space, and the index of its value. Runs end at value bounds."""
    inside = ~_SPACE[buf]
    first = np.zeros(len(buf) + 1, bool)
    first[offsets] = True
    prev = np.concatenate([[False], inside[:-1]]) if len(buf) else inside
    starts = np.flatnonzero(inside & (~prev | first[:-1]))
    nxt = np.concatenate([inside[1:], [False]]) if len(buf) else inside
    ends = np.flatnonzero(inside & (~nxt | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z as a-z; all other bytes stay."""
    return _LOWER[buf]
