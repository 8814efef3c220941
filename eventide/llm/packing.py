"""Token-ID output: documents packed into fixed-length rows of token ids.

Each task encodes its documents, adds the end id, cuts what is longer than a
row into full rows and a rest, and packs the pieces by best fit decreasing: the
longest piece first, each into the open row with the least room that is enough.
That room is found by a descent in a segment tree over capacities, which holds
how many open rows have each capacity. Pieces are packed per buffer of
``BUFFER`` tokens of one input partition, so nothing is shuffled, memory is
bounded, and a lost task gives the same rows again. Only the last rows of a
buffer can stay part empty.

Every row of the result is one row of the id matrix: ``ids`` (uint16, little
endian, padded with the end id to the row length), ``positions`` (uint16,
starting at 0 at each segment and at the padding), ``cu_seqlens`` (cumulative
segment lengths, from 0), ``doc_ids`` and ``starts`` (where a segment lies in
its document's ids). Null and empty texts are a segment of the end id alone;
repeated rows are packed as often as they occur; further columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from eventide.llm.common import slices, table
from eventide.llm.token_counts import tokenizer_path

ROW = 4096
#: Tokens that one packing round holds.
BUFFER = 4_000_000
TOKENIZER = "byte_bpe_multi_50k.tiktoken"
END_ID = 50256
SCHEMA = "n_tokens int, n_segments int, doc_ids array<bigint>, starts array<int>, cu_seqlens array<int>, ids binary, positions binary"


class CapacityTree:
    """How many open rows have each capacity; finds the least capacity that is enough."""

    def __init__(self, most: int) -> None:
        self.leaves = 1 << max(1, most).bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += n
            i >>= 1

    def least(self, need: int) -> int | None:
        """The least capacity >= ``need`` of an open row."""
        count, i = self.count, need + self.leaves
        if count[i]:
            return need
        while i > 1:  # up until a right sibling has rows, then down to its first
            if not i & 1 and count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def best_fit_decreasing(sizes: Sequence[int], row: int) -> list[list[int]]:
    """Indices of the pieces in each row; every size is at most ``row``. Ties: the earlier piece, the later opened row."""
    tree, open_rows, rows = CapacityTree(row), {}, []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        room = tree.least(sizes[k])
        if room is None:
            at, room = len(rows), row
            rows.append([])
        else:
            at = open_rows[room].pop()
            tree.add(room, -1)
        rows[at].append(k)
        left = room - sizes[k]
        if left:
            open_rows.setdefault(left, []).append(at)
            tree.add(left, 1)
    return rows


_ENCODINGS: dict = {}


def encoding(path: str):
    """The tokenizer of a rank file, once per worker process."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def pack(docs: Sequence[tuple[int | None, np.ndarray]], row: int, end_id: int) -> Iterator[tuple]:
    """Rows of the result for (doc_id, ids) pairs."""
    pieces = [(d, s, ids[s : s + row]) for d, ids in docs for s in range(0, len(ids), row)]
    for members in best_fit_decreasing([len(p[2]) for p in pieces], row):
        own = [pieces[k] for k in members]
        cu = np.cumsum([0, *(len(p[2]) for p in own)], dtype=np.int32)
        matrix, positions = np.full(row, end_id, "<u2"), np.arange(row, dtype="<u2")
        matrix[: cu[-1]] = np.concatenate([p[2] for p in own])
        positions -= np.repeat(cu, np.diff([*cu, row])).astype("<u2")
        yield int(cu[-1]), len(own), [p[0] for p in own], [p[1] for p in own], cu.tolist(), matrix.tobytes(), positions.tobytes()


def pack_tokens(docs: DataFrame, row: int = ROW, tokenizer: str | None = None, end_id: int = END_ID, text: str = "text") -> DataFrame:
    """Packed rows of all texts of ``docs`` (columns doc_id and ``text``); see the module."""
    path = tokenizer or tokenizer_path(TOKENIZER)
    schema = pa.schema([
        ("n_tokens", pa.int32()), ("n_segments", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32())),
        ("cu_seqlens", pa.list_(pa.int32())), ("ids", pa.binary()), ("positions", pa.binary()),
    ])

    def rows(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        packed = list(pack(found, row, end_id))
        for i in range(0, len(packed), 500):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*packed[i : i + 500]), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, held, n = encoding(path), [], 0
        for batch in batches:
            for b in slices(batch, text):
                for d, t in zip(b.column("doc_id").to_pylist(), b.column(text).to_pylist()):
                    ids = np.array([*enc.encode_ordinary(t or ""), end_id], "<u2")
                    held.append((d, ids))
                    n += len(ids)
                    if n >= BUFFER:
                        yield from rows(held)
                        held, n = [], 0
        if held:
            yield from rows(held)

    return docs.select("doc_id", text).mapInArrow(run, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the matrix as Parquet files of fixed-size binary rows, one or more per task."""
    packed.write.mode("errorifexists").parquet(path)


def op4_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tokens(table(spark, sf_dir, "documents"))
