"""Token counts by prefix dynamic programming.

A BPE encoding is fixed by its last token: a prefix of a text ends with the
piece ``t`` exactly if the prefix before ``t`` ends with some piece ``s`` and
the string ``s + t`` on its own encodes to these two pieces. So one pass from
left to right finds, for every prefix, its last piece and its count

    count(i) = count(i - len(t)) + cost(t)

without encoding any prefix again. ``cost`` is 1, or the number of UTF-8 bytes
of a character that the vocabulary lacks (byte fallback). No piece has the
space mark after another character, so a text falls apart into chunks (space
marks, then other characters); counts of chunks add up, and equal chunks are
counted once. The stored prefix counts answer how many tokens a cut text has
and how long a text may be for a budget.

Null texts count as empty; empty texts have no tokens. Repeated rows and
further columns are kept as they are; an input column with the name of a new
one is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from eventide.llm.common import slices, table

MARK = "▁"
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Entries of a worker's caches; a full cache is emptied.
CACHE = 600_000
TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PrefixCounter:
    """Exact token counts of all prefixes, for the pieces of one BPE model with byte fallback."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(sp.get_piece_size())
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
        self.longest = max(map(len, self.score))
        self._pairs: dict[tuple[str, str], bool] = {}
        self._chunks: dict[str, int] = {}

    def _merge(self, text: str) -> list[str]:
        """The pieces of a short string: always join the best neighbours, the first ones at a tie."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, a: str, b: str) -> bool:
        found = self._pairs.get((a, b))
        if found is None:
            if len(self._pairs) >= CACHE:
                self._pairs.clear()
            found = self._pairs[a, b] = self._merge(a + b) == [a, b]
        return found

    def prefixes(self, chunk: str) -> list[int]:
        """Token counts of ``chunk[:i]`` for i = 0 .. len(chunk)."""
        score, longest = self.score, self.longest
        counts, last = [0], [""]
        for i in range(1, len(chunk) + 1):
            for j in range(max(0, i - longest), i):
                piece = chunk[j:i]
                if piece in score or j == i - 1:
                    if j == 0 or self._fits(last[j], piece):
                        counts.append(counts[j] + (1 if piece in score else len(piece.encode())))
                        last.append(piece)
                        break
        return counts

    def count(self, chunk: str) -> int:
        found = self._chunks.get(chunk)
        if found is None:
            if len(self._chunks) >= CACHE:
                self._chunks.clear()
            found = self._chunks[chunk] = self.prefixes(chunk)[-1]
        return found

    def chunks(self, text: str) -> list[str]:
        return _CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []

    def text_prefixes(self, text: str) -> list[int]:
        """Token counts of ``text[:i]`` for i = 0 .. len(text)."""
        out, before = [], 0
        for chunk in self.chunks(text):
            own = self.prefixes(chunk)
            out += [before + n for n in own[1:]]
            before += own[-1]
        return [0, *out[1:]] if out else [0]

    def fitting(self, text: str, budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens."""
        best = at = before = 0
        for chunk in self.chunks(text):
            own = self.prefixes(chunk)
            first = at == 0
            for i, n in enumerate(own):
                if before + n <= budget and not (first and i == 0):
                    best = at + i - 1  # the mark before the text is no character of it
            before += own[-1]
            at += len(chunk)
            if before > budget + 64:  # a later chunk only adds tokens
                break
        return max(0, best)


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(model_file: str) -> PrefixCounter:
    """One counter per worker process and model."""
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = PrefixCounter(model_file)
    return _COUNTERS[model_file]


def count_batch(texts: pa.Array, c: PrefixCounter) -> np.ndarray:
    """Token counts of an array of texts."""
    texts = texts.cast(pa.large_string()).fill_null("")
    odd = pc.match_substring_regex(texts, f"^ |  | $|{MARK}")
    lists = pc.split_pattern(pc.if_else(odd, "", texts), " ")
    flat = lists.flatten().dictionary_encode()
    own = np.fromiter((c.count(MARK + w) for w in flat.dictionary.to_pylist()), np.int64, len(flat.dictionary))
    sums = np.concatenate([[0], np.cumsum(own[flat.indices.to_numpy(zero_copy_only=False)])])
    offsets = lists.offsets.to_numpy()
    out = sums[offsets[1:] - offsets[0]] - sums[offsets[:-1] - offsets[0]]
    out[pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)] = 0
    for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
        out[i] = sum(map(c.count, c.chunks(texts[i].as_py())))
    return out


def token_counts(docs: DataFrame, text: str = "text", limit: int = 4096, model_file: str | None = None) -> DataFrame:
    """Columns of ``docs`` plus n_bytes, n_tokens and over_limit (more than ``limit`` tokens)."""
    model_file = model_file or tokenizer_path(TOKENIZER)
    new = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())]
    docs = docs.select(*[c for c in docs.columns if c not in {f.name for f in new}])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(model_file)
        for batch in batches:
            for b in slices(batch, text, 16_000_000):
                n = count_batch(b.column(text), c)
                size = pc.binary_length(b.column(text).cast(pa.large_string()).fill_null("")).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([*b.columns, size, pa.array(n), pa.array(n > limit)], names=[*b.schema.names, *(f.name for f in new)])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *new]))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_bytes", "n_tokens", "over_limit")
