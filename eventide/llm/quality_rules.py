"""Quality rules: distances of a text's histograms to references of its language.

Two histograms of every text, over character classes and over common function
words of the known languages (and other words), are compared with the reference
of its language by the Jensen-Shannon distance. A reference is the sum of all
texts' histograms of that language that pass the base rules, each scaled to the
same weight; Spark sums them with partial sums per task. A text is rejected if
it fails the base rules, or if it has enough characters or words for a distance
to mean something and that distance is above its threshold.

Null and empty texts have no words and fail the base rules. A null language is
a language of its own. Repeated rows are judged one by one, and count each time
for the references. Further columns are kept; one with the name of a new column
is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from eventide.llm.common import SMALL_SLICE, RollingHash, mix, slices, table, utf8, words

#: Frequent function words of four languages.
COMMON_WORDS = (
    "the of and to in is that it was for on are as with be at by this from or an have not but they which"
    " der die das und ist nicht ein eine zu den von mit sich auf für dem des im als auch"
    " le la les de des et un une du en est que qui dans pour par sur au avec"
    " el los las y del se por con para una su lo como más"
).split()
#: The characters that the base rules call symbols.
SYMBOLS = b"[#*$%&|<>]"[1:-1]
#: Bins of the second histogram: each common word, other words, runs without a letter.
N_BINS = len(COMMON_WORDS) + 2
#: Character classes: lower and upper case letters of ASCII, digits, white space, sentence marks, symbols, other ASCII, other characters.
N_CLASSES = 8
MIN_WORDS, MAX_REPEATED, WINDOW = 10, 0.2, 5
#: Thresholds of the two distances (0 to 1), and how many characters or words a text must have to be held to them.
MAX_CLASS_DISTANCE, MIN_CHARS = 0.30, 200
MAX_WORD_DISTANCE, MIN_COMMON = 0.50, 50

_CLASS = np.full(256, 6, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:], _CLASS[[32, *range(9, 14)]] = 0, 1, 2, 7, 3
_CLASS[128:192] = N_CLASSES  # bytes of UTF-8 that start no character
_CLASS[list(b".,;:!?'\"-()")] = 4
_CLASS[list(SYMBOLS)] = 5
_LETTER = np.isin(_CLASS, (0, 1, 7))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each text's bytes of ``values``."""
    out = np.zeros(len(offsets) - 1, np.int64)
    filled = offsets[1:] > offsets[:-1]
    if filled.any():
        out[filled] = np.add.reduceat(values, offsets[:-1][filled], dtype=np.int64)
    return out


def _word_codes() -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the common words (small, with a capital, in capitals) and the bin of each."""
    codes: dict[int, int] = {}
    for form in (str, str.capitalize, str.upper):
        buf, off = utf8(pa.array([form(w) for w in COMMON_WORDS]))
        for h, k in zip(RollingHash(buf).of(off[:-1], off[1:]).tolist(), range(len(COMMON_WORDS))):
            codes.setdefault(h, k)
    known = np.array(sorted(codes), np.uint64)
    return known, np.array([codes[k] for k in known.tolist()])


def features(texts: pa.Array) -> dict[str, np.ndarray]:
    """Base counters and both histograms of an array of texts."""
    buf, off = utf8(texts)
    n = len(off) - 1
    exact = RollingHash(buf)
    starts, ends, of = words(buf, off)
    cls = _CLASS[buf]
    upto = np.zeros(len(buf) + 1, np.int32)
    np.cumsum(cls != N_CLASSES, out=upto[1:])
    n_words = np.bincount(of, minlength=n)
    word_chars = np.bincount(of, weights=upto[ends] - upto[starts], minlength=n).astype(np.int64)

    # words in repeated windows
    h = exact.of(starts, ends)
    repeats = np.zeros(n, np.int64)
    if len(h) >= WINDOW:
        last = len(h) - WINDOW + 1
        same = of[:last] == of[WINDOW - 1 :]
        w = of[:last].astype(np.uint64)
        for k in range(WINDOW):
            w = mix(w * np.uint64(0x9E3779B97F4A7C15) + h[k : k + last])
        at = np.flatnonzero(same)
        _, inverse, count = np.unique(w[at], return_inverse=True, return_counts=True)
        twice = at[count[inverse] > 1]
        hit = np.zeros(len(h), bool)
        for k in range(WINDOW):
            hit[twice + k] = True
        repeats = np.bincount(of[hit], minlength=n)

    # lines with a word that equal an earlier line
    cut = np.unique(np.concatenate([off, np.flatnonzero(buf == 10) + 1]))
    line_start = cut[:-1] if len(cut) > 1 else np.zeros(0, np.int64)
    line_end = cut[1:].copy() if len(cut) > 1 else np.zeros(0, np.int64)
    if len(line_end):
        line_end -= buf[line_end - 1] == 10
    line_of = np.searchsorted(off, line_start, side="right") - 1
    filled = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    keys = mix(exact.of(line_start, line_end) + mix(line_of.astype(np.uint64) + np.uint64(1)))[filled]
    _, seen = np.unique(keys, return_index=True)
    again = np.ones(len(keys), bool)
    again[seen] = False
    dup_lines = np.bincount(line_of[filled][again], minlength=n)

    classes = np.stack([_sums(cls == k, off) for k in range(N_CLASSES)], axis=1)
    known, place = _word_codes()
    # common words are compared without the mark that follows them
    bare = ends - ((cls[np.maximum(ends - 1, 0)] == 4) & (ends - starts > 1)) if len(ends) else ends
    hl = exact.of(starts, bare)
    at = np.minimum(np.searchsorted(known, hl), len(known) - 1)
    code = np.where(known[at] == hl, place[at], len(COMMON_WORDS))
    letters = np.zeros(len(buf) + 1, np.int32)
    np.cumsum(_LETTER[buf], out=letters[1:])
    code[letters[ends] == letters[starts]] = len(COMMON_WORDS) + 1
    hist = np.bincount(of * N_BINS + code, minlength=n * N_BINS).reshape(n, N_BINS)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": classes[:, 5], "n_dup_lines": dup_lines, "n_repeat_words": repeats,
        "chars": upto[off[1:]] - upto[off[:-1]], "classes": classes, "common": hist,
    }


def base_failed(f: dict[str, np.ndarray]) -> np.ndarray:
    return (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > round(100 * MAX_REPEATED) * f["n_words"])


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row of counts ``p`` to the counts ``q``; 0 where either is empty."""
    sp, sq = p.sum(axis=1, keepdims=True), q.sum(axis=-1, keepdims=True)
    a, b = p / np.maximum(sp, 1), np.broadcast_to(q / np.where(sq > 0, sq, 1), p.shape)
    m = (a + b) / 2

    def to_mid(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0).sum(axis=1)

    out = np.sqrt(np.clip((to_mid(a) + to_mid(b)) / 2, 0, 1))
    return np.where((sp[:, 0] > 0) & (np.broadcast_to(sq, sp.shape)[:, 0] > 0), out, 0.0)


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per language: summed histograms (fixed point, so that the sum does not depend on the order)."""
    width = N_CLASSES + N_BINS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str | None, np.ndarray] = {}
        for batch in batches:
            for b in slices(batch, text, SMALL_SLICE):
                f = features(b.column(text))
                ok = ~base_failed(f)
                scaled = np.concatenate(
                    [np.rint(1e6 * f[k] / np.maximum(f[k].sum(axis=1, keepdims=True), 1)).astype(np.int64) for k in ("classes", "common")], axis=1)
                langs = b.column(lang).to_pylist()
                for name in set(langs):
                    mine = np.array([x == name for x in langs]) & ok
                    sums[name] = sums.get(name, np.zeros(width, np.int64)) + scaled[mine].sum(axis=0)
        for name, v in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([name] * width, pa.string()), "bin": pa.array(range(width), pa.int32()), "n": pa.array(v)})

    bins = docs.select(text, F.col(lang).cast("string").alias(lang)).mapInArrow(run, "lang string, bin int, n bigint")
    return bins.groupBy("lang", "bin").agg(F.sum("n").alias("n"))


#: Languages whose references a task can be sent; more is an error of the lang column.
MAX_LANGUAGES = 2_000


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Columns of ``docs`` plus base counters, class_distance, word_distance, base_failed and kept."""
    width = N_CLASSES + N_BINS
    rows = references(docs, text, lang).orderBy("lang", "bin").limit(MAX_LANGUAGES * width + 1).collect()
    if len(rows) > MAX_LANGUAGES * width:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in column {lang}")
    refs: dict[str | None, np.ndarray] = {}
    for r in rows:
        refs.setdefault(r["lang"], np.zeros(width))[r["bin"]] = r["n"]
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    new = [StructField(c, LongType()) for c in counts] + [
        StructField("class_distance", DoubleType()), StructField("word_distance", DoubleType()),
        StructField("base_failed", BooleanType()), StructField("kept", BooleanType())]
    docs = docs.select(*[c for c in docs.columns if c not in {f.name for f in new}])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, text, SMALL_SLICE):
                f = features(b.column(text))
                failed = base_failed(f)
                langs = b.column(lang).cast(pa.string()).to_pylist()
                ref = np.stack([refs.get(x, np.zeros(width)) for x in langs]) if langs else np.zeros((0, width))
                by_class = np.round(divergence(f["classes"], ref[:, :N_CLASSES]), 6)
                by_word = np.round(divergence(f["common"], ref[:, N_CLASSES:]), 6)
                bad = ((f["chars"] >= MIN_CHARS) & (by_class > MAX_CLASS_DISTANCE)) | ((f["n_words"] >= MIN_COMMON) & (by_word > MAX_WORD_DISTANCE))
                cols = [pa.array(f[c].astype(np.int64)) for c in counts] + [pa.array(by_class), pa.array(by_word), pa.array(failed), pa.array(~failed & ~bad)]
                yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, *(x.name for x in new)])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *new]))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("text", "lang")
