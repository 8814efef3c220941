"""Spelling variant grouping by blocked Gram matrices.

Two words that differ by one inserted, deleted or replaced letter have letter
counts whose squared distance is 1 (lengths differ by one) or at most 2 (equal
lengths). Words are put into blocks by length and, within a length, by how many
of their letters fall into each of ``CLASSES`` letter classes: one edit moves at
most one letter between two classes or adds one to a class, so all near words
are in the same block or in a neighbouring one of the same or the next length.
Blocks are cut into tiles of a bounded number of words. Spark sends every tile
to the tiles it has to meet; there NumPy multiplies the two letter-count
matrices (the Gram block), which gives all squared distances at once, keeps the
pairs at most two apart and verifies the edit on the letters themselves.

Only near pairs leave a task, and Spark takes their number and the most frequent
one per word. Chains of forms are followed by doubling.

Null texts have no words; a null doc_id is the empty string in the key of the
test edit. Repeated rows count each time. Of equally frequent near words the
smallest in code-point order is the form. An empty table gives an empty result;
further columns are left out. Runs of any length are words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import materialize, table, utf8
from eventide.llm.conversation_repair import crc32_sql
from eventide.llm.url_filter import LOWER, UPPER

LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
MIN_LENGTH, MIN_COUNT, TIMES = 7, 2, 10
#: One in this many runs loses a letter (the contract's test bed).
EDITED = 31
CLASSES = 5
#: Words of a tile, and its letters: what bounds the matrices of a task.
TILE, TILE_LETTERS = 2_048, 1 << 20
#: Most blocks that are broadcast; more are joined by a shuffle.
BROADCAST_CELLS = 300_000


# ------------------------------------------------------------------ words

def _edited(doc: Column, run: Column) -> Column:
    h = F.crc32(F.concat(doc, F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % EDITED == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of words of MIN_LENGTH letters that occur MIN_COUNT times or more."""
    runs = F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}"), F.lit(0))  # shorter runs never get long enough
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    word = run.select("doc", F.translate("run", UPPER, LOWER).alias("run")).select(_edited(F.col("doc"), F.col("run")).alias("word"))
    return word.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


# ------------------------------------------------------------------ tiles and where they meet

def _cell(word: Column) -> Column:
    """How many letters of the word are in each class."""
    classes = ["".join(c for c in LETTERS if ord(c) % CLASSES == k) for k in range(CLASSES)]
    return F.array(*[F.length(word) - F.length(F.translate(word, c, "")) for c in classes])


def _moved(cell: str, more: int, less: int | None = None) -> Column:
    c = F.col(cell)
    return F.array(*[c[k] + (int(k == more) - int(k == less)) for k in range(CLASSES)])


def _sized(small: DataFrame) -> DataFrame:
    n = len(small.select(F.lit(1)).limit(BROADCAST_CELLS + 1).collect())
    return F.broadcast(small) if n <= BROADCAST_CELLS else small


def meetings(words: DataFrame) -> DataFrame:
    """(cid, tile, kind, word, n), those of one (cid, tile) together: kind 0 is the tile itself, 1 words as long to meet it, 2 words one letter shorter."""
    celled = words.withColumn("cell", _cell(F.col("word")))
    length = F.aggregate("cell", F.lit(0), lambda a, b: a + b)
    per_tile = F.greatest(F.lit(1), F.least(F.lit(TILE), F.floor(TILE_LETTERS / length)))
    cells = materialize(celled.groupBy("cell").agg(F.count("*").alias("size")).select("cell", F.ceil(F.col("size") / per_tile).cast("int").alias("tiles"),
                                                                                      F.monotonically_increasing_id().alias("cid")), "cells")
    known = _sized(cells)
    tiled = celled.join(known, "cell").withColumn("tile", F.pmod(F.xxhash64("word"), "tiles").cast("int"))
    tiles = tiled.groupBy("cell", "cid", "tiles", "tile").agg(F.collect_list(F.struct("word", "n")).alias("words"))  # about TILE words
    tiles = materialize(tiles, "tiles")
    own = tiles.select("cid", "tile", F.lit(0).alias("kind"), "words")
    later = tiles.where("tile + 1 < tiles").select("cid", F.explode(F.sequence(F.col("tile") + 1, F.col("tiles") - 1)).alias("tile"), F.lit(1).alias("kind"), "words")
    near = [F.struct(F.lit(1).alias("kind"), _moved("cell", a, b).alias("cell")) for a in range(CLASSES) for b in range(a + 1, CLASSES)]
    near += [F.struct(F.lit(2).alias("kind"), _moved("cell", a).alias("cell")) for a in range(CLASSES)]
    sent = tiles.select("words", F.explode(F.array(*near)).alias("to")).select("words", "to.kind", "to.cell").join(known, "cell")
    sent = sent.select("cid", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), "kind", "words")
    met = own.unionByName(later).unionByName(sent).repartition("cid", "tile").sortWithinPartitions("cid", "tile", "kind")
    return met.select("cid", "tile", "kind", F.explode("words").alias("w")).select("cid", "tile", "kind", "w.word", "w.n")


# ------------------------------------------------------------------ Gram blocks

class Tile:
    """Words of one length: their letters as a matrix, letter counts and squared norms."""

    def __init__(self, letters: np.ndarray, words: pa.Array, n: pa.Array) -> None:
        self.letters, self.words, self.n = letters, words, n
        rows, width = letters.shape
        flat = (np.arange(rows, dtype=np.int64) * len(LETTERS))[:, None] + letters
        exact = np.float32 if width <= 2_048 else np.float64
        self.counts = np.bincount(flat.ravel(), minlength=rows * len(LETTERS)).reshape(rows, -1).astype(exact)
        self.norms = np.einsum("ij,ij->i", self.counts, self.counts)

    @staticmethod
    def join(parts: list[Tile]) -> Tile:
        if len(parts) == 1:
            return parts[0]
        return Tile(np.concatenate([p.letters for p in parts]), pa.concat_arrays([p.words for p in parts]), pa.concat_arrays([p.n for p in parts]))


def close_pairs(a: Tile, b: Tile) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` whose letter counts are at most two apart (squared)."""
    used = a.counts.any(axis=0)
    gram = a.counts[:, used] @ b.counts[:, used].T
    gram *= 2
    gram -= a.norms[:, None]
    return np.nonzero(gram >= b.norms - 2)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words of ``a`` and ``b`` (as long, or one letter shorter) are one edit apart, row by row."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    m = b.shape[1]
    front, rear = a[:, :m] != b, a[:, 1:] != b
    first = np.where(front.any(axis=1), front.argmax(axis=1), m)
    last = np.where(rear.any(axis=1), m - 1 - rear[:, ::-1].argmax(axis=1), -1)
    return last < first


def near_pairs(a: Tile, b: Tile, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    i, j = close_pairs(a, b)
    if same:
        i, j = i[i < j], j[i < j]
    step = max(1, (1 << 23) // max(1, a.letters.shape[1]))
    ok = [one_edit(a.letters[i[s : s + step]], b.letters[j[s : s + step]]) for s in range(0, len(i), step)]
    ok = np.concatenate(ok) if ok else np.zeros(0, bool)
    return i[ok], j[ok]


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letter numbers of all words one after another, and where each word starts (one more entry)."""
    buf, offsets = utf8(words)
    lead = buf == 0xC3
    starts = offsets - np.concatenate([[0], np.cumsum(lead)])[offsets]
    rest = buf[~lead]
    return np.where(rest < 0x80, rest.astype(np.int16) - 97, rest.astype(np.int16) - 0x80 + 26).astype(np.uint8), starts


def near_words(met: DataFrame) -> DataFrame:
    """(word, near, near_n): every pair of near words, in both directions."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, wait = None, [], {1: [], 2: []}
        out: list[list] = [[], [], []]

        def found(a: Tile, b: Tile, same: bool = False) -> None:
            i, j = near_pairs(a, b, same)
            if len(i):
                i, j = pa.array(i), pa.array(j)
                for words, near, n in ((a.words.take(i), b.words.take(j), b.n.take(j)), (b.words.take(j), a.words.take(i), a.n.take(i))):
                    for part, x in zip(out, (words, near, n)):
                        part.append(x)

        def meet(kind: int) -> None:
            if own and wait[kind]:
                own[:] = [Tile.join(own)]
                found(own[0], Tile.join(wait[kind]))
            wait[kind] = []

        def end() -> None:
            if own:
                own[:] = [Tile.join(own)]
                found(own[0], own[0], True)
            meet(1)
            meet(2)
            own.clear()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.concat_arrays(p) for p in out], ["word", "near", "near_n"])
            for p in out:
                p.clear()
            return batch

        for batch in batches:
            cid, tile, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cid", "tile", "kind"))
            words, n = batch.column("word").cast(pa.string()), batch.column("n")
            letters, starts = _letters(words)
            new = np.flatnonzero((np.diff(cid) != 0) | (np.diff(tile) != 0) | (np.diff(kind) != 0)) + 1
            bounds = [0, *new.tolist(), batch.num_rows]
            for s, e in zip(bounds, bounds[1:]):
                if s == e:
                    continue
                if now != (key := (int(cid[s]), int(tile[s]))):
                    if now is not None:
                        end()
                    now = key
                part = Tile(letters[starts[s] : starts[e]].reshape(e - s, -1), words.slice(s, e - s), n.slice(s, e - s))
                if kind[s] == 0:
                    own.append(part)
                else:
                    wait[int(kind[s])].append(part)
                    if sum(len(p.words) for p in wait[int(kind[s])]) * part.letters.shape[1] >= min(TILE * part.letters.shape[1], TILE_LETTERS):
                        meet(int(kind[s]))
                if sum(map(len, out[0])) > 100_000:
                    yield flush()
        if now is not None:
            end()
        if out[0]:
            yield flush()

    return met.mapInArrow(each, "word string, near string, near_n long")


# ------------------------------------------------------------------ forms and roots

def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word of each chain of forms, by doubling."""
    roots = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("__from"), F.col("root").alias("__to"))
        further = roots.join(onward, F.col("root") == F.col("__from"), "left")
        roots = materialize(further.select("word", F.coalesce("__to", "root").alias("root"), F.col("__to").isNotNull().alias("moved")), "roots")
        if roots.where("moved").isEmpty():
            return roots.drop("moved")


def spelling_variants(docs: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of ``docs`` (doc_id, text)."""
    words = materialize(word_counts(docs), "words")
    near = near_words(meetings(words)).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    best = F.col("best")
    is_form = F.coalesce(-best["n"] >= times * F.col("n"), F.lit(False))
    formed = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, best["near"]).alias("form"), F.when(is_form, -best["n"]).alias("form_n")), "forms")
    roots = _roots(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


# Near words share what is left when a letter at some place is taken out: of both (replaced), or of the longer one only.
ORACLE = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest([translate(x, '{UPPER}', '{LOWER}') FOR x IN regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')]) AS run FROM documents),
keyed AS (SELECT doc, run, count(*) AS c FROM runs WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
hashed AS (SELECT run, c, {crc32_sql("(doc || ':' || run)")} AS h FROM keyed),
edited AS (SELECT CASE WHEN h % {EDITED} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM edited WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(c) >= {MIN_COUNT}),
cut AS (SELECT word, n, unnest(generate_series(1, length(word))) AS p FROM words),
holes AS (SELECT word, n, p, left(word, p - 1) || substr(word, p + 1) AS rest FROM cut),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.rest = w.word
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.rest = w.word),
best AS (SELECT word, count(*) AS n_near, min({{'n': -near_n, 'w': near}}) AS b FROM pairs GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.n >= {TIMES} * w.n THEN b.w END AS form, CASE WHEN -b.n >= {TIMES} * w.n THEN -b.n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS at, form AS nxt FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.nxt)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.nxt IS NULL
"""
