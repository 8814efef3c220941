"""Toxicity by weak supervision.

1. Lexicons. On a bounded sample of labelled training rows, Spark counts in how
   many toxic and clean texts each word and each word beginning occurs; those
   whose log-likelihood ratio is significant form the lexicons.
2. Voters. The lexicon is dealt by rank into several word voters and several
   beginning voters; each votes toxic on a hit and abstains otherwise. Pattern
   voters vote on the density of hits, on hits close together, and clean
   without any hit.
3. Label model. Expectation maximisation over the votes estimates each voter's
   accuracy; the voters' correlations that the latent label leaves unexplained
   divide their log-odds, so that voters which repeat each other count less. The
   given labels are one more voter of fixed accuracy.
4. Classifier. A logistic regression on lexicon terms and hit counts is trained
   on the posterior labels and scores every whole text.

Words are runs of letters, A-Z lower-cased, held as 64-bit hashes. Labels are
used only from rows outside the held-out fold; lang, source and doc_id are no
inputs of a score (doc_id only decides fold and sample). Null and empty texts
get the score of a text without hits. A doc_id with several labels counts as
toxic if one says so. Repeated rows are scored each time, and all get their
score if there are no labels at all (the score is then the prior, 0). Further
columns are kept; one with the name of a new column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from eventide.llm.common import RollingHash, lower_ascii, mix, slices, table, utf8

#: Most labelled training rows of each label that the model is fitted on (a bounded sample, in the order of a hash of doc_id).
MAX_TOXIC, MAX_CLEAN = 4_000, 12_000
#: Least log-likelihood ratio of a lexicon term, and most terms.
MIN_RATIO, MAX_TERMS = 20.0, 5_000
WORD_VOTERS, BEGINNING_VOTERS = 8, 4
BEGINNINGS = (4, 5, 6, 8)  # bytes
LABEL_ACCURACY = 0.97
THRESHOLD = 0.3

_LETTERS = np.zeros(256, bool)
_LETTERS[97:123] = _LETTERS[65:91] = _LETTERS[128:] = True


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes (rows: word, then each beginning; 0 where the word is no longer than it), text index and number of words."""
    buf, off = utf8(texts)
    inside = _LETTERS[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    prev = np.concatenate([[False], inside[:-1]]) if len(buf) else inside
    nxt = np.concatenate([inside[1:], [False]]) if len(buf) else inside
    starts = np.flatnonzero(inside & (~prev | edge[:-1]))
    ends = np.flatnonzero(inside & (~nxt | edge[1:])) + 1
    of = np.searchsorted(off, starts, side="right") - 1
    rolling = RollingHash(lower_ascii(buf))
    out = np.zeros((1 + len(BEGINNINGS), len(starts)), np.uint64)
    out[0] = rolling.of(starts, ends)
    for k, n in enumerate(BEGINNINGS):
        long = ends - starts > n
        out[k + 1, long] = mix(rolling.of(starts[long], starts[long] + n) + np.uint64(k + 1))
    return out, of, np.bincount(of, minlength=len(off) - 1)


@dataclass
class Lexicon:
    """Sorted hashes; each term's rank and whether it is a whole word."""

    hashes: np.ndarray
    rank: np.ndarray
    word: np.ndarray

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, word position, term) of every hit, and the number of words of each text."""
        found, of, n_words = terms(texts)
        if not len(self.hashes) or not found.shape[1]:
            none = np.zeros(0, np.int64)
            return none, none, none, n_words
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        kind, pos = np.nonzero((self.hashes[at] == found) & (found != 0))
        return of[pos], pos, at[kind, pos], n_words


def voter_count() -> int:
    return WORD_VOTERS + BEGINNING_VOTERS + 3


def votes_and_features(texts: pa.Array, lex: Lexicon) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Votes (1 toxic, 0 clean, -1 none) of each text, its distinct terms, and its dense features."""
    text, pos, term, n_words = lex.hits(texts)
    n = len(n_words)
    votes = np.full((n, voter_count()), -1, np.int8)
    voter = np.where(lex.word[term], lex.rank[term] % WORD_VOTERS, WORD_VOTERS + lex.rank[term] % BEGINNING_VOTERS) if len(term) else term
    votes[text, voter] = 1
    where = np.unique(np.stack([text, pos]), axis=1) if len(text) else np.zeros((2, 0), np.int64)
    hits = np.bincount(where[0], minlength=n)
    density = hits / np.maximum(n_words, 1)
    near = np.zeros(n, bool)
    if where.shape[1] > 1:
        near[where[0, 1:][(np.diff(where[0]) == 0) & (np.diff(where[1]) <= 10)]] = True
    at = WORD_VOTERS + BEGINNING_VOTERS
    votes[(density >= 0.01) & (hits >= 2), at] = 1
    votes[near, at + 1] = 1
    votes[hits == 0, at + 2] = 0
    pairs = np.unique(np.stack([text, term]), axis=1) if len(text) else np.zeros((2, 0), np.int64)
    own = np.split(pairs[1], np.searchsorted(pairs[0], np.arange(1, n))) if n else []
    dense = np.stack([np.log1p(hits), np.minimum(density, 0.2) * 20, near, hits == 0], axis=1).astype(np.float64) if n else np.zeros((0, 4))
    return votes, own, dense


def label_model(votes: np.ndarray, labels: np.ndarray, weight: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Posterior probability of toxic for each row of ``votes``."""
    n, m = votes.shape
    prior = float(np.clip((weight * labels).sum() / weight.sum(), 1e-3, 1 - 1e-3))
    given = np.where(labels == 1, np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY)), np.log((1 - LABEL_ACCURACY) / LABEL_ACCURACY))
    p, share = np.where(labels == 1, LABEL_ACCURACY, 1 - LABEL_ACCURACY), np.ones(m)
    onehot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(np.float64)
    for _ in range(rounds):
        w1, w0 = weight * p, weight * (1 - p)
        rate1 = (np.einsum("n,nmv->mv", w1, onehot) + 0.5) / (w1.sum() + 1.5)
        rate0 = (np.einsum("n,nmv->mv", w0, onehot) + 0.5) / (w0.sum() + 1.5)
        odds = np.einsum("nmv,mv->nm", onehot, np.log(rate1) - np.log(rate0))
        fires = votes >= 0
        left = fires - (p[:, None] * (1 - rate1[:, 0]) + (1 - p[:, None]) * (1 - rate0[:, 0]))
        cov = (left * weight[:, None]).T @ left / weight.sum()
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        share = 1 / (1 + np.maximum(np.abs(cov / np.outer(sd, sd)) - np.eye(m), 0).sum(axis=1))
        logit = np.log(prior / (1 - prior)) + odds @ share + given
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        prior = float(np.clip((weight * p).sum() / weight.sum(), 1e-3, 1 - 1e-3))
    return p


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray  # terms, then dense features, then the constant

    def scores(self, texts: pa.Array) -> np.ndarray:
        _, own, dense = votes_and_features(texts, self.lexicon)
        k = len(self.lexicon.hashes)
        z = dense @ self.weights[k:-1] + self.weights[-1]
        z += np.array([self.weights[t].sum() for t in own]) if len(own) else 0
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(own: list[np.ndarray], dense: np.ndarray, k: int, target: np.ndarray, weight: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Logistic regression with soft targets, by accelerated gradient steps."""
    rows = np.repeat(np.arange(len(own)), [len(t) for t in own])
    cols = np.concatenate(own) if len(rows) else np.zeros(0, np.int64)
    x = np.concatenate([dense, np.ones((len(dense), 1))], axis=1)
    weight = weight / weight.sum()
    w = v = np.zeros(k + x.shape[1])
    norm = 0.25 * float((weight * (np.bincount(rows, minlength=len(own)) + (x**2).sum(axis=1))).sum()) + 0.25
    for t in range(rounds):
        z = x @ v[k:] + np.bincount(rows, weights=v[cols], minlength=len(own))
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        grad = np.concatenate([np.bincount(cols, weights=g[rows], minlength=k), x.T @ g]) + 1e-5 * v
        new = v - grad / norm
        w, v = new, new + t / (t + 3) * (new - w)
    return w


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out fold."""
    rows = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    sample = rows.where("toxic = 1").orderBy(*order).limit(MAX_TOXIC).unionByName(rows.where("toxic = 0").orderBy(*order).limit(MAX_CLEAN))
    empty = Lexicon(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool))
    if len(sizes) < 2:
        return Model(empty, np.array([0, 0, 0, 0, 30.0 if sizes.get(1) else -30.0]))
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")  # at most MAX_TOXIC + MAX_CLEAN small rows

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                found, of, _ = terms(b.column("text"))
                toxic = np.array(b.column("toxic").to_pylist(), bool)
                kind, pos = np.nonzero(found)
                h, d = found[kind, pos], of[pos]
                _, first = np.unique(mix(h + mix(d.astype(np.uint64) + np.uint64(1))), return_index=True)
                h, d, word = h[first], d[first], kind[first] == 0
                known, at, inverse = np.unique(h, return_index=True, return_inverse=True)
                yield pa.RecordBatch.from_pydict({
                    "h": pa.array(known.view(np.int64)), "word": pa.array(word[at]),
                    "a": pa.array(np.bincount(inverse, weights=toxic[d], minlength=len(known)).astype(np.int64)),
                    "n": pa.array(np.bincount(inverse, minlength=len(known)))})

    n1, n0 = min(sizes[1], MAX_TOXIC), min(sizes[0], MAX_CLEAN)
    a, c = F.col("a"), F.col("n") - F.col("a")
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0)
    expected = F.col("n") * (n1 / (n1 + n0))
    ratio = 2 * (part(a, expected) + part(c, F.col("n") - expected))
    lexicon = (
        texts.mapInArrow(count, "h bigint, word boolean, a bigint, n bigint").groupBy("h")
        .agg(F.max("word").alias("word"), F.sum("a").alias("a"), F.sum("n").alias("n"))
        .where((a > expected) & (a >= 0.5 * F.col("n"))).withColumn("ratio", F.round(ratio, 6)).where(F.col("ratio") >= MIN_RATIO)
        .orderBy(F.desc("ratio"), "h").limit(MAX_TERMS).collect()
    )
    h = np.array([r["h"] for r in lexicon], np.int64).view(np.uint64)
    order_by_hash = np.argsort(h)
    word = np.array([r["word"] for r in lexicon], bool)
    rank = np.zeros(len(h), np.int64)
    for kind in (True, False):
        rank[word == kind] = np.arange((word == kind).sum())
    lex = Lexicon(h[order_by_hash], rank[order_by_hash], word[order_by_hash])

    def represent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                votes, own, dense = votes_and_features(b.column("text"), lex)
                yield pa.RecordBatch.from_pydict({
                    "toxic": b.column("toxic"), "votes": pa.array(votes.tolist(), pa.list_(pa.int8())),
                    "own": pa.array([t.tolist() for t in own], pa.list_(pa.int64())), "dense": pa.array(dense.tolist(), pa.list_(pa.float64()))})

    got = texts.mapInArrow(represent, "toxic int, votes array<tinyint>, own array<bigint>, dense array<double>").orderBy("toxic", "votes", "own", "dense").toArrow()
    y = np.array(got["toxic"].to_pylist())
    weight = np.where(y == 1, sizes[1] / n1, sizes[0] / n0)
    posterior = label_model(np.array(got["votes"].to_pylist(), np.int8).reshape(len(y), -1), y, weight)
    own = [np.array(t, np.int64) for t in got["own"].to_pylist()]
    return Model(lex, fit_linear(own, np.array(got["dense"].to_pylist()).reshape(len(y), -1), len(h), posterior, weight))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Columns of ``docs`` plus held_out, score and predicted."""
    model = train(docs, labels)
    new = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    docs = docs.select(*[c for c in docs.columns if c not in ("held_out", "score", "predicted")]).withColumn("held_out", held_out(F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                s = np.round(model.scores(b.column("text")), 6)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=[*b.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *new, ]))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")
