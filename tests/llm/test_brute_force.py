"""Operators against plain re-computations on the small tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from eventide.llm import decontamination, jaccard_join, quality_rules, segmentation, suffix_dedup, suffix_runs, token_counts, toxicity
from eventide.llm.common import listed_tables

SF = "/root/testdata/sf0.01"
SPACES = re.compile(r"[^\x20\x09-\x0D]+")
TO_LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def _docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")


@pytest.mark.parametrize("n,num,den", [(3, 9, 10), (5, 4, 5)])
def test_jaccard_components(spark, n, num, den):
    docs = _docs(spark)
    sets = {}
    for r in docs.collect():
        w = SPACES.findall((r["text"] or "").translate(TO_LOWER))
        sets[r["doc_id"]] = frozenset([tuple(w[j : j + n]) for j in range(len(w) - n + 1)] if len(w) >= n else ([tuple(w)] if w else []))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having = defaultdict(list)
    for i, s in sets.items():
        for j, c in Counter(j for g in s for j in having[g]).items():
            if c * den >= (len(s) + len(sets[j]) - c) * num:
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for g in s:
            having[g].append(i)
    got = {r[0]: (r[1], r[2]) for r in jaccard_join.jaccard_components(docs, n, num, den).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in sets}


def _components_of(spark, texts, num, den):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    return {r[0]: r[2] for r in jaccard_join.jaccard_components(docs, 1, num, den).collect()}


@pytest.mark.parametrize("crowd", [32, 2])
def test_jaccard_components_of_sets_with_common_parts(spark, monkeypatch, crowd):
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    rnd = random.Random(11)
    common, texts = [f"c{i}" for i in range(30)], []
    for k in range(90):  # unlike sets that share a part, each with up to two sets at the limit of similarity
        own = [f"t{k}x{i}" for i in range(rnd.randint(8, 120))]
        whole = common + own
        texts.append(whole)
        for c in range(rnd.randint(0, 2)):
            cut = rnd.sample(whole, len(whole) - len(whole) // rnd.choice([6, 9, 10, 12]))
            texts.append(cut + [f"n{k}x{c}x{i}" for i in range(rnd.randint(0, len(cut) // 12))])
    sets, root = [set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for j in range(len(sets)):
        for i in range(j):
            if len(sets[i] & sets[j]) * 5 >= len(sets[i] | sets[j]) * 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert _components_of(spark, [" ".join(t) for t in texts], 4, 5) == {i: find(i) for i in range(len(sets))}


@pytest.mark.parametrize("num,den", [(4, 5), (9, 10)])
def test_similar_sets_share_more_than_the_spare_signatures(num, den):
    rng, enum, met = np.random.default_rng(3), jaccard_join.PartEnum(num, den), 0
    for size in [*range(5, 60, 4), *range(60, 700, 45)]:
        for _ in range(6):
            x = rng.integers(0, 2**63, size, dtype=np.uint64)
            gone = int(rng.integers(0, size * (den - num) // den + 1))
            new = max(0, (size - gone) * den // num - size)  # the most that may come instead
            if gone + new == 0:
                continue
            y = np.concatenate([x[gone:], rng.integers(0, 2**63, new, dtype=np.uint64)])
            assert (size - gone) * den >= (size + new) * num
            both_sets, sizes = np.concatenate([x, y]), np.array([size, len(y)])
            a, b = enum.signatures(both_sets, sizes)
            shared = np.intersect1d(a, b)
            assert len(shared) > int((shared & np.uint64(15)).min())
            assert jaccard_join._apart(*jaccard_join._sketches(both_sets, sizes)) <= gone + new
            met += 1
    assert met > 50


def test_unlike_sets_with_a_common_part_are_not_compared_by_shingle(spark):
    rnd = random.Random(5)
    common = [f"c{i}" for i in range(25)]
    texts = [" ".join([*common, *(f"t{k}x{i}" for i in range(rnd.randint(240, 250)))]) for k in range(400)]
    with listed_tables() as paths:
        assert _components_of(spark, texts, 4, 5) == {i: i for i in range(len(texts))}
    told = spark.read.parquet(next(p for p in paths if "/differences-" in p))
    assert (told.selectExpr("sum(size(first))").first()[0] or 0) < 10_000  # 75 053 when every bucket compared its members with its hub


@pytest.mark.parametrize("length,hot", [(400, 20_000), (60, 20_000), (60, 3)])
def test_repeated_strings(spark, length, hot):
    docs = _docs(spark)
    data = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    seen = Counter(hash(b[p : p + length]) for b in data.values() for p in range(len(b) - length + 1))
    want = {}
    for i, b in data.items():
        edge = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if seen[hash(b[p : p + length])] > 1:
                edge[p] += 1
                edge[p + length] -= 1
        hit = np.cumsum(edge)[:-1] > 0
        spans = int((hit & ~np.concatenate([[False], hit[:-1]])[: len(hit)]).sum())
        want[i] = (len(b), int(hit.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~hit])).hexdigest())
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.remove_repeats(docs, length, hot).collect()}
    assert got == want


@pytest.mark.parametrize("often", [10_000, 2])
def test_strings_of_hot_cores_are_not_gathered(spark, often):
    passage = "".join(chr(97 + i * i % 23) for i in range(40))
    rows = [(f"{i:05d}{passage}{i:05d}", [(8, 0, 8, 1, i, True)]) for i in range(50)]
    texts = spark.createDataFrame(rows, "text string, units array<struct<a:int,lo:int,hi:int,ch:bigint,uh:bigint,hot:boolean>>").repartition(4)
    assert suffix_dedup._runs(texts, 38, 4).count() == 0  # before: one group with all copies of a string
    got = sorted((r["ch"], r["uh"], r["low"], r["high"]) for r in suffix_dedup._hot_marks(texts, 38, often).collect())
    seen = Counter(t[8 - d : 46 - d] for t, _ in rows for d in range(9))
    assert got == sorted((1, u[0][4], d, d) for t, u in rows for d in range(9) if seen[t[8 - d : 46 - d]] > 1) and got


def test_front_coded_runs_and_merge():
    rnd = random.Random(3)
    lists = [sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(0, 40))) for _ in range(7)]
    merged = list(suffix_runs.merge([suffix_runs.Run.read(*suffix_runs.Run(x).pack()) for x in lists]))
    assert [k for _, _, k in merged] == sorted(k for x in lists for k in x)
    before = b""
    for _, shared, key in merged:
        assert shared == suffix_runs.common_prefix(before, key)
        before = key


def test_base_counters(spark):
    texts = [r["text"] or "" for r in _docs(spark).limit(300).collect()] + ["", "a a a a a a a a", "x\nx\n \n \nx"]
    got = quality_rules.features(pa.array(texts))
    for i, t in enumerate(texts):
        w = SPACES.findall(t)
        grams = Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        covered = {k for j in range(len(w) - 4) if grams[tuple(w[j : j + 5])] > 1 for k in range(j, j + 5)}
        lines = Counter(x for x in t.split("\n") if SPACES.search(x))
        assert (got["n_words"][i], got["word_chars"][i], got["n_symbols"][i], got["n_dup_lines"][i], got["n_repeat_words"][i]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), sum(lines.values()) - len(lines), len(covered))


def test_clean_documents_are_kept(spark):
    rows = quality_rules.quality_rules(_docs(spark)).select("doc_id", "kept", "base_failed").collect()
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    clean = [r for r in rows if r["doc_id"] in good and not r["base_failed"]]
    assert sum(r["kept"] for r in clean) >= 0.99 * len(clean)


def test_token_counts_of_texts_and_prefixes(spark):
    import sentencepiece

    path = token_counts.tokenizer_path(token_counts.TOKENIZER)
    sp, c, rnd = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.PrefixCounter(path), random.Random(5)
    texts = [r["text"] or "" for r in _docs(spark).limit(200).collect()]
    texts += ["".join(rnd.choice("abcdeth inrsu ▁\n.,é日😀") for _ in range(rnd.randint(0, 50))) for _ in range(300)] + ["", " ", "  a  b", "<s> <0x41>"]
    assert token_counts.count_batch(pa.array(texts), c).tolist() == [len(x) for x in sp.encode(texts, num_threads=1)]
    for t in texts[200:260]:
        counts = [len(sp.encode(t[:i])) for i in range(len(t) + 1)]
        assert c.text_prefixes(t) == counts
        assert c.fitting(t, 5) == max(i for i, n in enumerate(counts) if n <= 5)


def test_samples_without_replacement():
    p = segmentation.Pieces(token_counts.tokenizer_path(token_counts.TOKENIZER), 0.5)
    n = 6000
    ids, logp, score, good = segmentation.sample_slice(["the"] * n, np.arange(n), 3, p)
    assert good.all() and all(len({tuple(a) for a in x}) == len(x) for x in ids)
    prob = {tuple(a): math.exp(v) for x, y in zip(ids, logp) for a, v in zip(x, y)}
    first, second = Counter(tuple(x[0]) for x in ids), Counter(tuple(x[1]) for x in ids)
    for k, v in prob.items():
        assert abs(first[k] / n - v) < 0.02
        assert abs(second[k] / n - sum(prob[a] * v / (1 - prob[a]) for a in prob if a != k)) < 0.02
    assert abs(sum(sum(math.exp(v) / s for v, s in zip(y, z)) for y, z in zip(logp, score)) / n - 1) < 0.01
    texts = ["A text  of words\n日本 😀", "x", ""]
    alone, together = segmentation.sample_slice(texts[:1], np.array([9]), 2, p), segmentation.sample_slice(texts, np.array([9, 1, 2]), 2, p)
    assert [a.tolist() for a in alone[0][0]] == [a.tolist() for a in together[0][0]]
    assert all(segmentation.decode(a, p) == texts[0] for a in alone[0][0])


def test_samples_of_texts_with_long_tails_without_choice(monkeypatch):
    p = segmentation.Pieces(token_counts.tokenizer_path(token_counts.TOKENIZER), 0.5)
    head, rnd = "some words with choices", random.Random(8)
    texts = [head + "\n" * 2_500, head + "日本語" * 3_000, head + "\n" * 9_000 + "the", head, "\n" * 5_000, "",
             " ".join(rnd.choice(["word", "tokens", "日本"]) for _ in range(900))]
    texts, keys = texts * 5, np.arange(35)
    got = [segmentation.sample_slice(texts, keys, 4, p)]
    monkeypatch.setattr(segmentation, "DEPTH", 5.0)  # deep nodes are opened later
    got.append(segmentation.sample_slice(texts, keys, 4, p))
    monkeypatch.setattr(segmentation, "DEPTH", math.inf)
    monkeypatch.setattr(segmentation, "TAIL", 10**9)
    ids, logp, score, good = segmentation.sample_slice(texts, keys, 4, p)
    assert len(ids[0]) == 4 and good.all()
    for ids2, logp2, score2, good2 in got:
        assert [[a.tolist() for a in x] for x in ids2] == [[a.tolist() for a in x] for x in ids]
        assert [v for x in score2 for v in x] == pytest.approx([v for x in score for v in x]) and good2.all()


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r for r in rows if r["toxic"]], [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic) and sum(r["predicted"] for r in clean) <= 0.01 * len(clean)


def test_decontamination_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = sorted(con.sql(decontamination.ORACLE).fetchall())
    cols = [d[0] for d in con.sql(decontamination.ORACLE).description]
    assert sorted(tuple(r[c] for c in cols) for r in decontamination.op9_decontamination(spark, SF).collect()) == want


def test_proximity_finds_planted_words(spark):
    docs = spark.createDataFrame([(1, "aa x x bb x cc"), (2, "aa " + "x " * 60 + "bb cc"), (3, "bb")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, "aa bb cc")], "item_id bigint, text string")
    assert {r["doc_id"] for r in decontamination.proximity(docs, bench, span=10).collect()} == {1}
