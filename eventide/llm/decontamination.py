"""Benchmark decontamination by a positional inverted index, in DataFrame operations only.

The documents are the training side. Their token postings (term, document,
position) are made for the terms that the benchmark needs: of every benchmark
window, the ``RAREST`` terms with the fewest postings in the documents. Postings
of a term at place p of an item, at position q of a document, say that the item
would start at q - p (the offset-adjusted list). The lists of a window's rarest
terms are intersected, which leaves few alignments (document, item, start); each
is then compared word by word with the document, which gives the exact windows.

Words are runs of characters other than the ASCII ones that are no digits or
letters, after lower-casing A-Z. A window is ``window`` consecutive words of an
item; an item with fewer words is one window of all its words. Null and empty
texts have no words. Repeated documents are judged each time; repeated items
count once per item_id (a null item_id is named ``null``). An empty benchmark
contaminates nothing. Further columns of the documents are kept; one with the
name of a new column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import materialize, table
from eventide.llm.url_filter import LOWER, UPPER

WINDOW_WORDS = 13
#: Lists that are intersected for a window.
RAREST = 3
#: Most rows of index terms that are broadcast; more are joined by a shuffle.
BROADCAST_TERMS = 500_000


def tokens(text: Column) -> Column:
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(parts, "")


def _sized(small: DataFrame) -> DataFrame:
    """Broadcast after a check of its size."""
    n = len(small.select(F.lit(1)).limit(BROADCAST_TERMS + 1).collect())
    return F.broadcast(small) if n <= BROADCAST_TERMS else small


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, words) of the distinct items that have words."""
    words = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), tokens(F.col("text")).alias("words"))
    return words.where(F.size("words") > 0).distinct().select(F.xxhash64("item_id", "words").alias("item"), "item_id", "words")


def index_terms(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, rarest: int = RAREST) -> DataFrame:
    """(item, at, places, words): the places of the rarest terms of each window that can occur."""
    placed = items.select("item", F.posexplode("words").alias("place", "term"))
    vocabulary = placed.select("term").distinct()
    counts = (
        docs.select(F.explode(tokens(F.col("text"))).alias("term")).join(_sized(vocabulary), "term", "left_semi")
        .groupBy("term").agg(F.count("*").alias("n"))
    )
    known = placed.join(counts, "term")
    length = items.select("item", F.size("words").alias("m"))
    windows = length.select("item", F.explode(F.sequence(F.lit(0), F.greatest(F.col("m") - window, F.lit(0)))).alias("at"), F.least("m", F.lit(window)).alias("len"))
    inside = windows.join(known, "item").where("place >= at AND place < at + len")
    return (
        inside.groupBy("item", "at", "len").agg(F.sort_array(F.collect_list(F.struct("n", "place", "term"))).alias("terms"))  # at most ``window`` places
        .where(F.size("terms") == F.col("len"))  # a word without postings: the window does not occur
        .select("item", "at", F.slice("terms", 1, rarest).alias("terms"))
    )


def postings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, position, term, ...) for the terms of ``wanted``, with its columns."""
    spread = docs.select("doc_id", F.posexplode(tokens(F.col("text"))).alias("position", "term"))
    return spread.join(_sized(wanted), "term")


def alignments(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, item, start) where all rarest terms of some window are in place."""
    wanted = windows.select("item", F.explode("terms").alias("t")).select("item", F.col("t.place").alias("place"), F.col("t.term").alias("term")).distinct()
    needed = windows.groupBy("item").agg(F.collect_set(F.transform("terms", lambda t: t["place"])).alias("needed"))  # one entry per window of an item
    lists = postings(docs, wanted).select("doc_id", "item", (F.col("position") - F.col("place")).alias("start"), "place")
    met = lists.groupBy("doc_id", "item", "start").agg(F.collect_set("place").alias("places"))  # at most the words of an item
    return (
        met.where(F.size("places") > 0).join(_sized(needed), "item")
        .where(F.exists("needed", lambda need: F.size(F.array_except(need, F.col("places"))) == 0))
        .select("doc_id", "item", "start")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, times: int = 20) -> DataFrame:
    """Columns of ``docs`` plus n_words, n_hit, n_items, items_sha256 and contaminated (``times`` the hit words are at least all words)."""
    new = {"n_words", "n_hit", "n_items", "items_sha256", "contaminated"}
    docs = docs.select(*[c for c in docs.columns if c not in new])
    items = items_of(benchmark)
    windows = materialize(index_terms(docs, items, window), "windows")
    starts = alignments(docs, windows).groupBy("doc_id", "item").agg(F.collect_set("start").alias("starts"))  # places of one document
    found = starts.join(_sized(items), "item")
    by_doc = found.groupBy("doc_id").agg(F.collect_list(F.struct("starts", "item_id", "words")).alias("__found")).withColumnRenamed("doc_id", "__doc")
    words = F.col("__words")

    def at_start(a: Column, start: Column) -> Column:
        """Places of the document's words in the windows that it has of the item at this alignment."""
        m = F.size(a["words"])
        length = F.least(m, F.lit(window))
        same = F.transform(a["words"], lambda w, k: F.coalesce(F.get(words, start + k) == w, F.lit(False)))
        hits = F.filter(F.sequence(F.lit(0), m - length), lambda s: F.forall(F.slice(same, s + 1, length), lambda x: x))
        return F.flatten(F.transform(hits, lambda s: F.sequence(start + s, start + s + length - 1)))

    def matched(a: Column) -> Column:
        return F.struct(a["item_id"].alias("item_id"), F.flatten(F.transform(a["starts"], lambda start: at_start(a, start))).alias("hit"))

    joined = docs.join(by_doc, F.col("doc_id").eqNullSafe(F.col("__doc")), "left").withColumn("__words", tokens(F.col("text")))
    checked = joined.withColumn("__real", F.when(F.col("__found").isNotNull(), F.filter(F.transform("__found", matched), lambda r: F.size(r["hit"]) > 0)))
    ids = F.array_sort(F.array_distinct(F.transform("__real", lambda r: r["item_id"])))
    n_words, n_hit = F.size("__words").cast("long"), F.coalesce(F.size(F.array_distinct(F.flatten(F.transform("__real", lambda r: r["hit"])))), F.lit(0)).cast("long")
    return (
        checked.withColumns({"n_words": n_words, "n_hit": F.when(F.col("__real").isNull(), F.lit(0)).otherwise(n_hit).cast("long"), "__ids": F.coalesce(ids, F.array().cast("array<string>"))})
        .withColumns({
            "n_items": F.size("__ids").cast("long"), "items_sha256": F.sha2(F.array_join("__ids", ","), 256),
            "contaminated": (F.col("n_hit") > 0) & (F.col("n_hit") * times >= F.col("n_words"))})
        .drop("__doc", "__found", "__words", "__real", "__ids")
    )


def proximity(docs: DataFrame, benchmark: DataFrame, span: int = 20, rarest: int = RAREST) -> DataFrame:
    """(doc_id, item_id, position): postings of an item's rarest term with its next rarest ones at most ``span`` words away, in any order."""
    items = items_of(benchmark)
    placed = items.select("item", F.explode(F.array_distinct("words")).alias("term"))
    counts = docs.select(F.explode(tokens(F.col("text"))).alias("term")).join(_sized(placed.select("term").distinct()), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    ranked = placed.join(counts, "term").withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy("n", "term"))).where(F.col("rank") <= rarest)
    lists = postings(docs, ranked.select("item", "term", "rank"))
    near = Window.partitionBy("doc_id", "item").orderBy("position").rangeBetween(-span, span)
    seen = lists.withColumns({f"__{k}": F.max(F.col("rank") == k).over(near) for k in range(2, rarest + 1)}).where("rank = 1")
    terms = ranked.groupBy("item").agg(F.max("rank").alias("terms"))
    for k in range(2, rarest + 1):
        seen = seen.withColumn(f"__{k}", F.coalesce(F.col(f"__{k}"), F.lit(False)).cast("int"))
    total = sum((F.col(f"__{k}") for k in range(2, rarest + 1)), F.lit(1))
    return seen.join(terms, "item").where(total == F.col("terms")).join(items.select("item", "item_id"), "item").select("doc_id", "item_id", "position")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).drop("text")


_TOKENS = f"[x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> '']"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TOKENS} AS w FROM documents),
b AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), 'null') AS item_id, {_TOKENS} AS w FROM benchmark),
bw AS (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - {WINDOW_WORDS - 1}, 1))) AS s FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, least(len(w), {WINDOW_WORDS}) AS l, array_to_string(w[s : s + {WINDOW_WORDS - 1}], ' ') AS v FROM bw),
grams AS (
  SELECT r, x.l, unnest([array_to_string(w[i : i + x.l - 1], ' ') FOR i IN generate_series(1, len(w) - x.l + 1)]) AS v,
         unnest(generate_series(1, len(w) - x.l + 1)) AS p
  FROM d, (SELECT DISTINCT l FROM win) x WHERE len(w) >= x.l),
occ AS (SELECT r, item_id, p, l FROM grams JOIN win USING (l, v)),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + l - 1)) AS q FROM occ) GROUP BY r),
ids AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM occ GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""
