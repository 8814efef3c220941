"""Secret scan by corpus-wide ownership frequency, in DataFrame operations only.

Each text is searched for candidates: values assigned to names like password,
access keys, long hexadecimal strings, and other long tokens that mix letters and
digits. The SHA-256 of every candidate's value is counted by the distinct
repositories and owners that hold it, over the whole corpus. A value that
``COPIED`` owners or more hold is a widely copied example; one that a single
owner holds and that looks live (long, with letters and digits in turn) is that
owner's own credential, and its span is added as kind ``owned``.

The repository of a document is its ``source``, the owner what stands before the
first slash of it (all of it if there is none). Matches are leftmost and do not
overlap within a kind; their places follow from the lengths of the matches and
of the texts between them, summed up per document in Spark. Only lengths and
hashes leave the scan, neither texts nor values.

Null texts are empty; a null source is an owner of its own. Repeated rows are
scanned each; they count once per owner. An empty table gives an empty result.
Further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import materialize, table

#: Owners that make a value a widely copied example.
COPIED = 3


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
#: Kinds in the order of spans: pattern, least length of a value.
KINDS = {
    "assign": (rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    "access": ("AKIA[A-Z0-9]+", 20),
    "hex": ("[0-9a-f]{24,}", 24),
    "loose": ("[A-Za-z0-9_+=-]{20,}", 20),
}
#: From a match of kind assign, what stands before its value.
BEFORE_VALUE = r"""^[^:=]*[:=]\x20*["']?"""
OWNED = "owned"
TURNS = "[A-Za-z][0-9]|[0-9][A-Za-z]"
#: A value looks live if it is this long and changes between letters and digits this often.
LIVE_LENGTH, LIVE_TURNS = 16, 3
#: Texts without such a run have no access key, hexadecimal string or loose token; those without an assignment sign no assignment.
LONG_RUN, SIGN = "[A-Za-z0-9_+=-]{20,}", "[:=]"


def _found(text: Column, kind: str) -> Column:
    """Of every match of a kind: code points before it since the last one, its length, its value's length, hash and look."""
    pattern, _ = KINDS[kind]
    pattern = F.lit(pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, pattern, -1)

    def one(match: Column, k: Column) -> Column:
        value = F.regexp_replace(match, BEFORE_VALUE, "") if kind == "assign" else match
        return F.struct(
            F.length(F.get(between, k)).alias("gap"), F.length(match).alias("length"), F.length(value).alias("value"), F.sha2(value.cast("binary"), 256).alias("hash"),
            ((F.length(value) >= LIVE_LENGTH) & (F.regexp_count(value, F.lit(TURNS)) >= LIVE_TURNS)).alias("live"))

    may = text.rlike(SIGN if kind == "assign" else LONG_RUN)
    return F.when(may & text.rlike(KINDS[kind][0]), F.transform(matches, one))


def scan(docs: DataFrame, repository: str = "source") -> DataFrame:
    """(row, doc_id, repository, one array of matches per kind), written: the texts are read once."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(repository, F.lit("")).alias("repository"), *[_found(text, k).alias(k) for k in KINDS])
    return materialize(rows, "secrets")


def candidates(scanned: DataFrame) -> DataFrame:
    """(row, doc_id, repository, kind, start, end, from, hash, live) of all matches that are long enough; ``from`` is where the value starts."""
    parts = [scanned.select("row", "doc_id", "repository", F.lit(k).alias("kind"), F.posexplode(name).alias("pos", "m")) for k, name in enumerate(KINDS)]
    matches = parts[0]
    for part in parts[1:]:
        matches = matches.unionByName(part)
    before = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    matches = matches.withColumn("end", F.sum(F.col("m.gap") + F.col("m.length")).over(before))
    least = F.element_at(F.array(*[F.lit(n) for _, n in KINDS.values()]), F.col("kind") + 1)
    return matches.where(F.col("m.value") >= least).select(
        "row", "doc_id", "repository", "kind", (F.col("end") - F.col("m.length")).alias("start"), "end", (F.col("end") - F.col("m.value")).alias("from"), "m.hash", "m.live")


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owners, repositories): how many distinct ones hold each value."""
    owner = F.substring_index("repository", "/", 1)
    held = found.where("kind < 3 OR live").groupBy("hash", "repository").agg(F.lit(1)).groupBy("hash", owner.alias("owner")).agg(F.count("*").alias("n"))
    return held.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))


def secret_spans(docs: DataFrame, repository: str = "source") -> DataFrame:
    """(row, doc_id, spans: array of (start, kind, end), n_owned, n_copied) of every document; kinds by number, owned after the base ones."""
    scanned = scan(docs, repository)
    found = materialize(candidates(scanned), "candidates").where("kind < 3 OR live")
    judged = found.join(ownership(found), "hash")
    owned, base = (F.col("owners") == 1) & F.col("live"), F.col("kind") < 3
    spans = F.array_compact(F.array(
        F.when(base, F.struct("start", "kind", "end")), F.when(owned, F.struct(F.col("from").alias("start"), F.lit(3).alias("kind"), "end"))))
    per_row = judged.select("row", "doc_id", spans.alias("spans"), owned.alias("owned"), (F.col("owners") >= COPIED).alias("copied"), F.struct("from", "end").alias("at")).groupBy("row", "doc_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),  # a document's own matches
        F.size(F.collect_set(F.when(F.col("owned"), F.col("at")))).cast("long").alias("n_owned"), F.size(F.collect_set(F.when(F.col("copied"), F.col("at")))).cast("long").alias("n_copied"))
    none = scanned.join(per_row.select("row"), "row", "left_anti")
    nothing = none.select("row", "doc_id", F.array().cast(per_row.schema["spans"].dataType).alias("spans"), F.lit(0).cast("long").alias("n_owned"), F.lit(0).cast("long").alias("n_copied"))
    return per_row.unionByName(nothing)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in [*list(KINDS)[:3], OWNED]])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _number_of(kind: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select("doc_id", *[_number_of(k).alias(f"n_{name}") for k, name in enumerate(list(KINDS)[:3])], F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"), "n_owned", "n_copied")


def _oracle() -> str:
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    parts = []
    for k, (pattern, least) in enumerate(KINDS.values()):
        value = f"regexp_replace(m, {quoted(BEFORE_VALUE)}, '')" if k == 0 else "m"
        parts.append(f"""
  SELECT r, doc_id, source, {k} AS kind, "end" - length(m) AS start, "end", {value} AS v FROM (
    SELECT r, doc_id, source, m, sum(length(g) + length(m)) OVER (PARTITION BY r ORDER BY p) AS "end" FROM (
      SELECT r, doc_id, source, unnest(regexp_extract_all(text, {quoted(pattern)})) AS m, unnest(string_split_regex(text, {quoted(pattern)})[:-2]) AS g,
             generate_subscripts(regexp_extract_all(text, {quoted(pattern)}), 1) AS p
      FROM d))
  WHERE length({value}) >= {least}""")
    turns = f"len(regexp_extract_all(v, {quoted(TURNS)}))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
every AS ({' UNION ALL '.join(parts)}),
seen AS (SELECT *, length(v) >= {LIVE_LENGTH} AND {turns} >= {LIVE_TURNS} AS live FROM every),
found AS (SELECT * FROM seen WHERE kind < 3 OR live),
held AS (SELECT v, count(DISTINCT split_part(source, '/', 1)) AS owners FROM found GROUP BY v),
judged AS (SELECT *, live AND owners = 1 AS owned FROM found JOIN held USING (v)),
spans AS (
  SELECT r, kind, start, "end" FROM judged WHERE kind < 3
  UNION SELECT r, 3, "end" - length(v), "end" FROM judged WHERE owned),
named AS (SELECT *, ['assign', 'access', 'hex', '{OWNED}'][kind + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST("end" AS BIGINT) AS s FROM spans),
per AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         string_agg(s, ',' ORDER BY start, kind, "end") FILTER (kind < 3) AS base, string_agg(s, ',' ORDER BY start, kind, "end") AS spans
  FROM named GROUP BY r),
marks AS (
  SELECT r, count(DISTINCT ("end" - length(v), "end")) FILTER (owned) AS n_owned, count(DISTINCT ("end" - length(v), "end")) FILTER (owners >= {COPIED}) AS n_copied
  FROM judged GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_owned, 0) AS n_owned, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN per USING (r) LEFT JOIN marks USING (r)
"""


ORACLE = _oracle()
