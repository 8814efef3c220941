"""Conversation structure repair by a square-root checkpointed dynamic program.

A repaired conversation has the role initials ``(s?(ua)+)?``. Its rows are read
in the order of turn (nulls first), role and text. Four states say what may
follow: nothing yet, a system row came, a user row came (open), an assistant row
came. ``back`` takes the vector of least costs behind a row to the one before
it. Walking backwards only the vectors at every sqrt(n)-th row are stored;
walking forward each block's vectors are computed again from its checkpoint, and
of all edits that keep the cost least the one with the smallest letter is taken
(D, I, K, R), which gives the ASCII-least of the cheapest edit strings.

Conversations of up to ``LONG_ROWS`` rows and ``LONG_BYTES`` of text are repaired
in one go, one after another, in the task that their conv_id is dealt to. Longer
ones are never in one task: their rows are sorted by range over many tasks and
cut into blocks of ``BLOCK`` rows; each block gives its 4 x 4 matrix of least
costs (min-plus), from which the vectors at the block bounds follow; each block
is then walked from all four states, and the states that the blocks really meet
are chained. Both ways give the same result; only the SHA-256 of a conversation,
which no two tasks can share, is a stream of blocks through one task.

Null roles and texts are one space (as is a null conv_id or turn in the key of
the damage); a null conv_id is a conversation of its own, null turns come first
and are left out of ``gaps``. Repeated rows are duplicates. A conversation
without rows has zeros and an empty audit. An empty table gives an empty result.
Further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import materialize, table

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a user or assistant row that is put in or given a new role.
NEXT = (USER, USER, ASSISTANT, USER)
#: By role initial: the states that may keep such a row, and the state after it.
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ROLE = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
FAR = 1 << 40
#: Conversations beyond these are repaired in blocks.
LONG_ROWS, LONG_BYTES = 20_000, 16_000_000
BLOCK = 4_096
BLANK = r"^[\x20\x09-\x0D]*$"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

_OUT = T.StructType([T.StructField("gaps", T.LongType()), T.StructField("blank", T.LongType()), T.StructField("duplicate", T.LongType()),
                     T.StructField("truncated", T.LongType()), T.StructField("illegal", T.LongType()), T.StructField("cost", T.LongType()),
                     T.StructField("audit", T.StringType()),
                     T.StructField("repaired", T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])))])


# ------------------------------------------------------------------ the dynamic program

def settle(costs: list[int]) -> list[int]:
    """Costs when rows may be put in before going on."""
    costs = list(costs)
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
    return costs


END = settle([0, FAR, FAR, 0])


def back(initial: str, fault: int | None, after: list[int]) -> list[int]:
    """Costs before a row from those behind it. ``fault`` is the surcharge of a row that stays, None if it has to go."""
    costs = [DELETE + c for c in after]
    if fault is not None:
        costs = [min(c, fault + REROLE + after[NEXT[q]]) for q, c in enumerate(costs)]
        for q, then in KEEP.get(initial, {}).items():
            costs[q] = min(costs[q], fault + after[then])
    return settle(costs)


def walk(rows: list[tuple[str, int | None]], state: int, end: list[int]) -> tuple[list[tuple[str, int, int]], int, int]:
    """Edits (letter, row or -1, state after it), the state behind the rows, and the cost from ``state``; ``end``: costs behind the rows."""
    step = isqrt(len(rows)) + 1
    marks, costs = {}, end
    for k in range(len(rows) - 1, -1, -1):
        if (k + 1) % step == 0 or k == len(rows) - 1:
            marks[k // step] = costs  # behind the block's last row
        costs = back(*rows[k], costs)
    total, edits = costs[state], []
    for block in range(-(-len(rows) // step)):
        part = rows[block * step : (block + 1) * step]
        vectors = [marks[block]]
        for row in reversed(part):
            vectors.append(back(*row, vectors[-1]))
        vectors.reverse()
        k = 0
        while k < len(part):
            initial, fault = part[k]
            now, after = vectors[k][state], vectors[k + 1]
            if now == DELETE + after[state]:
                edits.append(("D", block * step + k, state))
                k += 1
            elif now == INSERT + vectors[k][NEXT[state]]:
                state = NEXT[state]
                edits.append(("I", -1, state))
            else:
                then = KEEP.get(initial, {}).get(state)
                kept = then is not None and now == fault + after[then]
                state = then if kept else NEXT[state]
                edits.append(("K" if kept else "R", block * step + k, state))
                k += 1
    return edits, state, total


def closing(state: int) -> list[tuple[str, int, int]]:
    """Rows put in behind the last one."""
    edits = []
    while END[state]:
        state = NEXT[state]
        edits.append(("I", -1, state))
    return edits


def turns_of(edits: list[tuple[str, int, int]], roles: list[str], texts: list[str]) -> list[dict]:
    return [{"role": roles[k] if letter == "K" else ROLE[state], "text": texts[k] if k >= 0 else ""} for letter, k, state in edits if letter != "D"]


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def repair_rows(rows: list[tuple]) -> dict:
    """The report of one conversation from its (turn, role, text) in order."""
    turns = {t for t, _, _ in rows if t is not None}
    roles, texts = [r for _, r, _ in rows], [x for _, _, x in rows]
    seen, coded, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in zip(roles, texts):
        core = text.rstrip(SPACES)
        name = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
        seen.add((role, text))
        if name:
            counts[name] += 1
        coded.append((role[:1], None if name in ("blank", "duplicate") else TRUNCATED if name else 0))
    edits, state, cost = walk(coded, START, END) if rows else ([], START, 0)
    edits += closing(state)
    return counts | {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, "illegal": illegal_pairs([c for c, _ in coded]), "cost": cost,
        "audit": "".join(e[0] for e in edits), "repaired": turns_of(edits, roles, texts)}


# ------------------------------------------------------------------ damage (the contract's test bed)

def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, there): rows damaged by crc32(conv_id:turn) % 20; a dropped row stays as one that is not there."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = conversations.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), text.alias("text"),
                                (kind != 0).alias("there"), F.when(kind == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times")


# ------------------------------------------------------------------ conversations that fit a task

def _schema(df: DataFrame) -> T.StructType:
    return T.StructType([df.schema["conv_id"], *_OUT.fields])


def _whole(rows: DataFrame) -> DataFrame:
    """Reports of conversations whose rows fit a task."""
    schema = _schema(rows)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, out, held, now = to_arrow_schema(schema), [], 0, None
        kept: list[tuple] = []
        for batch in batches:
            for conv, turn, role, text, there in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "there"))):
                if now is not None and now[0] != conv:
                    out.append({"conv_id": now[0]} | repair_rows(kept))
                    held += sum(len(x[2]) for x in kept) + 100
                    kept = []
                now = (conv,)
                if there:
                    kept.append((turn, role, text))
                if held > 4_000_000:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out, held = [], 0
        if now is not None:
            out.append({"conv_id": now[0]} | repair_rows(kept))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(each, schema)


# ------------------------------------------------------------------ longer conversations, in blocks

def _coded(rows: DataFrame) -> DataFrame:
    """Rows of long conversations with their place, initial and fault, sorted by range and written."""
    first = Window.partitionBy("conv_id", "role", F.sha2("text", 256)).orderBy("turn")
    core = F.rtrim(F.translate("text", SPACES, " " * 6))
    fault = F.when(core == "", "blank").when(F.row_number().over(first) > 1, "duplicate").when(~core.rlike("[.!?]$"), "truncated").otherwise("")
    order = ["conv_id", "turn", "role", "text"]
    ranged = rows.where("there").withColumn("fault", fault).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.select("conv_id", F.monotonically_increasing_id().alias("place"), F.substring("role", 1, 1).alias("initial"), "fault", "turn", "role", "text")
    return materialize(placed.withColumn("block", F.expr(f"place div {BLOCK}")), "turns")


def _surcharges(faults) -> list[int | None]:
    return [None if f in ("blank", "duplicate") else TRUNCATED if f else 0 for f in faults]


def _matrix(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("place")
    rows = list(zip(part["initial"], _surcharges(part["fault"])))
    columns = []
    for state in range(4):
        costs = [0 if q == state else FAR for q in range(4)]
        for row in reversed(rows):
            costs = back(*row, costs)
        columns.append(costs)
    inside = illegal_pairs(list(part["initial"]))
    return pd.DataFrame({"conv_id": part["conv_id"].iloc[:1], "block": part["block"].iloc[:1], "costs": [[columns[r][q] for q in range(4) for r in range(4)]],
                         "illegal": [inside], "head": [rows[0][0]], "tail": [rows[-1][0]]})


def _bounds(parts: pd.DataFrame) -> pd.DataFrame:
    """Costs behind each block of a conversation, and the pairs that meet at block bounds."""
    parts = parts.sort_values("block", ascending=False)
    after, ends, tails = END, [], []
    for costs in parts["costs"]:
        ends.append(list(after))
        after = [min(costs[4 * q + r] + after[r] for r in range(4)) for q in range(4)]
    heads = [None, *parts["head"]][:-1]
    tails = [h is not None and t + h not in ("su", "ua", "au") for t, h in zip(parts["tail"], heads)]
    return pd.DataFrame({"conv_id": parts["conv_id"], "block": parts["block"], "ends": ends, "illegal": parts["illegal"] + pd.Series(tails, parts.index).astype(int)})


def _exits(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("place")
    rows, end = list(zip(part["initial"], _surcharges(part["fault"]))), list(part["ends"].iloc[0])
    walked = [walk(rows, q, end) for q in range(4)]
    return pd.DataFrame({"conv_id": part["conv_id"].iloc[:1], "block": part["block"].iloc[:1], "exits": [[w[1] for w in walked]], "costs": [[w[2] for w in walked]]})


def _entries(parts: pd.DataFrame) -> pd.DataFrame:
    parts = parts.sort_values("block")
    state, entries = START, []
    for exits in parts["exits"]:
        entries.append(state)
        state = int(exits[state])
    return pd.DataFrame({"conv_id": parts["conv_id"], "block": parts["block"], "entry": entries, "cost": [parts["costs"].iloc[0][START]] * len(parts),
                         "last": [False] * (len(parts) - 1) + [True]})


def _piece(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("place")
    edits, state, _ = walk(list(zip(part["initial"], _surcharges(part["fault"]))), int(part["entry"].iloc[0]), list(part["ends"].iloc[0]))
    if part["last"].iloc[0]:
        edits += closing(state)
    return pd.DataFrame({"conv_id": part["conv_id"].iloc[:1], "block": part["block"].iloc[:1], "audit": ["".join(e[0] for e in edits)],
                         "repaired": [turns_of(edits, list(part["role"]), list(part["text"]))]})


def _with(left: DataFrame, right: DataFrame) -> DataFrame:
    """Equi-join on conversation (null equals null) and block."""
    right = right.withColumnsRenamed({"conv_id": "__conv", "block": "__block"})
    return left.join(right, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("block") == F.col("__block"))).drop("__conv", "__block")


def _blockwise(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(per conversation: counts and cost; per block: audit and repaired rows) of long conversations."""
    coded = _coded(rows)
    conv = f"conv_id {coded.schema['conv_id'].dataType.simpleString()}, block long, "
    light = coded.select("conv_id", "block", "place", "initial", "fault")
    matrices = light.groupBy("conv_id", "block").applyInPandas(_matrix, conv + "costs array<long>, illegal long, head string, tail string")
    bounds = materialize(matrices.groupBy("conv_id").applyInPandas(_bounds, conv + "ends array<long>, illegal long"), "bounds")
    exits = _with(light, bounds.drop("illegal")).groupBy("conv_id", "block").applyInPandas(_exits, conv + "exits array<int>, costs array<long>")
    entries = materialize(exits.groupBy("conv_id").applyInPandas(_entries, conv + "entry int, cost long, last boolean"), "entries")
    repaired = T.StructType([coded.schema["conv_id"], T.StructField("block", T.LongType()), *_OUT.fields[-2:]])
    pieces = _with(_with(coded, bounds.drop("illegal")), entries).groupBy("conv_id", "block").applyInPandas(_piece, repaired)
    turns = coded.where("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps")).withColumnRenamed("conv_id", "__conv")
    counts = coded.groupBy("conv_id").agg(*[F.count_if(F.col("fault") == c).alias(c) for c in ("blank", "duplicate", "truncated")])
    met = bounds.groupBy("conv_id").agg(F.sum("illegal").alias("illegal")).withColumnRenamed("conv_id", "__conv2")
    least = entries.groupBy("conv_id").agg(F.min("cost").alias("cost")).withColumnRenamed("conv_id", "__conv3")
    same = F.col("conv_id").eqNullSafe
    reports = counts.join(turns, same(F.col("__conv")), "left").join(met, same(F.col("__conv2"))).join(least, same(F.col("__conv3")))
    return reports.select("conv_id", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost"), pieces


def _digests(pieces: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) of conversations in pieces: each one's pieces pass through one task as a stream."""
    schema = T.StructType([pieces.schema["conv_id"], T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, now = to_arrow_schema(schema), None

        def done():
            return pa.RecordBatch.from_pylist([{"conv_id": now[0], "audit": "".join(now[1]), "repaired_sha256": now[2].hexdigest()}], schema=arrow)

        for batch in batches:
            for k in range(batch.num_rows):
                conv, audit, lines = (batch.column(c)[k].as_py() for c in ("conv_id", "audit", "lines"))
                if now is None or now[0] != conv:
                    if now is not None:
                        yield done()
                    now = [conv, [], hashlib.sha256(), False]
                now[1].append(audit)
                for line in lines:
                    now[2].update((b"\n" if now[3] else b"") + line.encode())
                    now[3] = True
        if now is not None:
            yield done()

    lined = pieces.select("conv_id", "block", "audit", _lines("repaired").alias("lines"))
    return lined.repartition("conv_id").sortWithinPartitions("conv_id", "block").drop("block").mapInArrow(each, schema)


# ------------------------------------------------------------------ operator

def _lines(column: str) -> Column:
    return F.transform(column, lambda t: F.concat(t["role"], F.lit(":"), t["text"]))


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows of conversations that fit a task, and those of longer ones (None if there are none)."""
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long = materialize(sizes.where((F.col("n") > LONG_ROWS) | (F.col("bytes") > LONG_BYTES)).select(F.col("conv_id").alias("__conv")), "long")
    if long.isEmpty():
        return rows, None
    same = F.col("conv_id").eqNullSafe(F.col("__conv"))  # a few ids: each has LONG_ROWS rows or LONG_BYTES bytes; Spark broadcasts them if small
    return rows.join(long, same, "left_anti"), rows.join(long, same, "left_semi")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, there): counts of faults, cost, audit and repaired_sha256."""
    short, long = _split(rows)
    sha = F.sha2(F.array_join(_lines("repaired"), "\n"), 256)
    reports = _whole(short).withColumn("repaired_sha256", sha).drop("repaired")
    if long is None:
        return reports
    counts, pieces = _blockwise(long)
    digests = _digests(pieces).withColumnRenamed("conv_id", "__conv")
    blockwise = counts.join(digests, F.col("conv_id").eqNullSafe(F.col("__conv"))).select(*reports.columns)
    found = reports.unionByName(blockwise)
    # A long conversation whose rows were all dropped has no block.
    gone = long.groupBy("conv_id").agg(F.max("there").alias("any")).where("NOT any").select(
        "conv_id", *[F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.lit("").alias("audit"), F.sha2(F.lit("").cast("binary"), 256).alias("repaired_sha256"))
    return found.unionByName(gone)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, block, place, role, text), in the order of block and place."""
    short, long = _split(rows)
    pieces = _whole(short).select("conv_id", F.lit(0).cast("long").alias("block"), "repaired")
    if long is not None:
        pieces = pieces.unionByName(_blockwise(long)[1].select("conv_id", "block", "repaired"))
    return pieces.select("conv_id", "block", F.posexplode("repaired").alias("place", "turn")).select("conv_id", "block", "place", "turn.role", "turn.text")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))


# ------------------------------------------------------------------ SQL

def crc32_sql(key: str) -> str:
    """DuckDB expression: crc32 of a string of ASCII and U+00C0-U+00FF characters, bit by bit."""
    codes = f"flatten([CASE WHEN ord(x) < 128 THEN [ord(x)] ELSE [195, ord(x) - 64] END FOR x IN string_split({key}, '')])"
    bits = f"flatten([[(b >> k) & 1 FOR k IN [0, 1, 2, 3, 4, 5, 6, 7]] FOR b IN {codes}])"
    return f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || {bits}, lambda c, b: xor(c >> 1, ((c & 1) + b) % 2 * 3988292384)), 4294967295)"


def _least(options: list[str]) -> str:
    return "list_min([x FOR x IN [" + ", ".join(options) + "] IF x IS NOT NULL])"


def _oracle() -> str:
    """The dynamic program as a recursive query: per conversation and row, backwards, the least (cost, edits, rows) of each state.

    A row that is put in is an edit of its own, so each step settles the four states before it goes on.
    """
    keep = {0: [("s", 1), ("u", 2)], 1: [("u", 2)], 2: [("a", 3)], 3: [("u", 2)]}
    name = {2: "user", 3: "assistant"}

    def put(letter, cost, then, line=None, of="w"):
        rest = f"{of}{then}.l"
        return f"{{'c': {of}{then}.c + {cost}, 'e': '{letter}' || {of}{then}.e, 'l': {rest if line is None else f'[{line}] || {rest}'}}}"

    rows = []
    for q in range(4):
        options = [put("D", DELETE, q), f"CASE WHEN NOT gone THEN {put('R', f'{REROLE} + t', NEXT[q], f"'{name[NEXT[q]]}:' || text")} END"]
        options += [f"CASE WHEN NOT gone AND initial = '{i}' THEN {put('K', 't', then, "role || ':' || text")} END" for i, then in keep[q]]
        rows.append(f"{_least(options)} AS w{q}")
    settle_sql = ["w0", "w1", "w2", "w3"]
    rounds = []
    for k in range(3):
        rounds.append(", ".join(f"least(w{q}, {put('I', INSERT, NEXT[q], f"'{name[NEXT[q]]}:'")}) AS w{q}" for q in range(4)))
    return f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
kinds AS (SELECT k, {crc32_sql('k')} % 20 AS kind FROM (SELECT DISTINCT k FROM keyed)),
harmed AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(generate_series(1, CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed JOIN kinds USING (k) WHERE kind <> 0),
ranked AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again, count(*) OVER (PARTITION BY conv_id) AS n,
         regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS core
  FROM harmed),
faults AS (
  SELECT conv_id, turn, role, text, i, n, left(role, 1) AS initial,
         CASE WHEN core = '' THEN 'b' WHEN again > 1 THEN 'd' WHEN NOT regexp_matches(core, '[.!?]$') THEN 't' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM ranked),
lined AS (SELECT *, fault IN ('b', 'd') AS gone, CASE WHEN fault = 't' THEN 1 ELSE 0 END AS t FROM faults),
ends AS (
  SELECT DISTINCT conv_id, n AS i, {{'c': 0, 'e': '', 'l': CAST([] AS VARCHAR[])}} AS w0, {{'c': {END[1]}, 'e': 'II', 'l': ['user:', 'assistant:']}} AS w1,
         {{'c': {END[2]}, 'e': 'I', 'l': ['assistant:']}} AS w2, {{'c': 0, 'e': '', 'l': CAST([] AS VARCHAR[])}} AS w3
  FROM lined),
steps AS (
  SELECT conv_id, i, w0, w1, w2, w3 FROM ends
  UNION ALL
  SELECT conv_id, i, {rounds[0]} FROM (SELECT conv_id, i, {rounds[1]} FROM (SELECT conv_id, i, {rounds[2]} FROM (
    SELECT s.conv_id AS conv_id, s.i - 1 AS i, {', '.join(rows)}
    FROM steps s JOIN lined r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i)))),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM lined GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(w0.c, 0) AS BIGINT) AS cost, coalesce(w0.e, '') AS audit, sha256(coalesce(array_to_string(w0.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN steps s ON s.conv_id IS NOT DISTINCT FROM o.conv_id AND s.i = 0
"""


ORACLE = _oracle()
