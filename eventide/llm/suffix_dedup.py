"""Removal of byte strings that occur more than once, by a distributed merge sort of suffixes.

Every string of ``length`` bytes is owned by an anchor: the place of the least
hash among its substrings of ``CORE`` bytes (the first one at a tie). Equal
strings have equal anchors at equal distance, so only suffixes at anchors are
sorted, about one in a hundred bytes. A unit is an anchor with the run of
strings that it owns, which is one piece of text.

1. Spark counts units by content. Units that occur twice are repeated as a
   whole; units whose core no other content shares are not repeated.
2. The contents left are exchanged as sorted runs: each task sorts its units by
   the text from the anchor on and front-codes them, one run for each group of
   cores. A group's runs are merged by a loser tree (``suffix_runs``), which
   gives the common prefix of neighbours without comparing a known one again.
   With the common text before the anchors that tells for every owned string
   whether another unit has it.
3. The repeated strings of all units go back to their documents, where the
   covered bytes are removed.

A content is exchanged once, however many copies it has. A core with more than
``HOT`` contents is not gathered in one group: its units are cut into single
strings, which Spark counts by a 128-bit hash with partial sums in each task.

Null texts count as empty; texts shorter than ``length`` have no such string.
Matches never cross documents. Repeated rows are copies of each other, also
with one doc_id. Further columns are kept; one with the name of a new column is
replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from eventide.llm.common import SMALL_SLICE, RollingHash, materialize, mix, slices, table, utf8
from eventide.llm.suffix_runs import Run, common_suffix, merge

LENGTH = 400
#: Share of a string that its core takes.
CORE_SHARE = 0.4
#: Contents of one core that are still gathered in one group.
HOT = 20_000
#: Occurrences of a string of hot cores that are still joined in one task.
OFTEN = 10_000
#: Units that one group of cores is to have about, and bytes of keys that a task holds before it writes its runs.
GROUP_UNITS, RUN_BYTES = 20_000, 24_000_000
#: Most array entries (of up to 48 bytes) and most ids (16 bytes) that are broadcast to texts.
BROADCAST_ENTRIES, BROADCAST_IDS = 200_000, 1_000_000


def units(buf: np.ndarray, off: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Units of all texts: text, anchor, first and last string start (places in ``buf``), hash of core and of content."""
    core = int(length * CORE_SHARE)
    w = length - core + 1
    empty = np.zeros(0, np.int64)
    if len(buf) < length:
        return {"of": empty, "anchor": empty, "p1": empty, "p2": empty, "ch": empty.view(np.uint64), "uh": empty.view(np.uint64)}
    rolling = RollingHash(buf, seed=5)
    starts = np.arange(len(buf) - core + 1)
    key = (rolling.of(starts, starts + core) & np.uint64(0xFFFFFFFF00000000)) | starts.astype(np.uint64)
    n = len(key)
    padded = np.full(-(-n // w) * w, np.uint64(2**64 - 1))
    padded[:n] = key
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    p = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(off[:-1], off[1:]) if b - a >= length] or [empty])
    if not len(p):
        return {"of": empty, "anchor": empty, "p1": empty, "p2": empty, "ch": empty.view(np.uint64), "uh": empty.view(np.uint64)}
    anchor = (np.minimum(right[p], left[p + w - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (p[1:] != p[:-1] + 1)]))
    p1, p2, a = p[edge], p[np.concatenate([edge[1:], [len(p)]]) - 1], anchor[edge]
    return {
        "of": np.searchsorted(off, p1, side="right") - 1, "anchor": a, "p1": p1, "p2": p2, "ch": rolling.of(a, a + core),
        "uh": mix(rolling.of(p1, p2 + length) + mix((a - p1).astype(np.uint64) + np.uint64(1))),
    }


def _unit_table(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, th, a, lo, hi, ch, uh): a is the anchor in the text, lo and hi the least and largest distance of it from an owned string's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", SMALL_SLICE):
                buf, off = utf8(b.column("text"))
                u = units(buf, off, length)
                of = pa.array(u["of"])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(of), b.column("th").take(of), pa.array((u["anchor"] - off[u["of"]]).astype(np.int32)),
                     pa.array((u["anchor"] - u["p2"]).astype(np.int32)), pa.array((u["anchor"] - u["p1"]).astype(np.int32)),
                     pa.array(u["ch"].view(np.int64)), pa.array(u["uh"].view(np.int64))], names=["doc_id", "th", "a", "lo", "hi", "ch", "uh"])

    return docs.mapInArrow(run, "doc_id bigint, th bigint, a int, lo int, hi int, ch bigint, uh bigint")


def _same_row(x: str, y: str):
    return F.col(f"{x}.doc_id").eqNullSafe(F.col(f"{y}.doc_id")) & (F.col(f"{x}.th") == F.col(f"{y}.th"))


def _near_texts(docs: DataFrame, rows: DataFrame, column: str, how: str = "inner") -> DataFrame:
    """``docs`` with the array ``column`` of ``rows`` (doc_id, th, column), which has one row per text.

    Small arrays are broadcast, after a check of their entries. Larger ones are
    joined by a shuffle, of the texts that have a row if their ids are few
    enough to be broadcast, else of all texts.
    """
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size(column)), F.lit(0)).alias("entries")).first()

    def joined(d: DataFrame, r: DataFrame, kind: str) -> DataFrame:
        return d.alias("d").join(r.alias("r"), _same_row("d", "r"), kind).select("d.*", f"r.{column}")

    if size["entries"] <= BROADCAST_ENTRIES and size["n"] <= BROADCAST_ENTRIES:
        return joined(docs, F.broadcast(rows), how)
    if size["n"] > BROADCAST_IDS:
        return joined(docs, rows, how)
    ids = F.broadcast(rows.select("doc_id", "th")).alias("r")
    inside = joined(docs.alias("d").join(ids, _same_row("d", "r"), "left_semi"), rows, "inner")
    if how == "inner":
        return inside
    outside = docs.alias("d").join(ids, _same_row("d", "r"), "left_anti")
    return inside.unionByName(outside.withColumn(column, F.lit(None).cast(rows.schema[column].dataType)))


_RUN = "r int, n int, shared binary, lengths binary, rests binary, lshared binary, llengths binary, lrests binary, lo binary, hi binary, ch binary, uh binary"


def _runs(texts: DataFrame, length: int, groups: int) -> DataFrame:
    """Sorted front-coded runs of the units listed with each text, without those of hot cores."""
    columns = [c.split()[0] for c in _RUN.split(", ")]

    def flush(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for r, entries in held.items():
            entries.sort(key=lambda e: (e[0], e[1]))
            right, left = Run([e[0] for e in entries]), Run([e[1][::-1] for e in entries])
            ints = [np.array([e[k] for e in entries], kind).tobytes() for k, kind in ((2, "<i4"), (3, "<i4"), (4, "<i8"), (5, "<i8"))]
            row = [r, len(entries), *right.pack(), *left.pack(), *ints]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int32() if k < 2 else pa.binary()) for k, v in enumerate(row)], names=columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0
        for batch in batches:
            for text, listed in zip(batch.column("text"), batch.column("units").to_pylist()):
                data = text.as_py().encode()
                for u in listed:
                    a, lo, hi, ch, uh = u["a"], u["lo"], u["hi"], u["ch"], u["uh"]
                    if u["hot"]:
                        continue
                    entry = (data[a : a - lo + length], data[a - hi : a], lo, hi, ch, uh)
                    held.setdefault(ch % groups, []).append(entry)
                    size += len(entry[0]) + hi
                    if size > RUN_BYTES:
                        yield from flush(held)
                        held, size = {}, 0
        yield from flush(held)

    return texts.select("text", "units").mapInArrow(run, _RUN)


def _hot_marks(texts: DataFrame, length: int, often: int = OFTEN) -> DataFrame:
    """(ch, uh, low, high) of the repeated strings in units of hot cores.

    The strings that very many units have are broadcast: with over
    ``often`` occurrences each, and at least one in BROADCAST_ENTRIES of all,
    there are fewer than BROADCAST_ENTRIES of them. The others are joined by a
    shuffle, in which none has more rows than that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, listed in zip(batch.column("text"), batch.column("units").to_pylist()):
                data = text.as_py().encode()
                for u in listed:
                    d = np.arange(u["lo"], u["hi"] + 1, dtype=np.int32)
                    digests = b"".join(hashlib.blake2b(data[x : x + length], digest_size=16).digest() for x in (u["a"] - d).tolist())
                    h = np.frombuffer(digests, "<i8").reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(d), pa.array(np.full(len(d), u["ch"], np.int64)), pa.array(np.full(len(d), u["uh"], np.int64))],
                        names=["h1", "h2", "d", "ch", "uh"])

    hot = texts.select("text", F.filter("units", lambda u: u["hot"]).alias("units")).where(F.size("units") > 0)
    strings = hot.mapInArrow(run, "h1 bigint, h2 bigint, d int, ch bigint, uh bigint")
    counts = materialize(strings.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1"), "strings")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    most = max(often, int(total) // BROADCAST_ENTRIES)
    many, few = F.broadcast(counts.where(F.col("n") > most).select("h1", "h2")), counts.where(F.col("n") <= most).select("h1", "h2")
    found = strings.join(many, ["h1", "h2"], "left_semi").unionByName(strings.join(many, ["h1", "h2"], "left_anti").join(few, ["h1", "h2"], "left_semi"))
    return found.select("ch", "uh", F.col("d").alias("low"), F.col("d").alias("high"))


def repeated(block: list[tuple], length: int, core: int) -> list[list[tuple[int, int]]]:
    """For each entry (shared, right, left, lo, hi) of one core, in order of ``right``: the distances whose string another entry has too."""
    n = len(block)
    out: list[list[tuple[int, int]]] = [[] for _ in block]
    if n <= 48:
        for i in range(n):
            common = length
            for j in range(i + 1, n):
                common = min(common, block[j][0])
                if common < core:
                    break
                x, y = block[i], block[j]
                low = max(length - common, x[3], y[3])
                high = min(x[4], y[4])
                if low <= high:
                    high = min(high, common_suffix(x[2], y[2]))
                    if low <= high:
                        out[i].append((low, high))
                        out[j].append((low, high))
        return out
    shared = np.array([e[0] for e in block])
    lo, hi = np.array([e[3] for e in block]), np.array([e[4] for e in block])
    widest = int(hi.max())
    tails = np.zeros((n, widest), np.uint8)  # the text before the anchor, backwards
    for i, e in enumerate(block):
        tails[i, : len(e[2])] = np.frombuffer(e[2][::-1], np.uint8)
    h = np.zeros(n, np.uint64)
    for d in range(widest + 1):
        if d:
            h = mix(h + tails[:, d - 1].astype(np.uint64) + np.uint64(257))
        at = np.flatnonzero((lo <= d) & (d <= hi))
        if len(at) < 2:
            continue
        group = np.cumsum(shared < length - d)
        _, inverse, count = np.unique(mix(h[at] + mix(group[at].astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
        for i in at[count[inverse] > 1].tolist():
            if out[i] and out[i][-1][1] == d - 1:
                out[i][-1] = (out[i][-1][0], d)
            else:
                out[i].append((d, d))
    return out


def _merged(runs: DataFrame, length: int) -> DataFrame:
    """(ch, uh, low, high) of the repeated strings of the exchanged contents."""
    core = int(length * CORE_SHARE)
    schema = pa.schema([("ch", pa.int64()), ("uh", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        ints = [{c: np.frombuffer(x[c], kind) for c, kind in (("lo", "<i4"), ("hi", "<i4"), ("ch", "<i8"), ("uh", "<i8"))} for x in rows]
        lefts = [Run.read(x["lshared"], x["llengths"], x["lrests"]) for x in rows]
        at = [0] * len(rows)
        found: list[tuple[int, int, int, int]] = []
        block: list[tuple] = []

        def close() -> None:
            if len(block) > 1:
                for e, spans in zip(block, repeated(block, length, core)):
                    found.extend((e[5], e[6], low, high) for low, high in spans)
            block.clear()

        for k, shared, right in merge([Run.read(x["shared"], x["lengths"], x["rests"]) for x in rows]):
            if shared < core:
                close()
            i, own = at[k], ints[k]
            at[k] += 1
            block.append((shared, right, next(lefts[k])[1][::-1], int(own["lo"][i]), int(own["hi"][i]), int(own["ch"][i]), int(own["uh"][i])))
        close()
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)] if found else [pa.array([], f.type) for f in schema], schema=schema)

    return runs.groupBy("r").applyInArrow(run, "ch bigint, uh bigint, low int, high int")


def _union(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(zip(starts, ends)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """Columns of ``docs`` plus n_bytes, n_removed, n_spans, kept_sha256 and kept_text (without characters that an edge cuts)."""
    new = [StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType()),
           StructField("kept_sha256", StringType()), StructField("kept_text", StringType())]
    docs = docs.select(*[c for c in docs.columns if c not in {f.name for f in new} | {"th", "spans"}]).withColumn("th", F.xxhash64(F.coalesce("text", F.lit(""))))
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "th")
    all_units = materialize(_unit_table(slim, length), "units")
    contents = materialize(
        all_units.groupBy("ch", "uh").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "a", "lo", "hi")).alias("u")), "contents")
    shared = contents.groupBy("ch").agg(F.count("*").alias("m")).where("m > 1").withColumn("hot", F.col("m") > hot).select("ch", "hot")
    asked = materialize(
        contents.join(shared, "ch").groupBy("u.doc_id", "u.th")
        .agg(F.collect_list(F.struct("u.a", "u.lo", "u.hi", "ch", "uh", "hot")).alias("units")), "asked")  # at most the units of a text
    n, n_hot = asked.agg(F.coalesce(F.sum(F.size("units")), F.lit(0)), F.coalesce(F.sum(F.size(F.filter("units", lambda u: u["hot"]))), F.lit(0))).first()
    groups = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(n) // GROUP_UNITS)
    texts = _near_texts(slim, asked, "units")  # a repeated row sends its units again, which the distinct() below takes away
    part = _merged(_runs(texts, length, groups), length)
    if n_hot:
        part = part.unionByName(_hot_marks(texts, length))
    part = part.distinct()
    whole = contents.where("n > 1").select("ch", "uh", F.col("u.lo").alias("low"), F.col("u.hi").alias("high"))
    marks = materialize(part.unionByName(whole), "marks")
    spans = (
        all_units.join(marks, ["ch", "uh"]).groupBy("doc_id", "th")
        .agg(F.collect_set(F.struct((F.col("a") - F.col("high")).alias("s"), (F.col("a") - F.col("low") + length).alias("e"))).alias("spans"))  # at most the units of a text
    )
    spans = materialize(spans, "spans")
    joined = _near_texts(docs, spans, "spans", "left").drop("th")
    names = [c for c in joined.columns if c != "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", 2_000_000):
                sizes, removed, counts, digests, kept = [], [], [], [], []
                for text, found in zip(b.column("text"), b.column("spans").to_pylist()):
                    data = (text.as_py() or "").encode()
                    cuts = _union([x["s"] for x in found], [x["e"] for x in found]) if found else []
                    stay = b"".join(data[a:z] for a, z in zip([0, *(e for _, e in cuts)], [*(s for s, _ in cuts), len(data)])) if cuts else data
                    sizes.append(len(data))
                    removed.append(len(data) - len(stay))
                    counts.append(len(cuts))
                    digests.append(hashlib.sha256(stay).hexdigest())
                    kept.append(stay.decode("utf-8", "ignore"))
                arrays = [pa.array(v, t) for v, t in ((sizes, pa.int64()), (removed, pa.int64()), (counts, pa.int64()), (digests, pa.string()), (kept, pa.string()))]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *arrays], names=[*names, *(f.name for f in new)])

    return joined.mapInArrow(run, StructType([*joined.drop("spans").schema.fields, *new]))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
