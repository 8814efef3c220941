"""N-gram Jaccard join by PartEnum signatures.

Sets of word shingles are put into bands of equal size (each band's largest size
is ``BAND`` times its smallest). Two sets of sizes up to r with Jaccard
similarity of at least num/den differ in at most k = floor(2 r (den - num) /
(den + num)) shingles. A band deals the feature domain (shingle hashes) into n1
first-level partitions, so that two such sets differ in at most k2 = floor(k /
n1) shingles of some partition; that one is dealt into n2 second-level
partitions, and a signature is made of every subset of n2 - k2 of them, one of
which both sets have in common. A set makes the signatures of its own band, and
of the next one if a partner can be that large. So all similar pairs share a
signature, and ``spare`` more of them, a number of the band that every signature
holds. The pairs found are checked against the whole sets.

Equal sets are one class from the start. A bucket of up to ``CROWD`` members is
written out as pairs. Larger ones come from passages that many texts share: a
member with no more than ``spare`` signatures in such buckets leaves them, as it
meets each similar set in a small bucket too. Of the members that stay, pairs
are not written out: each bucket compares them with its hub, the most
connected one (most companions over all its buckets). Two members that are
similar to the hub are in one component; other similar members must differ from
the hub in the same shingles, so a prefix-filtered join of these differences
finds all of them (see ``_differences``).

Pairs are first held against sketches: one bit for each of as many cells as a
set has shingles, set if an odd number of them fall into it. Every shingle in
which two sets differ changes one bit, so sets whose sketches differ in more
bits than the sets may differ in shingles are not similar. What is left is
checked against the whole sets.

Texts with fewer words than a shingle are one shingle; those without words (or
null) have an empty set and link with nothing. Repeated rows, also of one
doc_id, are rows of the same class. Rows with a null doc_id link with nothing and
have a null component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import SMALL_SLICE, RollingHash, lower_ascii, materialize, mix, slices, table, utf8, words
from eventide.llm.components import components

#: Largest size of a band over its smallest.
BAND = 1.5
#: Bands up to this size enumerate pairs of three second-level partitions; larger ones single halves.
SMALL_BAND = 200
#: How often the domain is dealt anew for sets with many empty partitions.
SEEDS = 8
#: Most signatures (below 16) that a similar pair shares beyond the first.
SPARE = 15
#: Most members of a bucket that is written out as pairs.
CROWD = 32
#: Most ids that are broadcast to pick the texts of candidates; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, text after text, and their number per text."""
    buf, off = utf8(texts)
    starts, ends, of = words(buf, off)
    count = np.bincount(of, minlength=len(off) - 1)
    h = RollingHash(lower_ascii(buf)).of(starts, ends)
    first = np.concatenate([[0], np.cumsum(count)])
    last = max(0, len(h) - n + 1)
    gram = np.full(last, n, np.uint64)
    for k in range(n):
        gram = mix(gram * _GOLD + h[k : k + last])
    whole = of[:last] == of[n - 1 : n - 1 + last]
    gram, owner = gram[whole], of[:last][whole]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        few = np.array([_fold(h[first[i] : first[i + 1]]) for i in short], np.uint64)
        gram, owner = np.concatenate([gram, few]), np.concatenate([owner, short])
    _, at = np.unique(mix(gram + mix(owner.astype(np.uint64) + np.uint64(1))), return_index=True)
    at = at[np.lexsort((at, owner[at]))]
    return gram[at], np.bincount(owner[at], minlength=len(count))


def _fold(h: np.ndarray) -> int:
    out = np.full(1, len(h), np.uint64)
    for x in h:
        out = mix(out * _GOLD + x)
    return int(out[0])


class PartEnum:
    """Signatures for Jaccard similarity of at least num / den."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        tops, r = [], 1
        while r < 1 << 40:
            tops.append(r)
            r = max(r + 1, int(r * BAND))
        self.tops = np.array(tops, np.int64)

    def _most(self, sizes: int) -> int:
        """Most shingles in which two similar sets of together ``sizes`` shingles differ."""
        return sizes * (self.den - self.num) // (self.den + self.num)

    def signatures(self, grams: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Distinct signatures of each set (given one after another)."""
        out, ends = [], np.cumsum(sizes).tolist()
        for size, end in zip(sizes.tolist(), ends):
            parts = []
            if size:
                band = int(np.searchsorted(self.tops, size))
                parts += self._of_band(grams[end - size : end], band)
                # partners in a later band have more than the top of the band before
                while size * self.den >= (int(self.tops[band]) + 1) * self.num:
                    band += 1
                    parts += self._of_band(grams[end - size : end], band)
            out.append(np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64))
        return out

    def _of_band(self, g: np.ndarray, band: int) -> list[np.ndarray]:
        top = int(self.tops[band])
        k = self._most(2 * top)
        if k == 0:
            return []  # similar sets of this band are equal
        own = self._most(len(g) + min(top, len(g) * self.den // self.num))
        if own == 0:
            return []
        spare = min(SPARE, 1 + k // 32)
        n1, n2 = -(-(k + 1) // 2) + 1 + k // 40 + spare, 3 if top <= SMALL_BAND else 2  # k2 = 1: differences spoil at most k // 2 partitions
        usual = top / (n1 * n2) * (n2 - 1)  # shingles behind a signature
        least = 3 if usual >= 8 else 2 if usual >= 6 else 1
        out = []
        for seed in range(SEEDS):
            base = np.uint64(((band << 4) + seed + 1) << 8)
            cell = (mix(g + base) >> np.uint64(11)) % np.uint64(n1 * n2)
            order = np.argsort(cell)
            cell, value = cell[order], mix(g ^ _GOLD)[order]
            edge = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            sums = np.zeros(n1 * n2, np.uint64)
            sums[cell[edge]] = np.add.reduceat(value, edge)
            sums = sums.reshape(n1, n2)
            held = np.bincount(cell.astype(np.int64), minlength=n1 * n2).reshape(n1, n2)
            place = mix((np.arange(n1, dtype=np.uint64) + np.uint64(1)) * _GOLD + base)
            full, made = np.ones(n1, bool), []
            for j, subset in enumerate([(0, 1), (0, 2), (1, 2)] if n2 == 3 else [(0,), (1,)]):
                s = place + np.uint64(j + 1)
                for c in subset:
                    s = mix(s * _GOLD + sums[:, c])
                filled = held[:, subset].sum(axis=1) >= least
                full &= filled
                made.append((s, filled))
            # Partitions with few shingles are alike in many sets, so they make no signature. Differences spoil at most own // 2 full
            # partitions, so a set may end at its full partition number own // 2 + 1 + spare: of a similar pair, the set that ends first
            # shares signatures in spare + 1 partitions at least, all of which the other set has too. A set with fewer full partitions
            # deals the domain again with the next seed.
            enough = np.flatnonzero(np.cumsum(full) == own // 2 + 1 + spare)[:1] + 1
            end = int(enough[0]) if len(enough) else n1
            out += [_noted(s[:end][filled[:end]], spare) for s, filled in made]
            if len(enough):
                return out
        return [*out, _noted(mix(base + np.arange(spare + 1, dtype=np.uint64)), spare)]


def _noted(signatures: np.ndarray, spare: int) -> np.ndarray:
    """Signatures with ``spare`` in their last four bits."""
    return signatures & np.uint64(2**64 - 16) | np.uint64(spare)


def _set_hash(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums, filled = np.zeros(len(sizes), np.uint64), sizes > 0
    if filled.any():
        sums[filled] = np.add.reduceat(mix(grams + _GOLD), np.concatenate([[0], np.cumsum(sizes)[:-1]])[filled])
    return mix(sums + sizes.astype(np.uint64)).view(np.int64)


def _lists(values: list[np.ndarray] | np.ndarray, sizes: np.ndarray) -> pa.Array:
    flat = (np.concatenate(values) if len(values) else np.zeros(0, np.uint64)) if isinstance(values, list) else values
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat.view(np.int64)))


def _sketches(grams: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """For each set as many bits as it has shingles (as a power of two, 64 at least): the parities of its shingles by hash."""
    cells, out = mix(grams ^ np.uint64(0x5851F42D4C957F2D)), []
    for size, end in zip(sizes.tolist(), np.cumsum(sizes).tolist()):
        bits = max(64, 1 << max(0, size - 1).bit_length())
        held = np.bincount((cells[end - size : end] & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
        out.append(np.packbits((held & 1).astype(np.uint8)).tobytes())
    return out


def _apart(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the length of the shorter: at most the shingles in which the sets differ."""
    a, b = (x, y) if len(x) <= len(y) else (y, x)
    bits, v = 8 * len(b), int.from_bytes(b, "big")
    while bits > 8 * len(a):
        bits //= 2
        v = (v >> bits) ^ (v & ((1 << bits) - 1))
    return (v ^ int.from_bytes(a, "big")).bit_count()


def _described(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, cid, n, sketch) of every row; cid is a hash of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", SMALL_SLICE):
                grams, sizes = shingle_sets(b.column("text"), n)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").cast(pa.int64()), pa.array(_set_hash(grams, sizes)), pa.array(sizes), pa.array(_sketches(grams, sizes), pa.binary())],
                    names=["doc_id", "cid", "n", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, cid bigint, n bigint, sketch binary")


def _signed(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(cid, n, sig): the signatures of every row that has a doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enum = PartEnum(num, den)
        for batch in batches:
            for b in slices(batch, "text", SMALL_SLICE):
                grams, sizes = shingle_sets(b.column("text"), n)
                sigs = enum.signatures(grams, sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_set_hash(grams, sizes)), pa.array(sizes), _lists(sigs, [len(s) for s in sigs])], names=["cid", "n", "sigs"])

    found = docs.where("doc_id IS NOT NULL").select("text").mapInArrow(run, "cid bigint, n bigint, sigs array<bigint>")
    return found.select("cid", "n", F.explode("sigs").alias("sig"))


def _sets(docs: DataFrame, n: int, wanted: DataFrame) -> DataFrame:
    """(cid, grams) of the classes ``wanted`` (node, cid), from the texts of their nodes."""
    ids = wanted.select(F.col("node").alias("doc_id"), F.col("cid").alias("own"))
    picked = docs.select("doc_id", "text").join(F.broadcast(ids) if wanted.count() <= BROADCAST_IDS else ids, "doc_id").select("text", "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", SMALL_SLICE):
                grams, sizes = shingle_sets(b.column("text"), n)
                cid = pa.array(_set_hash(grams, sizes))
                same = pa.compute.equal(cid, b.column("own"))  # another row of that doc_id may have another text
                yield pa.RecordBatch.from_arrays([cid, _lists(grams, sizes)], names=["cid", "grams"]).filter(same)

    return picked.mapInArrow(run, "cid bigint, grams array<bigint>")


def jaccard_components(docs: DataFrame, n: int = 3, num: int = 9, den: int = 10) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``: linked at similarity of at least num / den."""
    rows = materialize(_described(docs, n), "sets")
    # a class is a set; its node is its smallest doc_id
    classes = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("cid", "n").agg(F.min("doc_id").alias("node"))
    sig = Window.partitionBy("sig")
    entries = _signed(docs, n, num, den).select("sig", "cid", "n", *[f(c).over(sig).alias(f"{k}_{c}") for c in ("cid", "n") for k, f in (("least", F.min), ("most", F.max))])
    shared = entries.where("least_cid <> most_cid OR least_n <> most_n").select("sig", "cid", "n").distinct()  # not those that only copies of one set have
    met = shared.withColumn("m", F.count("*").over(sig))
    bucket = materialize(met.join(classes, ["cid", "n"]).select("sig", "m", "node", "n", "cid"), "buckets")
    members = bucket.select(F.col("node").alias("doc_id"), "cid").distinct()
    sketches = materialize(rows.join(members, ["doc_id", "cid"]).select(F.col("doc_id").alias("node"), "cid", "sketch").distinct(), "sketches")
    near = _verified(docs, n, num, den, materialize(_likely(_paired(bucket.where(F.col("m") <= CROWD), num, den), sketches, num, den), "near"))
    near = materialize(near, "links")

    crowded = bucket.where(F.col("m") > CROWD)
    held = crowded.groupBy("node").agg(F.count("*").alias("c"), F.min(F.col("sig").bitwiseAND(15)).alias("spare")).where("c > spare").select("node")
    stay = materialize(crowded.join(held, "node"), "crowded")
    central = stay.groupBy("node").agg(F.sum("m").alias("central"))
    ranked = stay.join(central, "node")
    hubs = ranked.groupBy("sig").agg(F.max(F.struct("central", F.negative("node").alias("k"), "node", "n", "cid")).alias("hub"))
    stars = ranked.join(hubs, "sig").where("node <> hub.node").select(
        F.col("node").alias("a"), F.col("n").alias("na"), F.col("cid").alias("ca"), F.col("hub.node").alias("b"), F.col("hub.n").alias("nb"), F.col("hub.cid").alias("cb"))
    told = materialize(_differences(docs, n, num, den, materialize(stars.distinct(), "stars")), "differences")
    first = near.unionByName(told.where("linked").select("a", "b"))
    comp = materialize(components(first), "components")
    rest = materialize(_verified(docs, n, num, den, materialize(_likely(_met(told, comp, num, den), sketches, num, den), "pairs")), "links")
    known = components(first.unionByName(rest))

    named = classes.join(known, "node", "left").select("cid", "n", F.coalesce("comp", "node").alias("component_id"))
    return (
        rows.select("doc_id", "cid", "n").join(named, ["cid", "n"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    )


def _paired(buckets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, na, ca, b, nb, cb) of members of one bucket."""
    x, y = buckets.alias("x"), buckets.alias("y")
    return (
        x.join(y, "sig").where("x.node < y.node").where(f"least(x.n, y.n) * {den} >= greatest(x.n, y.n) * {num}")
        .select(F.col("x.node").alias("a"), F.col("x.n").alias("na"), F.col("x.cid").alias("ca"), F.col("y.node").alias("b"), F.col("y.n").alias("nb"), F.col("y.cid").alias("cb"))
        .distinct()
    )


def _likely(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sketches do not rule out that they are similar."""
    names = pairs.columns
    for x in "ab":
        pairs = pairs.join(sketches.select(F.col("node").alias(x), F.col("cid").alias(f"c{x}"), F.col("sketch").alias(f"s{x}")), [x, f"c{x}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("sa", "sb", "na", "nb")]
            likely = [_apart(sa, sb) <= (na + nb) * (den - num) // (den + num) for sa, sb, na, nb in zip(*columns)]
            yield batch.select(names).filter(pa.array(likely, pa.bool_()))

    return pairs.select(*names, "sa", "sb").mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def _with_sets(docs: DataFrame, n: int, pairs: DataFrame) -> DataFrame:
    """``pairs`` (a, na, ca, b, nb, cb) with both whole sets."""
    sides = [pairs.select(F.col(x).alias("node"), F.col(f"c{x}").alias("cid")) for x in "ab"]
    sets = _sets(docs, n, sides[0].unionByName(sides[1]).distinct())
    # b is the hub of many pairs: its set is joined last, and the adaptive skew join can split a hot hub
    left = pairs.join(sets.select(F.col("cid").alias("ca"), F.col("grams").alias("ga")), "ca")
    return left.join(sets.select(F.col("cid").alias("cb"), F.col("grams").alias("gb")), "cb")


def _verified(docs: DataFrame, n: int, num: int, den: int, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    common = F.size(F.array_intersect("ga", "gb")).cast("long")
    return _with_sets(docs, n, pairs).where(common * den >= (F.col("na") + F.col("nb") - common) * num).select("a", "b").distinct()


def _differences(docs: DataFrame, n: int, num: int, den: int, stars: DataFrame) -> DataFrame:
    """Stars with: linked, and the part of the difference to the hub that decides whom else a member can be similar to.

    Let d(x) be the shingles in which x and the hub differ, and x and y two
    similar sets of which one is not similar to the hub. They differ in d(x) xor
    d(y), at most K(x, y) shingles, so d(x) and d(y) have at least t = (|d(x)| +
    |d(y)| - K) / 2 > 0 in common. In one order of all shingles (those that the
    hub lacks first, as few sets share them) the first |d| - t + 1 of both then
    meet. ``first`` holds those against any partner, ``far`` how many of them
    count if the partner is not similar to the hub either.
    """
    def most(x, y):
        return F.floor((x + y) * (den - num) / F.lit(den + num))

    d = F.concat(F.array_sort(F.array_except("ga", "gb")), F.array_sort(F.array_except("gb", "ga")))
    out = _with_sets(docs, n, stars).select("a", "na", "ca", "b", "nb", d.alias("d"))
    size, na, nb = F.size("d").cast("long"), F.col("na"), F.col("nb")
    linked = size <= most(na, nb)
    k = most(na, F.floor(na * den / F.lit(num)))
    unlike = most(F.ceil(na * num / F.lit(den)), nb) + 1  # least difference to the hub of a similar set that is not similar to the hub
    half = lambda x: F.greatest(F.lit(1).cast("long"), F.floor((x + 1) / 2))
    any_t = F.when(linked, half(size + unlike - k)).otherwise(half(size + F.greatest(F.lit(1).cast("long"), size - k) - k))
    far_t = half(size + F.greatest(unlike, size - k) - k)
    length = lambda t: F.greatest(F.lit(0).cast("long"), size - t + 1)
    return out.select(
        "a", "na", "ca", "b", linked.alias("linked"), F.expr("d").alias("d"), length(any_t).alias("l"),
        F.when(linked, 0).otherwise(length(far_t)).alias("far")).select("a", "na", "ca", "b", "linked", F.expr("slice(d, 1, int(l))").alias("first"), "far")


def _met(told: DataFrame, comp: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of members of a star that may be similar, are in different components and not both similar to the hub."""
    with_comp = told.join(comp, told["a"] == comp["node"], "left").withColumn("comp", F.coalesce("comp", "a"))
    entries = with_comp.select("b", "a", "na", "ca", "linked", "far", "comp", F.posexplode("first").alias("at", "e"))
    x, y = entries.where("NOT linked").alias("x"), entries.alias("y")
    return (
        x.join(y, ["b", "e"])
        .where("x.comp <> y.comp AND (y.linked OR (x.a < y.a AND x.at < x.far AND y.at < y.far))")
        .where(f"least(x.na, y.na) * {den} >= greatest(x.na, y.na) * {num}")
        .select(F.col("x.a").alias("a"), F.col("x.na").alias("na"), F.col("x.ca").alias("ca"), F.col("y.a").alias("b"), F.col("y.na").alias("nb"), F.col("y.ca").alias("cb"))
        .distinct()
    )


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
