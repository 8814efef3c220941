"""Sampled SentencePiece segmentations: Gumbel top-k without replacement over the lattice.

The lattice of a text has an edge for every vocabulary piece at every place (a
character that the vocabulary lacks is one edge of its byte pieces). Edges have
unigram weights by the piece's rank in the vocabulary (Zipf), to the power
``alpha``. Forward sums over the lattice give, for every place, the probability
of each piece that ends there, so a text is segmented from its end to its start
in steps of known probability. In that tree of partial segmentations, a node
with log-probability phi has a Gumbel(phi) as the maximum of its leaves. An A-star
search takes the open node with the largest one: its path of maxima is a sample
drawn step by step, and the pieces not taken on the way become open nodes, with
Gumbels truncated at the path's. So the k segmentations are distinct, in order
of their perturbed scores, and with the (k+1)-th largest value ``kappa`` each has
the inclusion score 1 - exp(-exp(phi - kappa)).

No piece crosses from a character to a space mark, so the lattice falls apart
into chunks, whose sums are made once per distinct chunk of a slice; numpy takes
all texts of a slice at once. Random numbers are hashes of (doc_id, sample,
place), so a row's result does not depend on other rows.

Null and empty texts have one segmentation, without pieces. A text with fewer
than k segmentations gives all it has, with score 1 each. Repeated rows give
equal results. Further columns are kept; one with the name of a new column is
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, StructField, StructType

from eventide.llm.common import mix, slices, table
from eventide.llm.token_counts import MARK, TOKENIZER, tokenizer_path

SAMPLES, ALPHA = 2, 0.5
#: Open nodes whose parent is this unlikely are looked at only if no nearer one is high enough (a Gumbel made of a 53-bit number is
#: at most 37 above phi). They are sought in the last TAIL characters first, and further back where a path is still likelier there.
DEPTH, REACH, TAIL = 50.0, 37.0, 2_000
#: Bytes of text that are taken at once.
SLICE = 600_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The pieces of a model in a hash table, with their weights."""

    BITS = 18

    def __init__(self, model_file: str, alpha: float) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.text = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        usual = [i for i in range(len(self.text)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.byte_id = np.zeros(256, np.int32)
        for i in range(len(self.text)):
            if sp.is_byte(i):
                self.byte_id[int(self.text[i][3:5], 16)] = i
        rank = np.arange(len(usual)) + 10.0
        self.weight = np.zeros(len(self.text))
        self.weight[usual] = alpha * -np.log(rank * np.log(rank[-1] / rank[0]))
        self.unknown = alpha * -np.log(rank[-1] * np.log(rank[-1] / rank[0]))  # of each byte
        self.longest = max(len(self.text[i]) for i in usual)
        cps = np.frombuffer("".join(self.text[i] for i in usual).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(self.text[i]) for i in usual])
        h = Sums(cps).of(np.concatenate([[0], ends[:-1]]), ends)
        self.keys, self.ids = np.zeros(1 << self.BITS, np.uint64), np.full(1 << self.BITS, -1, np.int32)
        self.probes = 1
        for key, i in zip(h.tolist(), usual):
            at, n = key >> (64 - self.BITS), 1
            while self.ids[at] >= 0:
                at, n = (at + 1) & ((1 << self.BITS) - 1), n + 1
            self.keys[at], self.ids[at] = key, i
            self.probes = max(self.probes, n)
        #: bytes that each id decodes to
        self.bytes = pa.array([bytes([int(t[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i) else t.encode() for i, t in enumerate(self.text)], pa.large_binary())

    def find(self, h: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -1 for none."""
        at = (h >> np.uint64(64 - self.BITS)).astype(np.int64)
        out = np.where(self.keys[at] == h, self.ids[at], -1)
        open_ = np.flatnonzero((out < 0) & (self.ids[at] >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.BITS) - 1)
            hit = self.keys[at[open_]] == h[open_]
            out[open_[hit]] = self.ids[at[open_[hit]]]
            open_ = open_[~hit & (self.ids[at[open_]] >= 0)]
        return out


class Sums:
    """64-bit hashes of any substrings of an array of code points."""

    def __init__(self, cps: np.ndarray) -> None:
        n = len(cps)
        self._inverse = self._powers(pow(int(_GOLD), -1, 2**64), n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(cps.astype(np.uint64) + np.uint64(7)) * self._powers(int(_GOLD), n + 1)[:n], out=self._sums[1:])

    _kept: dict[int, np.ndarray] = {}

    @classmethod
    def _powers(cls, base: int, n: int) -> np.ndarray:
        """The first ``n`` powers; those of a usual slice are kept for the next one."""
        kept = cls._kept.get(base)
        if kept is None or len(kept) < n:
            kept = np.full(n * 5 // 4, np.uint64(base), np.uint64)
            kept[0] = 1
            np.cumprod(kept, out=kept)
            if n <= 2 * SLICE:
                cls._kept[base] = kept
        return kept[:n]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return ((self._sums[end] - self._sums[start]) * self._inverse[start] + (end - start).astype(np.uint64)) * _GOLD


class Lattice:
    """Edges of all distinct chunks of a slice, grouped by the place where they end, with the probability of each to be the last one."""

    def __init__(self, cps: np.ndarray, sums: Sums, at: np.ndarray, length: np.ndarray, pieces: Pieces) -> None:
        first = np.cumsum(length) - length
        total = int(length.sum())
        local = (np.arange(total) - np.repeat(first, length)).astype(np.int32)
        place = np.repeat(at - first, length) + np.arange(total)
        room = np.repeat(length, length) - local
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        count = np.zeros(total, np.int32)
        for n in range(pieces.longest, 0, -1):  # a stable order: long pieces first
            c = np.flatnonzero(room >= n)
            if not len(c):
                continue
            ident = pieces.find(sums.of(place[c], place[c] + n))
            if n > 1:
                keep = np.flatnonzero(ident >= 0)
                c, ident = c[keep], ident[keep]
            c += n - 1
            count[c] += 1
            found.append((n, c, ident))
        # edges grouped by the place where they end
        self.group = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        edges = int(self.group[-1])
        self.ident, size = np.empty(edges, np.int32), np.empty(edges, np.int32)
        used = self.group[:-1].copy()
        for n, c, ident in found:
            self.ident[used[c]], size[used[c]] = ident, n
            used[c] += 1
        end = np.repeat(np.arange(total), count)
        weight = pieces.weight[self.ident]
        lost = np.flatnonzero(self.ident < 0)
        cp = cps[place[end[lost]]]
        weight[lost] = pieces.unknown * (1 + (cp > 0x7F).astype(np.int64) + (cp > 0x7FF) + (cp > 0xFFFF))
        self.first, self.local = first, local
        self.start = end - size + 1
        # forward sums, for the places at equal distance from their chunks' starts together; before a chunk's start: 0
        alpha = np.zeros(total + 1)
        before = self.start - 1
        before[local[self.start] == 0] = total
        by_level = np.argsort(local.astype(np.uint16) if not total or local.max() < 65536 else local, kind="stable")
        level_ends = np.cumsum(np.bincount(local)) if total else []
        low = 0
        for high in level_ends:
            c = by_level[low:high]
            low = high
            n = count[c]
            edge = np.cumsum(n) - n
            e = np.repeat(self.group[c] - edge, n) + np.arange(int(n.sum()))
            value = alpha[before[e]] + weight[e]
            top = np.maximum.reduceat(value, edge)
            alpha[c] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, n)), edge))
        self.logp = alpha[before] + weight - alpha[end]
        running = np.concatenate([[0], np.cumsum(np.exp(self.logp))])
        base = running[self.group[:-1]]
        scale = 1 / np.maximum(running[self.group[1:]] - base, 1e-300)
        self.upto = end + np.minimum((running[1:] - base[end]) * scale[end], 1.0)

    def draw(self, c: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge that ends at each place ``c``."""
        e, last, goal = self.group[c], self.group[c + 1] - 1, c + u
        on = np.flatnonzero((self.upto[e] <= goal) & (e < last))
        while len(on):  # long pieces come first and are the likely ones
            e[on] += 1
            on = on[(self.upto[e[on]] <= goal[on]) & (e[on] < last[on])]
        return e


def _uniform(key: np.ndarray, sample: int, place: np.ndarray) -> np.ndarray:
    h = mix(key + place.astype(np.uint64) * _GOLD + np.uint64((sample + 1) * 0xD1342543DE82EF95 % 2**64))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _gumbel(phi: np.ndarray, limit: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel(phi), truncated at ``limit``."""
    return phi - np.log(np.exp(np.minimum(phi - limit, 700)) - np.log(u))


def sample_slice(texts: Sequence[str], keys: np.ndarray, k: int, pieces: Pieces) -> tuple[list[list[np.ndarray]], list[list[float]], list[list[float]], np.ndarray]:
    """For each text: ids, log-probabilities and inclusion scores of its samples, and whether all decode to the text."""
    n = len(texts)
    marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
    joined = "".join(marked)
    cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    bound = np.concatenate([[0], np.cumsum([len(t) for t in marked])]).astype(np.int64)
    mark = cps == ord(MARK)
    opens = mark & ~np.concatenate([[False], mark[:-1]]) if len(cps) else mark
    opens[bound[:-1][bound[:-1] < bound[1:]]] = True
    at = np.flatnonzero(opens)
    length = np.diff(np.concatenate([at, [len(cps)]]))
    text_of = np.searchsorted(bound, at, side="right") - 1
    sums = Sums(cps)
    _, rep, chunk = np.unique(sums.of(at, at + length), return_index=True, return_inverse=True)
    lat = Lattice(cps, sums, at[rep], length[rep], pieces)
    shift = at - lat.first[chunk] if len(at) else at  # place in the slice minus place in the lattice
    key = mix(keys.astype(np.uint64) + np.uint64(11))
    own_key, within = key[text_of], shift - bound[text_of]

    def tail(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All places from ``low`` up to before ``high`` of each text, and the texts they are of."""
        size = np.maximum(high - low, 0)
        return np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum())), np.repeat(np.arange(n), size)

    def walk(edges: np.ndarray, occ: np.ndarray, c: np.ndarray, sample: int) -> None:
        """Draw edges from place ``c`` of each occurrence down to its start."""
        while len(occ):
            where = c + shift[occ]
            e = lat.draw(c, _uniform(own_key[occ], sample, c + within[occ]))
            edges[where] = e
            s = lat.start[e]
            on = lat.local[s] > 0
            occ, c = occ[on], s[on] - 1

    def opened(edges: np.ndarray, sample: int, top: np.ndarray, below: np.ndarray, deep: bool) -> tuple[np.ndarray, ...]:
        """Open nodes beside a sample's path, at places up to ``below``, whose parents are near, or those deep below: (text, value, place, edge)."""
        live = below >= bound[:-1]
        low = bound[:-1] if deep else np.maximum(bound[:-1], bound[1:] - TAIL)
        while True:
            where, t = tail(np.where(live, low, 0), np.where(live, bound[1:], 0))
            taken = edges[where] >= 0
            where, t = where[taken], t[taken]
            total = np.concatenate([[0], np.cumsum(lat.logp[edges[where]])])
            ends = np.searchsorted(t, np.arange(n + 1))
            short = live & (low > bound[:-1]) & (total[ends[1:]] - total[ends[:-1]] > -DEPTH)
            if not short.any():
                break
            low = np.where(short, np.maximum(bound[:-1], bound[1:] - 4 * (bound[1:] - low)), low)
        parent = total[ends[1:]][t] - total[1:]  # of all steps from the text's end to this place
        kept = (where <= below[t]) & ((parent <= -DEPTH) if deep else (parent > -DEPTH))
        where, t, parent = where[kept], t[kept], parent[kept]
        own = edges[where]
        c = where - shift[np.searchsorted(at, where, side="right") - 1]
        size = lat.group[c + 1] - lat.group[c]
        rows = np.repeat(np.arange(len(where)), size)
        e = np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size) + lat.group[c][rows]
        other = e != own[rows]
        rows, e = rows[other], e[other]
        phi = parent[rows] + lat.logp[e]
        # each open node has its own random number: by place and length of its piece
        u = _uniform(key[t[rows]], sample, where[rows] - bound[t[rows]] + (1 + c[rows] - lat.start[e]) * (1 << 40))
        return t[rows], _gumbel(phi, top[t[rows]], u), where[rows], e

    samples: list[np.ndarray] = []
    values = np.full((k + 1, n), -np.inf)
    values[0] = -np.log(-np.log(_uniform(key, 0, np.full(n, (1 << 62)))))
    edges = np.full(len(cps), -1, np.int32)
    walk(edges, np.arange(len(at)), lat.first[chunk] + length - 1 if len(at) else at, 0)
    samples.append(edges)
    frontier = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    below, alive = bound[1:] - 1, np.ones(n, bool)
    belows, whole = [], np.zeros((k, n), bool)  # for each sample: up to where its own part goes, and the texts whose deep nodes are open too
    for j in range(1, k + 1):
        belows.append(np.where(alive, below, -1))
        fresh = opened(samples[-1], j - 1, np.where(alive, values[j - 1], np.inf), belows[-1], False)
        frontier = [np.concatenate(x) for x in zip(frontier, [*fresh, np.full(len(fresh[0]), j - 1)])]
        best = np.full(n, -np.inf)
        np.maximum.at(best, frontier[0], frontier[1])
        unsure = alive & (bound[1:] > bound[:-1]) & (best <= REACH - DEPTH)
        for s in range(j):  # deep nodes of all samples so far
            closed = unsure & ~whole[s]
            if closed.any():
                more = opened(samples[s], s, np.where(closed, values[s], np.inf), np.where(closed, belows[s], -1), True)
                frontier = [np.concatenate(x) for x in zip(frontier, [*more, np.full(len(more[0]), s)])]
                np.maximum.at(best, more[0], more[1])
                whole[s] |= closed
        values[j] = best
        if j == k:
            break
        order = np.lexsort((-frontier[1], frontier[0]))
        lead = order[np.flatnonzero(np.concatenate([[True], frontier[0][order][1:] != frontier[0][order][:-1]]))] if len(order) else order
        t, where, e, parent = (frontier[x][lead] for x in (0, 2, 3, 4))
        alive = np.zeros(n, bool)
        alive[t] = True
        cutoff = np.full(n, -1, np.int64)
        cutoff[t] = where
        new = np.full(len(cps), -1, np.int32)
        source = np.full(n, -1, np.int64)
        source[t] = parent
        places, of = tail(np.where(alive, cutoff + 1, 0), np.where(alive, bound[1:], 0))
        for s in range(j):
            copied = places[source[of] == s]
            new[copied] = samples[s][copied]
        new[where] = e
        occ = np.searchsorted(at, where, side="right") - 1
        rest = lat.start[e]
        on = lat.local[rest] > 0
        earlier = np.flatnonzero(_earlier(at, length, text_of, t, at[occ], n))
        walk(new, np.concatenate([occ[on], earlier]), np.concatenate([rest[on] - 1, lat.first[chunk[earlier]] + length[earlier] - 1]), j)
        samples.append(new)
        below = np.where(alive, cutoff - 1, -1)
        # beside the new path, nodes at the place where it left its parent's path are open already
        kept = np.ones(len(frontier[0]), bool)
        kept[lead] = False
        frontier = [x[kept] for x in frontier]

    ids_out, logps, scores = [[] for _ in range(n)], [[] for _ in range(n)], [[] for _ in range(n)]
    good = np.ones(n, bool)
    raw = np.frombuffer(joined.encode(), np.uint8)
    raw_bound = np.concatenate([[0], np.cumsum([len(t.encode()) for t in marked])])
    for j, edges in enumerate(samples):
        where = np.flatnonzero(edges >= 0)
        own = edges[where]
        ident, cp = lat.ident[own], cps[where]
        lp = np.concatenate([[0], np.cumsum(lat.logp[own])])
        last = np.searchsorted(where, bound)
        lp = lp[last[1:]] - lp[last[:-1]]
        lost = ident < 0
        spelled = [pieces.byte_id[list(chr(x).encode("utf-8", "surrogatepass"))] for x in cp[lost].tolist()]
        size = np.ones(len(ident), np.int64)
        size[lost] = [len(s) for s in spelled]
        offset = np.concatenate([[0], np.cumsum(size)])
        ids = np.repeat(ident, size).astype(np.int32)
        if spelled:
            ids[np.repeat(lost, size)] = np.concatenate(spelled)
        cut = offset[last]
        taken = pieces.bytes.take(pa.array(ids))
        got = np.frombuffer(taken.buffers()[2], np.uint8) if len(ids) and taken.buffers()[2] is not None else np.zeros(0, np.uint8)
        got_bound = np.frombuffer(taken.buffers()[1], np.int64)[: len(ids) + 1][cut] if len(ids) else np.zeros(n + 1, np.int64)
        for i in range(n):
            if j and not np.isfinite(values[j][i]):
                continue
            ids_out[i].append(ids[cut[i] : cut[i + 1]])
            logps[i].append(float(lp[i]))
            kappa = values[len(samples)][i]
            scores[i].append(float(-np.expm1(-np.exp(min(lp[i] - kappa, 700.0)))) if np.isfinite(kappa) else 1.0)
            good[i] &= got[got_bound[i] : got_bound[i + 1]].tobytes() == raw[raw_bound[i] : raw_bound[i + 1]].tobytes()
    return ids_out, logps, scores, good


def _earlier(at: np.ndarray, length: np.ndarray, text_of: np.ndarray, t: np.ndarray, limit: np.ndarray, n: int) -> np.ndarray:
    """Which chunks lie before the place ``limit`` of their text; none of texts without one."""
    most = np.full(n, -1, np.int64)
    most[t] = limit
    return at + length - 1 < most[text_of]


def decode(ids: Sequence[int], pieces: Pieces) -> str:
    """The text of a segmentation."""
    out = b"".join(pieces.bytes.take(pa.array(ids, pa.int32())).to_pylist()).decode("utf-8", "replace").replace(MARK, " ")
    return out[1:] if out.startswith(" ") else out


_PIECES: dict[tuple[str, float], Pieces] = {}


def pieces_of(model_file: str, alpha: float) -> Pieces:
    """The pieces of a model, once per worker process."""
    if (model_file, alpha) not in _PIECES:
        _PIECES[model_file, alpha] = Pieces(model_file, alpha)
    return _PIECES[model_file, alpha]


def sample_segmentations(docs: DataFrame, k: int = SAMPLES, alpha: float = ALPHA, model_file: str | None = None) -> DataFrame:
    """Columns of ``docs`` plus ids (one binary of little-endian uint16 per sample), n_pieces, log_probs, inclusion and round_trip."""
    model_file = model_file or tokenizer_path(TOKENIZER)
    new = [StructField("ids", ArrayType(BinaryType())), StructField("n_pieces", ArrayType(IntegerType())), StructField("log_probs", ArrayType(DoubleType())),
           StructField("inclusion", ArrayType(DoubleType())), StructField("round_trip", BooleanType())]
    docs = docs.select(*[c for c in docs.columns if c not in {f.name for f in new}])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model_file, alpha)
        for batch in batches:
            for b in slices(batch, "text", SLICE):
                keys = np.array([0 if x is None else hash(int(x)) for x in b.column("doc_id").to_pylist()], np.int64)
                ids, logps, scores, good = sample_slice([t or "" for t in b.column("text").to_pylist()], keys, k, pieces)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array([[x.astype("<u2").tobytes() for x in y] for y in ids], pa.list_(pa.binary())),
                     pa.array([[len(x) for x in y] for y in ids], pa.list_(pa.int32())), pa.array([[round(x, 6) for x in y] for y in logps], pa.list_(pa.float64())),
                     pa.array(scores, pa.list_(pa.float64())), pa.array(good)],
                    names=[*b.schema.names, *(f.name for f in new)])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *new]))


def op6_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_segmentations(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
