"""Front-coded sorted runs of suffixes and a merge that never compares a known common prefix again."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np


def common_prefix(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix of ``a`` and ``b``, of which the first ``at`` bytes are known to be equal."""
    end = min(len(a), len(b))
    while at < end:
        step = min(64, end - at)
        x = int.from_bytes(a[at : at + step], "big") ^ int.from_bytes(b[at : at + step], "big")
        if x:
            return at + step - (x.bit_length() + 7) // 8
        at += step
    return end


def common_suffix(a: bytes, b: bytes) -> int:
    return common_prefix(a[::-1], b[::-1])


class Run:
    """A sorted run: each key as the length it shares with the one before and the rest."""

    def __init__(self, keys: Sequence[bytes]) -> None:
        shared, rests, before = [], [], b""
        for k in keys:
            n = common_prefix(before, k)
            shared.append(n)
            rests.append(k[n:])
            before = k
        self.shared = np.array(shared, "<u4")
        self.lengths = np.array([len(x) for x in rests], "<u4")
        self.rests = b"".join(rests)

    def pack(self) -> tuple[bytes, bytes, bytes]:
        return self.shared.tobytes(), self.lengths.tobytes(), self.rests

    @staticmethod
    def read(shared: bytes, lengths: bytes, rests: bytes) -> Iterator[tuple[int, bytes]]:
        """(shared length with the key before, key) of each entry."""
        at, key = 0, b""
        for n, m in zip(np.frombuffer(shared, "<u4").tolist(), np.frombuffer(lengths, "<u4").tolist()):
            key = key[:n] + rests[at : at + m]
            at += m
            yield n, key


def merge(runs: Sequence[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """(run, shared length with the key before, key) of all entries in order; equal keys by run.

    A loser tree. Every waiting key knows the length it shares with the key that
    left last. Of two waiting keys the one that shares more is smaller, without
    a look at their bytes; only at equal lengths are bytes compared, from that
    length on, and the loser keeps the length it shares with the winner.
    """
    k = 1 << max(0, len(runs) - 1).bit_length()
    keys: list[bytes | None] = [None] * k
    known = [0] * k
    for i, r in enumerate(runs):
        head = next(r, None)
        if head is not None:
            keys[i] = head[1]

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)."""
        x, y = keys[a], keys[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        n = common_prefix(x, y, known[a])
        first = (a, b) if (x[n:] < y[n:] if n < len(x) and n < len(y) else (len(x), a) < (len(y), b)) else (b, a)
        known[first[1]] = n
        return first

    losers, up = [0] * k, [0] * (2 * k)
    up[k:] = range(k)
    for i in range(k - 1, 0, -1):
        up[i], losers[i] = play(up[2 * i], up[2 * i + 1])
    winner = up[1]
    while keys[winner] is not None:
        yield winner, known[winner], keys[winner]
        head = next(runs[winner], None) if winner < len(runs) else None
        keys[winner] = None if head is None else head[1]
        known[winner] = 0 if head is None else head[0]
        i, now = (winner + k) >> 1, winner
        while i:
            now, losers[i] = play(now, losers[i])
            i >>= 1
        winner = now
