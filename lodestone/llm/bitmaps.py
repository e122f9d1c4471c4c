"""Bitmaps of sets, by which most pairs without a link are told without the sets.

Each bit says whether an odd number of a set's shingles fall on it. Bits that differ are at most the shingles that are in
one of two sets only, so sets whose bitmaps differ in more than a link allows have none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lodestone.llm.shingles import mix

#: Bits of a set's bitmap, powers of two, and how many there are for a shingle.
LEAST_BITS, MOST_BITS = 64, 4096
BITS_EACH = 2

_U = np.uint64


def bitmap(own: np.ndarray) -> np.ndarray:
    """The bitmap of a set of hashes, as 64-bit words: BITS_EACH bits for a shingle or up to twice that. Both halves of a
    bitmap, one XOR the other, are the bitmap of half the length."""
    width = min(max(LEAST_BITS, 1 << max(BITS_EACH * len(own) - 1, 0).bit_length()), MOST_BITS)
    place = (mix(own, 78) & _U(width - 1)).view(np.int64)
    odd = (np.bincount(place, minlength=width) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(_U)


class Bitmaps:
    """Sets of the sizes ``n``, in ascending order, with their bitmaps, for links at ``percent`` (50 or more) of the
    union."""

    def __init__(self, n: np.ndarray, bits: list[bytes], percent: int) -> None:
        self.n, self.percent = n, percent
        self.words = np.fromiter(map(len, bits), np.int64, len(bits)) // 8
        most = int(self.words.max())
        self.own, self.half = np.zeros((len(n), most), _U), np.zeros((len(n), max(most // 2, 1)), _U)
        self.first = {}  # the places of the sets of each width
        for w in np.unique(self.words).tolist():
            at = np.flatnonzero(self.words == w)
            self.first[w] = (int(at[0]), int(at[-1]) + 1)
            self.own[at, :w] = np.frombuffer(b"".join(bits[i] for i in at.tolist()), _U).reshape(len(at), w)
            if w > 1:
                self.half[at, : w // 2] = self.own[at, : w // 2] ^ self.own[at, w // 2 : w]
        self.low = np.searchsorted(n, -(-percent * n // 100), "left").tolist()
        self.high = np.searchsorted(n, 100 * n // percent, "right").tolist()

    def near(self, x: int, among: np.ndarray) -> list[int]:
        """The sets marked in ``among`` with which ``x`` may be linked."""
        w, out = int(self.words[x]), []
        # a link's sizes are within a factor of two, so their bitmaps are of one width, or one is of twice the other's
        for v in (w // 2, w, 2 * w):
            if v not in self.first:
                continue
            a, b = max(self.low[x], self.first[v][0]), min(self.high[x], self.first[v][1])
            at = a + np.flatnonzero(among[a:b]) if a < b else ()
            if not len(at):
                continue
            narrow = min(v, w)
            mine = self.own[x, :narrow] if v >= w else self.half[x, :narrow]
            theirs = self.own[at, :narrow] if v <= w else self.half[at, :narrow]
            differ = np.bitwise_count(theirs ^ mine).sum(axis=1, dtype=np.int64)
            both = self.n[x] + self.n[at]
            out += at[(100 + self.percent) * (both - differ) >= 2 * self.percent * both].tolist()
        return out


def parts(sets: Bitmaps) -> np.ndarray:
    """A number for each set, the same for two that may be linked or that others which may be linked join. Each set is
    compared with those that are in no part yet."""
    part, free = np.full(len(sets.n), -1), np.ones(len(sets.n), bool)
    for start in range(len(sets.n)):
        if not free[start]:
            continue
        part[start], free[start], todo = start, False, [start]
        while todo:
            near = sets.near(todo.pop(), free)
            part[near], free[near] = start, False
            todo += near
    return part


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Rows of sorted batches with the places where groups, of equal longs in ``keys``, begin and the last one ends;
    groups are whole."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        table = pa.Table.from_batches([*held, batch])
        if not len(table):
            continue
        new = np.zeros(len(table) - 1, bool)
        for c in keys:
            x = table.column(c).to_numpy()
            new |= x[1:] != x[:-1]
        cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
        if len(cuts) > 1:
            yield table.slice(0, cuts[-1]), cuts
        held = table.slice(cuts[-1]).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, [0, len(table)]
