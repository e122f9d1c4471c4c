"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=_U) | _U(1)
_PLACE = _RANDOM.integers(0, 2**64, 64, dtype=_U) | _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_IS_GAP = np.zeros(256, bool)
_IS_GAP[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spreads 64-bit numbers; one to one for each salt."""
    x = (x ^ _U(salt)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(31))) * _U(0x94D049BB133111EB)
    x = (x ^ (x >> _U(29))) * _BASE
    return x ^ (x >> _U(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, _U)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts in a row, with A-Z as a-z, and the number of words of each text."""
    raw = [(x or "").encode("utf-8", "surrogatepass").lower() for x in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    gap = _IS_GAP[data]
    first = ~gap
    first[1:] &= gap[:-1]
    starts = np.flatnonzero(first)
    inside = np.flatnonzero(~gap)
    if not len(starts):
        return np.zeros(0, _U), np.zeros(len(texts), np.int64)
    begin = np.searchsorted(inside, starts)
    length = np.diff(np.append(begin, len(inside)))
    place = np.arange(len(inside)) - np.repeat(begin, length)
    value = _BYTE[data[inside]] * _powers(int(length.max()))[place]
    ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    return mix(np.add.reduceat(value, begin) + length.astype(_U)), counts


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Each text's distinct shingles of ``k`` words, sorted; of a text with fewer words the whole sequence as one; of
    a text without words none."""
    hashes, counts = word_hashes(texts)
    total = np.zeros(max(len(hashes) - k + 1, 0), _U)
    for j in range(k):
        total += hashes[j : len(hashes) - k + 1 + j] * _PLACE[j]
    total = mix(total)
    out, at = [], 0
    for n in counts.tolist():
        if n >= k:
            own = np.sort(total[at : at + n - k + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif n:
            short = (hashes[at : at + n] * _PLACE[:n]).sum(dtype=_U)
            out.append(mix(np.array([short]), 1000 + n))
        else:
            out.append(np.zeros(0, _U))
        at += n
    return out
