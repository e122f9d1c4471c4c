"""Cuts texts at places that no token crosses, and keeps what chunks were encoded to.

Byte-level pre-tokenizers put a single space in front of the word after it, and a single newline, or each of two, in
a token of its own. A text without longer runs of white space, and without other white space, can thus be cut before
every space and around every newline; the pieces are found in a dictionary of what was encoded before. Any other text
is one chunk.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import repeat

import numpy as np

_CUT = "\x00"
#: White space besides space and newline, and the mark of a cut.
_OTHER = [_CUT, *"\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B))]
_PLAIN = re.compile(r" ?\S+")
_RUNS = ("  ", " \n", "\n ", "\n\n\n")


def chunks(text: str) -> list[str]:
    """Pieces that tokenize by themselves and together are the text."""
    for odd in _RUNS:
        if odd in text:
            return [text]
    for odd in _OTHER:
        if odd in text:
            return [text]
    if text.endswith("\n\n"):
        return [text]
    return text.replace(" ", _CUT + " ").replace("\n", _CUT + "\n" + _CUT).split(_CUT)


class Encoded:
    """The tokens of chunks. ``encode`` gets the chunks that are new and returns all their ids in a row, and how many
    each has. At most ``keep`` characters and ids are kept from one call to the next; forgetting them only costs
    time. Texts that hold one of ``whole`` are one chunk."""

    def __init__(
        self,
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        keep: int = 6_000_000,
        whole: tuple[str, ...] = (),
    ) -> None:
        self.encode, self.keep, self.whole = encode, keep, whole
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.size = 0

    def _cut(self, text: str) -> list[str]:
        for content in self.whole:
            if content in text:
                return [text]
        return chunks(text)

    def _learn(self, new: list[str]) -> None:
        got, lengths = self.encode(new)
        n, first = len(self.place), int(self.starts[len(self.place)])
        need = first + int(lengths.sum())
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(need, len(self.ids)), np.uint32)])
        if n + len(new) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(max(n + len(new) + 1, len(self.starts)), np.int64)])
        self.ids[first:need] = got
        self.starts[n + 1 : n + len(new) + 1] = first + np.cumsum(lengths)
        self.place.update(zip(new, range(n, n + len(new))))
        self.size += sum(map(len, new)) + need - first

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the place after each text's last one. Null is an empty text."""
        if self.size > self.keep:
            self._forget()
        cut = [self._cut(x) if x else [] for x in texts]
        per_text = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = [c for part in cut for c in part]
        if not flat:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        places = np.fromiter(map(self.place.get, flat, repeat(-1)), np.int64, len(flat))
        unknown = np.flatnonzero(places < 0)
        if len(unknown):
            new = [flat[i] for i in unknown.tolist()]
            self._learn(list(dict.fromkeys(new)))
            places[unknown] = np.fromiter(map(self.place.get, new), np.int64, len(new))
        begin, length = self.starts[places], self.starts[places + 1] - self.starts[places]
        ids = gather(self.ids, begin, length)
        ends = np.concatenate([[0], np.cumsum(length)])
        return ids, ends[np.cumsum(per_text)]


def gather(values: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs ``values[begin : begin + length]``, one after another."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(begin - (ends - length), length)
    return values[shift + np.arange(total, dtype=np.int64)]


def slices(lengths, limit: int):
    """Neighbouring rows whose lengths add up to ``limit`` at most, or single rows, as (first, after the last)."""
    first = total = 0
    for i, n in enumerate(lengths):
        if i > first and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if len(lengths) > first:
        yield first, len(lengths)


def plain(chunk: str) -> bool:
    """Whether a chunk is one run of other characters than white space, perhaps after a space."""
    return _PLAIN.fullmatch(chunk) is not None
