"""Byte-level BPE encoding and decoding.

Each piece of a text is merged with a segment tree over its byte positions. A leaf stands for the token that begins at
a byte and holds the rank of merging it with the live token to its right; a node holds the smaller of its children's,
the left one's on a tie, so that the root is the leftmost pair of minimum rank. A merge changes two pairs, that of the
merged token and that of its left neighbour, and removes one token: three leaves, each updated on its way to the root.

Many pieces are merged at a time, each in a tree of its own: pieces of similar length are rows of arrays, and one step
merges the root's pair in every row that has one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.chunks import Encoded, gather, slices

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Characters that a task works on at a time.
STEP_CHARS = 2_000_000
#: Positions of the segment trees that are merged at a time.
STEP_NODES = 1 << 20
#: Pieces of so many bytes have a tree of their own, in which equal pairs are merged together.
LONG = 1 << 11

_NONE = np.int32(2**31 - 1)


class Bpe:
    """Ranks of a vocabulary file, each line a token in base64 and its rank; a token's id is its rank."""

    def __init__(self, path: str, pattern: str = PATTERN) -> None:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.pattern = regex.compile(pattern)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.vocabulary = self._table(ranks)
        self._pairs(ranks)
        self.known = Encoded(self._encode_chunks)
        self.ranks = ranks

    @staticmethod
    def _table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens' bytes in a row, where a token begins, and its length (-1: no such id)."""
        top = max(ranks.values()) + 1
        length = np.full(top, -1, np.int64)
        ordered = sorted(ranks, key=ranks.get)
        ids = np.fromiter(map(ranks.get, ordered), np.int64, len(ordered))
        length[ids] = np.fromiter(map(len, ordered), np.int64, len(ordered))
        begin = np.concatenate([[0], np.cumsum(np.maximum(length, 0))[:-1]])
        return np.frombuffer(b"".join(ordered), np.uint8), begin, length

    def _pairs(self, ranks: dict[bytes, int]) -> None:
        """Every split of a token into two tokens, as sorted keys, with the token's id."""
        keys, ids = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    ids.append(rank)
        order = np.argsort(keys)
        self.pair_keys = np.append(np.array(keys, np.int64)[order], np.int64(2**62))
        self.pair_ids = np.append(np.array(ids, np.int32)[order], _NONE)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ids[at], _NONE)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in a row, where those of each piece begin, and how many they are."""
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begin, length = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        known = np.flatnonzero(whole >= 0)
        begin[known], length[known] = np.arange(len(known)), 1
        out, done = [whole[known]], len(known)
        widths = np.where(whole >= 0, 0, 1 << np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64))
        for width in np.unique(widths[widths > 0]).tolist():
            rows = np.flatnonzero(widths == width)
            if width >= LONG:
                for i in rows.tolist():
                    ids = self._merge_long(pieces[i], width)
                    begin[i], length[i] = done, len(ids)
                    out.append(ids)
                    done += len(ids)
                continue
            step = max(1, STEP_NODES // width)
            for first in range(0, len(rows), step):
                some = rows[first : first + step]
                ids, counts = self._merge_rows([pieces[i] for i in some.tolist()], width)
                begin[some], length[some] = done + np.cumsum(counts) - counts, counts
                out.append(ids)
                done += len(ids)
        return np.concatenate(out), begin, length

    def _merge_long(self, piece: bytes, width: int) -> np.ndarray:
        """The ids of a long piece. Each step merges all pairs of the least rank, which are found from the root down, as
        one after the other from the left would; where a merge makes a pair of a lower rank, only the first is done."""
        ids, after, before, tree = (x.reshape(-1) for x in self._trees([piece], width))
        while tree[1] >> 32 != _NONE:
            least = int(tree[1] >> 32)
            at = np.array([1])
            while at[0] < width:
                at = np.stack([2 * at, 2 * at + 1], axis=1).reshape(-1)
                at = at[tree[at] >> 32 == least]
            at -= width
            # of pairs that overlap in a row, every other one counts
            starts = np.ones(len(at), bool)
            starts[1:] = after[at[:-1]] != at[1:]
            run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            while True:
                gone = after[at]
                right, left = after[gone], before[at]
                joined = np.zeros(len(at), bool)  # follows the merge before it without a token between
                joined[1:] = right[:-1] == at[1:]
                new = np.full(len(at), least, np.int32)
                there, has_left = right < width, left >= 0
                to_right = np.full(len(at), _NONE, np.int64)
                to_right[there] = self._rank(new[there], ids[right[there]])
                to_left = np.full(len(at), _NONE, np.int64)
                to_left[has_left] = self._rank(np.where(joined, least, ids[left])[has_left], new[has_left])
                if len(at) == 1 or min(to_right.min(), to_left.min()) > least:
                    break
                at = at[:1]
            to_right[:-1] = np.where(joined[1:], to_left[1:], to_right[:-1])
            ids[at], ids[gone], after[at] = least, -1, right
            before[right[there]] = at[there]
            own = has_left & ~joined
            places = np.concatenate([gone, at, left[own]])
            ranks = np.concatenate([np.full(len(gone), _NONE, np.int64), to_right, to_left[own]])
            self._point(tree, np.zeros(len(places), np.int64), width, places, ranks)
        return ids[ids >= 0]

    def _trees(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each piece the ids of its bytes, the places after and before each, and the tree of pair ranks."""
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        text = np.frombuffer(b"".join(pieces), np.uint8)
        inside = np.arange(width) < lengths[:, None]
        ids = np.full((n, width), -1, np.int32)
        ids[inside] = self.byte_id[text]
        after = np.where(np.arange(1, width + 1) < lengths[:, None], np.arange(1, width + 1), width)
        before = np.broadcast_to(np.arange(-1, width - 1), (n, width)).copy()
        # tree[:, 1] is the root, tree[:, width + i] the leaf of byte i: its pair's rank and, for order, its place
        tree = np.full((n, 2 * width), np.int64(_NONE) << 32, np.int64)
        pairs = inside[:, 1:]
        ranks = np.full((n, width), _NONE, np.int64)
        ranks[:, :-1][pairs] = self._rank(ids[:, :-1][pairs], ids[:, 1:][pairs])
        tree[:, width:] = ranks << 32 | np.arange(width)
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        return ids, after, before, tree

    def _merge_rows(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        ids, after, before, tree = self._trees(pieces, width)
        flat_ids, flat_after, flat_before, flat_tree = (x.reshape(-1) for x in (ids, after, before, tree))
        live = np.flatnonzero(tree[:, 1] >> 32 != _NONE)
        while len(live):
            root = flat_tree[live * 2 * width + 1]
            row, at, rank = live * width, root & 0xFFFFFFFF, (root >> 32).astype(np.int32)
            gone = flat_after[row + at]
            right = flat_after[row + gone]
            flat_ids[row + at] = rank
            flat_ids[row + gone] = -1
            flat_after[row + at] = right
            linked = right < width
            flat_before[row[linked] + right[linked]] = at[linked]
            left = flat_before[row + at]
            self._point(flat_tree, live, width, gone, np.full(len(live), _NONE, np.int64))
            self._point(flat_tree, live, width, at, self._pair(flat_ids, row, at, right, linked))
            has_left = left >= 0
            self._point(
                flat_tree, live[has_left], width, left[has_left],
                self._pair(flat_ids, row[has_left], left[has_left], at[has_left], np.ones(int(has_left.sum()), bool)),
            )
            live = live[flat_tree[live * 2 * width + 1] >> 32 != _NONE]
        alive = ids >= 0
        return ids[alive], alive.sum(axis=1)

    def _pair(self, ids: np.ndarray, row: np.ndarray, a: np.ndarray, b: np.ndarray, there: np.ndarray) -> np.ndarray:
        rank = np.full(len(row), _NONE, np.int64)
        rank[there] = self._rank(ids[row[there] + a[there]], ids[row[there] + b[there]])
        return rank

    @staticmethod
    def _point(tree: np.ndarray, rows: np.ndarray, width: int, at: np.ndarray, rank: np.ndarray) -> None:
        """Sets one leaf in each row's tree, and the nodes above it."""
        base, node = rows * 2 * width, width + at
        tree[base + node] = rank << 32 | at
        while width > 1:
            node = node >> 1
            tree[base + node] = np.minimum(tree[base + 2 * node], tree[base + 2 * node + 1])
            width >>= 1

    def _encode_chunks(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = list(map(self.pattern.findall, new))
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = [piece for part in cut for piece in part]
        place: dict[str, int] = {}
        places = np.array([place.setdefault(piece, len(place)) for piece in flat], np.int64)
        ids, begin, length = self.merge([piece.encode() for piece in place])
        ends = np.concatenate([[0], np.cumsum(length[places])])[np.concatenate([[0], np.cumsum(counts)])]
        return gather(ids, begin[places], length[places]), np.diff(ends)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the place after each text's last one."""
        return self.known.texts(texts)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids."""
        data, begin, length = self.vocabulary
        sizes = length[ids]
        if len(ids) and sizes.min() < 0:
            raise ValueError("an id is not in the vocabulary")
        out = gather(data, begin[ids], sizes).tobytes()
        cuts = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends])].tolist()
        return [out[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def bpe(path: str, pattern: str = PATTERN) -> Bpe:
    """One for a process, which keeps what it has encoded."""
    return Bpe(path, pattern)


def encode(docs: DataFrame, path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """``docs`` with a column ``ids``, the array of each ``text``'s token ids; a column of that name is replaced.

    Null and empty texts have no ids. Rows stay as they are, repeated rows and null ids included. Texts are encoded in
    steps of some megabytes; a longer one is a step of its own.
    """
    columns = [c for c in docs.columns if c.lower() != "ids"]
    schema = docs.select(*columns).withColumn("ids", F.array().cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = bpe(path, pattern)
        at = columns.index(next(c for c in columns if c.lower() == "text"))
        for batch in batches:
            texts = batch.column(at)
            lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for first, last in slices(lengths, STEP_CHARS):
                part = batch.slice(first, last - first)
                ids, ends = tokenizer.encode(part.column(at).to_pylist())
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*columns, "ids"])

    return docs.select(*columns).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """``rows`` with a column ``decoded`` (binary), the bytes that the array ``ids`` stands for; null ids: no bytes.
    An id that is not in the vocabulary is an error."""
    columns = [c for c in rows.columns if c.lower() != "decoded"]
    schema = rows.select(*columns).withColumn("decoded", F.lit(b"")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = bpe(path, pattern)
        at = columns.index(next(c for c in columns if c.lower() == "ids"))
        for batch in batches:
            lists = batch.column(at)
            sizes = np.asarray(lists.value_lengths().fill_null(0))
            flat = np.asarray(lists.flatten())
            ends = np.cumsum(sizes)
            done = 0
            for first, last in slices(sizes.tolist(), STEP_CHARS):
                to = int(ends[last - 1])
                part = tokenizer.decode(flat[done:to], ends[first:last] - done)
                done = to
                chunk = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(part, pa.binary())], [*columns, "decoded"])

    return rows.select(*columns).mapInArrow(run, schema)
