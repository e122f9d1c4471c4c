"""Size-aware heavy-light Jaccard join of word shingle sets, to connected components.

Light sets are small: each enumerates its subsets of the sizes that an overlap with a partner can have, and linked sets
enumerate a common one. Heavy sets are large, where subsets are too many: their shingles are ordered by how frequent
they are, rare ones first, and the first n - ceil(t n) + 1 of a set of n name the inverted lists it is in; two sets whose
similarity is t or more share one of those. Frequencies are counted over all documents in a table of fixed size by hash;
where hashes collide the order is worse, but it is the same for all sets, so no link is lost.

The boundary is the size up to which a set's subsets cost less than its lists, at the length that a list has on average
by the counted frequencies. Sets that can be linked across it take both ways.

Equal sets are one class from the start. Lists are split by bitmaps (see there) before any full set is read: sets that
may not be linked, by themselves or by a chain of others in their list, part there, and those which are alone then leave
it. What remains is scanned by stars (see star_links), and links are confirmed on full sets. Lists that hold the same
sets are scanned once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.bitmaps import Bitmaps, bitmap, groups, parts
from lodestone.llm.bucket_links import once, star_links
from lodestone.llm.chunks import slices
from lodestone.llm.common import small
from lodestone.llm.components import components
from lodestone.llm.shingles import mix, shingle_sets
from lodestone.session import stage, stage_bucketed

WORDS = 5
PERCENT = 80
#: Characters that a task works on at a time.
STEP_CHARS = 4_000_000
#: Words of 63 bits in the filter for the texts that are read again: 4 MB.
FILTER_WORDS = 1 << 18
#: Slots of the table of frequencies: 1 MB.
SLOTS = 1 << 18
#: Sets of more shingles are never light: a set of that size has too many subsets at any price.
LARGEST_LIGHT = 64
#: Rows of a list beyond which its rows are not sorted into one task.
HOT_ROWS = 20_000
#: Sets of a list that are compared by their bitmaps in one task; longer lists are dealt in pairs of blocks.
BLOCK_SETS = 4096

_U = np.uint64


class Scheme:
    """Which lists a set of a size is in, for links at ``percent`` of the union, if a list of a heavy set has
    ``list_length`` sets on average."""

    def __init__(self, percent: int, list_length: float = 1.0) -> None:
        if not 50 <= percent <= 100:
            raise ValueError("a percentage from 50 to 100 is needed")
        self.percent = percent
        self.light = 0
        for n in range(1, LARGEST_LIGHT + 1):
            if sum(comb(n, c) for c in self.subset_sizes(n)) <= self.prefix(n) * max(list_length, 1):
                self.light = n

    def least(self, n: int) -> int:
        """The smallest overlap of a set of ``n`` with one that it is linked with, and the smallest size of that."""
        return -(-self.percent * n // 100)

    def partner(self, n: int) -> int:
        """The largest size that a set of ``n`` can be linked with."""
        return 100 * n // self.percent

    def subset_sizes(self, n: int) -> list[int]:
        """The overlaps that links of a set of ``n`` need, which are the sizes of the subsets it enumerates."""
        need = (-(-self.percent * (n + t) // (100 + self.percent)) for t in range(self.least(n), self.partner(n) + 1))
        return sorted({c for c in need if c <= n})

    def prefix(self, n: int) -> int:
        """How many of the rarest shingles of a set of ``n`` name its lists."""
        return n - self.least(n) + 1

    def keys(self, own: np.ndarray, frequency: np.ndarray) -> np.ndarray:
        """The lists that the set ``own`` (sorted hashes) is in."""
        n = len(own)
        if not n:
            return np.zeros(0, _U)
        out = []
        if n <= self.light:
            spread = mix(own, 77)
            total = spread.sum(dtype=_U)
            for c in self.subset_sizes(n):
                left_out = [spread[list(x)].sum(dtype=_U) for x in combinations(range(n), n - c)] if c < n else [_U(0)]
                out.append(mix(total - np.array(left_out, _U), 1 + c))
        if self.partner(n) > self.light:
            rare = np.argsort(frequency[_slots(own)], kind="stable")[: self.prefix(n)]
            out.append(mix(own[rare], 100_000))
        return np.unique(np.concatenate(out))


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(46)).astype(np.int64)


def _as_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, _U), *arrays]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _signed(sets: list[np.ndarray], salt: int) -> pa.Array:
    return pa.array(np.array([mix(s, salt).sum(dtype=_U) for s in sets], _U).view(np.int64))


def _steps(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of a batch with their texts."""
    texts = batch.column(batch.schema.get_field_index("text"))
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for first, last in slices(lengths, STEP_CHARS):
        part = batch.slice(first, last - first)
        yield part, part.column(batch.schema.get_field_index("text")).to_pylist()


def frequencies(docs: DataFrame, words: int) -> np.ndarray:
    """How many sets of all documents have a shingle in each slot. SLOTS numbers, whatever the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for _, texts in _steps(batch):
                flat = np.concatenate([np.zeros(0, _U), *shingle_sets(texts, words)])
                counts += np.bincount(_slots(flat), minlength=SLOTS)
        slot = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(counts[slot])], ["slot", "n"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "slot long, n long")
    rows = found.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SLOTS, np.int64)
    counts[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return counts


def list_length(frequency: np.ndarray) -> float:
    """How many sets share a shingle, seen from a shingle of a set: what slots hold beyond chance."""
    total = float(frequency.sum())
    if not total:
        return 1.0
    return max(1.0, 1 + (frequency.astype(float) ** 2).sum() / total - total / SLOTS - 1)


def signatures(docs: DataFrame, words: int, percent: int, frequency: np.ndarray) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, keys, bits): the set's size, two sums that stand for its content, its lists, and its
    bitmap."""
    plan = Scheme(percent, list_length(frequency))
    shared = docs.sparkSession.sparkContext.broadcast(frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = shared.value
        for batch in batches:
            for part, texts in _steps(batch):
                sets = shingle_sets(texts, words)
                columns = [
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _signed(sets, 11),
                    _signed(sets, 12),
                    _as_lists([plan.keys(s, counted) for s in sets]),
                    pa.array([bitmap(s).tobytes() for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "s1", "s2", "keys", "bits"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_shingles long, s1 long, s2 long, keys array<long>, bits binary")


def _might_be(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` without most of those whose id isn't a ``rep``, so that few texts are shuffled. One bit stands for an
    id's hash; the table of bits has FILTER_WORDS rows at most, however many ids there are."""

    def bit(c: str) -> tuple[Column, Column]:
        h = F.xxhash64(c)
        return F.pmod(h, F.lit(FILTER_WORDS)), F.expr(f"shiftleft(1L, cast(pmod(shiftright(xxhash64({c}), 32), 63) AS int))")

    word, mask = bit("rep")
    bits = wanted.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    bits = F.broadcast(stage(bits, "filter"))
    word, mask = bit("doc_id")
    met = docs.withColumn("_word", word).join(bits, "_word").where(F.col("_bits").bitwiseAND(mask) != 0)
    return met.select("doc_id", "text")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(set_no, hashes) of the classes ``wanted`` (set_no, rep, s1, s2; a written table), from the texts of their
    documents ``rep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _steps(batch):
                sets = shingle_sets(texts, words)
                named = {name: part.column(i) for i, name in enumerate(part.schema.names)}
                own = pc.and_(pc.equal(named["s1"], _signed(sets, 11)), pc.equal(named["s2"], _signed(sets, 12)))
                out = pa.RecordBatch.from_arrays([named["set_no"], _as_lists(sets)], ["set_no", "hashes"])
                yield out.filter(own)

    texts = _might_be(docs.select("doc_id", F.col("text").cast("string").alias("text")), wanted)
    wanted = small(wanted)
    joined = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["rep"])).select("set_no", "s1", "s2", "text")
    return joined.mapInArrow(run, "set_no long, hashes array<long>")


def _shared_lists(classes: DataFrame) -> DataFrame:
    """(key, set_no, n) of the lists with two sets or more. Rows of a key meet in one task, sorted, and pass through it
    in batches. Lists that a sample of the sets shows to be very long have more than one set anyway and stay where they
    are; the sample only decides on that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "set_no", "n"]
        last, shown = None, False  # the last row, and whether it went out
        for batch in batches:
            columns = [batch.column(k).to_numpy() for k in range(3)]
            if not len(columns[0]):
                continue
            key = columns[0]
            new = np.ones(len(key) + 1, bool)
            new[1:-1] = key[1:] != key[:-1]
            new[0] = last is None or last[0] != key[0]
            if not new[0] and not shown:
                yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in last], names)
            out = ~new[:-1] | ~new[1:]
            last, shown = [x[-1] for x in columns], bool(out[-1])
            yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in columns], names)

    lists = classes.select(F.explode("keys").alias("key"), "set_no", F.col("n_shingles").alias("n"))
    share = 0.01
    seen = classes.sample(share, 7).select(F.explode("keys").alias("key")).groupBy("key").count()
    hot = stage(seen.where(F.col("count") >= HOT_ROWS * share).select("key"), "hot-lists")
    rest = lists if hot.isEmpty() else lists.join(hot, "key", "left_anti")
    found = rest.repartition("key").sortWithinPartitions("key", "set_no").mapInArrow(run, "key long, set_no long, n long")
    return found if hot.isEmpty() else found.unionByName(lists.join(hot, "key", "left_semi"))


def _alike_lists(rows: DataFrame, bitmaps: DataFrame, percent: int, block: int = BLOCK_SETS) -> DataFrame:
    """``rows`` (key, set_no, n; a written table) of lists, split by ``bitmaps`` (set_no, bits): two sets of a list that
    may be linked are in one list still, and sets that nobody in their list may be linked with are in none."""
    names = ["key", "set_no", "n", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in groups(batches, ["key", "i", "j"]):
            key, set_no, n = (table.column(c).to_numpy() for c in names[:3])
            bits = table.column("bits").to_pylist()
            part = np.concatenate([a + parts(Bitmaps(n[a:b], bits[a:b], percent)) for a, b in zip(cuts, cuts[1:])])
            kept = np.bincount(part)[part] > 1
            yield pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (key, set_no, n, set_no[part])], names)

    def split(placed: DataFrame) -> DataFrame:
        """(key, set_no, n, part) of the sets of each (key, i, j)."""
        marked = placed.join(bitmaps, "set_no").select("key", "i", "j", "set_no", "n", "bits")
        dealt = marked.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "n")
        return dealt.mapInArrow(run, "key long, set_no long, n long, part long")

    blocks = F.ceil(F.count("*") / block).cast("int").alias("blocks")
    long = stage(rows.groupBy("key").agg(blocks).where("blocks > 1"), "long-lists")
    none = F.lit(0)
    short = rows if long.isEmpty() else rows.join(long, "key", "left_anti")
    found = split(short.select("key", none.alias("i"), none.alias("j"), "set_no", "n"))
    found = found.select(F.xxhash64("key", "part").alias("key"), "set_no", "n")
    if long.isEmpty():
        return found
    # every two blocks of a long list meet in a task, whose parts are joined to those of the list
    rows = rows.join(long, "key").withColumn("own", F.pmod(F.xxhash64("set_no"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("key", "own", every, "set_no", "n")
    rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "set_no", "n")
    pieces = stage(split(rows), "parts")
    node = F.xxhash64("key", "set_no")
    labels = components(pieces.select(node.alias("a"), F.xxhash64("key", "part").alias("b")))
    members = pieces.select("key", "set_no", "n").distinct().withColumn("node", node)
    return found.unionByName(members.join(labels, "node").select(F.col("label").alias("key"), "set_no", "n"))


def _different_lists(rows: DataFrame) -> DataFrame:
    """``rows`` (key, set_no, n) without lists that hold the same sets as another, with the ``weight`` of each set: what
    its lists hold together."""
    content = rows.groupBy("key").agg(
        F.count("*").alias("members"), F.bit_xor(F.xxhash64("set_no")).alias("c1"), F.bit_xor(F.xxhash64("set_no", F.lit(1))).alias("c2")
    )
    once = content.groupBy("members", "c1", "c2").agg(F.min("key").alias("key")).where("members > 1").select("key", "members")
    rows = stage(rows.join(once, "key"), "lists")
    weights = rows.groupBy("set_no").agg(F.sum("members").alias("weight"))
    return stage(rows.drop("members").join(weights, "set_no").select("key", "set_no", "n", "weight"), "lists")


def ngram_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs`` (doc_id, text).

    Sets are those of ``words``-word shingles of the lower-cased (A-Z) words; two documents are linked if 100 times
    their common shingles are at least ``percent`` times those of either. ``component_id`` is the smallest doc_id that
    links reach, the document's own included. Null and empty texts have no shingles and are linked with nothing:
    ``n_shingles`` 0, ``component_id`` their own id. Rows without a doc_id link like others but are never the smallest
    id; a component of only such rows has none. Rows that repeat an id are documents of their own.
    """
    signed = stage(signatures(docs, words, percent, frequencies(docs, words)), "signatures")
    classes = signed.where("n_shingles > 0").groupBy("n_shingles", "s1", "s2")
    classes = classes.agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"), F.first("bits").alias("bits"))
    classes = stage(classes.withColumn("set_no", F.monotonically_increasing_id()), "classes")
    lists = _different_lists(stage(_shared_lists(classes), "shared-lists"))
    lists = stage(_alike_lists(lists.select("key", "set_no", "n"), classes.select("set_no", "bits"), percent), "alike-lists")
    lists = _different_lists(lists)
    plain = classes.drop("keys", "bits")
    wanted = plain.join(lists.select("set_no").distinct(), "set_no", "left_semi").select("set_no", "rep", "s1", "s2")
    sets = once(stage_bucketed(_sets(docs, stage(wanted, "wanted"), words), "set_no"))
    links = star_links(lists, sets, percent, classes.select("set_no", "bits"))
    labels = components(links).withColumnRenamed("node", "set_no")
    labelled = plain.join(labels, "set_no", "left").withColumn("label", F.coalesce("label", "set_no"))
    smallest = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    labelled = labelled.join(smallest, "label").select("n_shingles", "s1", "s2", "component_id")
    joined = signed.drop("keys", "bits").join(labelled, ["n_shingles", "s1", "s2"], "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents whose id is the smallest of their component, with all their columns. Documents without an id or
    without words all stay, and rows that repeat an id stand or fall together."""
    gone = ngram_components(docs, words, percent).where(F.col("component_id") < F.col("doc_id"))
    return docs.join(gone.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
