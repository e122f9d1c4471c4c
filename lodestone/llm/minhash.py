"""Near-duplicates by one-permutation MinHash: bands of densified bins, stars of candidates, links confirmed on full sets.

The hashes of a set's shingles fall into BINS ranges; the smallest in each range is the bin's value, so one pass over one
hash function gives all of them. An empty bin copies a filled one that a fixed sequence of random places meets first
(optimal densification), so that two sets agree in a bin with the probability of their similarity, filled or not. ROWS
bins make a band. Sets at the similarity s share none of the bands with probability (1 - s^ROWS)^(BINS / ROWS): at 0.8
that is 2e-5, at 0.85 2e-8; at 0.5, where many texts with a common passage are, four of five do share none.

Equal sets are one class from the start. The classes of a bucket are candidates of each other: each bucket sends a star,
its hub with the other members, and what stars leave open is scanned (see bucket_links). No candidate link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.bucket_links import bucket_links, once
from lodestone.llm.components import components
from lodestone.llm.ngram_join import _as_lists, _different_lists, _sets, _shared_lists, _signed, _steps
from lodestone.llm.shingles import mix, shingle_sets
from lodestone.session import stage, stage_bucketed

WORDS = 5
PERCENT = 80
BINS = 480
ROWS = 8
#: Sets whose bins are in memory at a time, 4 kB each.
STEP_SETS = 2000

_U = np.uint64
#: Random places for empty bins, attempt by attempt: (slope, offset) of a hash function each.
_ATTEMPTS = np.random.default_rng(20240715).integers(1, 2**31 - 1, (4 * BINS, 2))


def bins(sets: list[np.ndarray]) -> np.ndarray:
    """The bins of each set, one row a set: the smallest hash in each range, from sorted hashes; empty bins filled. The
    sets are not empty."""
    n = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    place = np.repeat(np.arange(len(sets)) * BINS, n) + ((flat >> _U(32)) * _U(BINS) >> _U(32)).astype(np.int64)
    first = np.ones(len(flat), bool)
    first[1:] = place[1:] != place[:-1]
    out = np.zeros(len(sets) * BINS, _U)
    filled = np.zeros(len(sets) * BINS, bool)
    out[place[first]] = flat[first]
    filled[place[first]] = True
    row, column = np.divmod(np.flatnonzero(~filled), BINS)
    for slope, offset in _ATTEMPTS.tolist():
        if not len(row):
            break
        source = row * BINS + (slope * (column + 1) + offset) % (2**31 - 1) % BINS
        hit = filled[source]
        out[row[hit] * BINS + column[hit]] = out[source[hit]]
        row, column = row[~hit], column[~hit]
    if len(row):  # a set of few shingles that no attempt has met: its first filled bin
        ends = np.cumsum(n)
        out[row * BINS + column] = flat[ends[row] - n[row]]
    return out.reshape(len(sets), BINS)


def band_keys(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The bucket keys of each set, one a band; none of an empty set."""
    some = [i for i, s in enumerate(sets) if len(s)]
    out = [np.zeros(0, _U)] * len(sets)
    for first in range(0, len(some), STEP_SETS):
        part = some[first : first + STEP_SETS]
        values = bins([sets[i] for i in part])
        total = np.zeros((len(part), BINS // ROWS), _U)
        for j in range(ROWS):
            total += mix(values[:, j::ROWS], 300 + j)
        keys = mix(total + np.arange(BINS // ROWS, dtype=_U) * _U(0x9E3779B97F4A7C15))
        for i, own in zip(part, keys):
            out[i] = own
    return out


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, bands): the set's size, two sums that stand for its content, and its bucket keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _steps(batch):
                sets = shingle_sets(texts, words)
                sizes = pa.array([len(s) for s in sets], pa.int64())
                columns = [part.column(0), sizes, _signed(sets, 11), _signed(sets, 12), _as_lists(band_keys(sets))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "s1", "s2", "bands"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_shingles long, s1 long, s2 long, bands array<long>")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs`` (doc_id, text).

    Sets are those of ``words``-word shingles of the lower-cased (A-Z) words, of the whole sequence if it is shorter; two
    documents are linked if 100 times their common shingles are at least ``percent`` times those of either. Null and
    empty texts have no shingles and are linked with nothing: ``n_shingles`` 0, ``component_id`` their own id.
    ``component_id`` is the smallest doc_id that links reach, and the document that has it is ``kept``. Rows without a
    doc_id link like others but are never the smallest; they are kept if their component has no id. Rows that repeat an
    id are documents of their own, all kept if they have the smallest id.
    """
    signed = stage(signatures(docs, words), "signatures")
    classes = signed.where("n_shingles > 0").groupBy("n_shingles", "s1", "s2")
    classes = classes.agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = stage(classes.withColumn("set_no", F.monotonically_increasing_id()), "classes")
    buckets = _different_lists(stage(_shared_lists(classes.withColumnRenamed("bands", "keys")), "buckets"))
    plain = classes.drop("bands")
    wanted = plain.join(buckets.select("set_no").distinct(), "set_no", "left_semi")
    wanted = stage(wanted.select("set_no", "rep", "s1", "s2"), "wanted")
    sets = once(stage_bucketed(_sets(docs, wanted, words), "set_no"))
    labels = components(bucket_links(buckets, sets, percent)).withColumnRenamed("node", "set_no")
    labelled = plain.join(labels, "set_no", "left").withColumn("label", F.coalesce("label", "set_no"))
    smallest = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    labelled = labelled.join(smallest, "label").select("n_shingles", "s1", "s2", "component_id")
    joined = signed.drop("bands").join(labelled, ["n_shingles", "s1", "s2"], "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    found = joined.select("doc_id", "n_shingles", own.alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
