"""Hard negatives, MinHash near-duplicates and the prefix trie, against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import hard_negatives, minhash, prefix_trie
from lodestone.llm.bucket_links import bucket_links
from tests.llm.brute_trie import brute
from tests.llm.test_tasks import brute_components, docs_of, edited, sentence

# --- hard negatives --------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, v string, score long, g int"


def brute_negatives(rows, positives=5, negatives=10):
    fine = {}
    for vec_id, x, label in rows:
        if vec_id is None or label is None or x is None or any(e is None or not math.isfinite(e) for e in x):
            continue
        x = [float(np.float32(e)) * 256 for e in x]
        if all(abs(e) < 2**27 for e in x):
            row = (label, [math.floor(e) for e in x])
            fine[vec_id] = min(fine.get(vec_id, row), row)
    for a in fine:
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(fine[a][1], v)), i, label) for i, (label, v) in fine.items() if i != a)
        same = [(i, -s) for s, i, label in scored if label == fine[a][0]][:positives]
        for p, ps in same:
            fits = [(i, -s) for s, i, label in scored if label != fine[a][0] and 30 * ps <= -100 * s <= 90 * ps]
            for rank, (i, score) in enumerate(fits[:negatives], 1):
                yield a, p, rank, i, ps, score


@pytest.mark.parametrize("group_items", [200_000, 40])
def test_hard_negatives(spark, group_items):
    rng = random.Random(8)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    rows = []
    for i in range(900):
        x = [c + rng.gauss(0, 0.4) for c in centres[i % 3]]
        rows.append((i, x, rng.randrange(4)))
    same = [0.5, 0.25, 1.0, 0.0, 0.5, 0.125]
    rows += [(1000 + i, same, i % 2) for i in range(150)]  # equal vectors, hence ties
    rows += [(2000, [0.0] * 6, 1), (2001, [], 0), (2100, [], 2), (2002, [1.0, 2.0], 1), (2003, [1.0] * 8, 3)]
    rows += [(None, same, 1), (3000, None, 1), (3100, same, None), (3200, [1.0, None], 1), (3300, [math.nan], 1)]
    rows += [(3400, [math.inf] * 6, 1), (3500, [1e38] * 6, 1), (3600, same, 1), (3600, same, 1), (3700, same, 2), (3700, same, 1), (-100, same, 1)]
    table = spark.createDataFrame([(*r, "x", 5, 1) for r in rows], VECTORS)
    scaled = hard_negatives.scaled_rows(table)
    got = hard_negatives.hard_negatives(scaled, scaled.where("vec_id % 100 = 0"), group_items=group_items)
    assert sorted(map(tuple, got.collect())) == sorted(brute_negatives(rows))


def test_hard_negatives_of_no_rows(spark):
    none = hard_negatives.scaled_rows(spark.createDataFrame([], VECTORS))
    assert hard_negatives.hard_negatives(none, none).count() == 0
    some = hard_negatives.scaled_rows(spark.createDataFrame([(1, [1.0], 1, "", 1, 1), (2, [1.0], 2, "", 1, 1)], VECTORS))
    assert hard_negatives.hard_negatives(some, some.where("vec_id = 7")).count() == 0


def test_walks_end_early_and_miss_nothing():
    """Bounds hold for every member of a cluster, and a close cluster reads a small part of its list."""
    rng = np.random.default_rng(2)
    centre = np.zeros(16)
    centre[0] = 1
    anchors = np.floor(256 * (centre + rng.normal(0, 0.02, (20, 16)))).astype(np.int64)
    vectors = np.floor(256 * rng.normal(0, 0.3, (20_000, 16))).astype(np.int64)
    items = hard_negatives.Items(np.arange(20_000), np.ones(20_000, np.int64), vectors)
    unit, _ = hard_negatives._unit(anchors)
    centre = unit.sum(axis=0) / np.linalg.norm(unit.sum(axis=0))
    order, bound = items.walk_list("c", centre, float(np.arccos(unit @ centre).max()))
    scores = anchors @ vectors.T
    assert (scores[:, order] <= np.linalg.norm(anchors, axis=1)[:, None] * bound + 1e-6).all()
    read = []
    whole = items.scores
    items.scores = lambda a, i: read.append(len(i)) or whole(a, i)
    low, high = np.full(20, -(1 << 62)), np.full(20, 1 << 62)
    a, i, s = hard_negatives.walk(items, order, bound, anchors, np.ones(20, np.int64), np.full(20, -1), low, high, True, 5)
    want = [sorted(zip(-scores[k], range(20_000)))[:5] for k in range(20)]
    assert [(k, -s, i) for k in range(20) for s, i in want[k]] == list(zip(a.tolist(), s.tolist(), i.tolist()))
    assert sum(read) < 4000


# --- MinHash ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [10**6, 400])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "bucket_links", lambda *x: bucket_links(*x, block))
    rng = random.Random(12)
    rows = [(100, None), (101, ""), (102, " \n"), (103, "One two"), (104, "one TWO"), (105, "one"), (None, "one two"), (None, "lone words here now")]
    for n in (8, 12, 22, 60, 150, 400):
        base = sentence(rng, n)
        for e in (0, 0, 1, 1, 2, 3, 5, 8, 12, 20):
            rows.append((len(rows), edited(rng, base, e)))
    rows += [(5, "repeated id with other words than before"), (200, "w " * 6000), (201, "w " * 3000)]
    got = minhash.near_duplicates(docs_of(spark, rows), 4, 80).collect()
    assert sorted([tuple(r)[:3] for r in got], key=str) == brute_components(rows, 4, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert minhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_chains_of_links(spark):
    """Each text is linked with its neighbours only, so hubs of buckets are linked with few of their members."""
    rng = random.Random(2)
    words = sentence(rng, 60).split(" ")
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words)))
        words[rng.randrange(60)] = f"new{i}"
    got = minhash.near_duplicates(docs_of(spark, rows), 4, 80).collect()
    assert sorted([tuple(r)[:3] for r in got], key=str) == brute_components(rows, 4, 80)


def test_bands_find_links():
    rng = np.random.default_rng(6)
    missed = tried = 0
    for n in (4, 5, 9, 20, 50, 300):
        for _ in range(150):
            union = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
            gone = len(union) * 20 // 100
            order = rng.permutation(union)
            cut = int(rng.integers(0, gone + 1))
            one, other = np.sort(order[cut:]), np.sort(np.concatenate([order[:cut], order[gone:]]))
            a, b = minhash.band_keys([one, other])
            tried += 1
            missed += not len(np.intersect1d(a, b))
    assert missed / tried < 0.002
    a, b = minhash.band_keys([np.array([7], np.uint64), np.zeros(0, np.uint64)])
    assert len(a) == minhash.BINS // minhash.ROWS and len(b) == 0


# --- prefix trie -----------------------------------------------------------------------------------


def conversations(spark, rows):
    fields = "conv_id long, turn long, role string, text string, depth string, n string, k1 string"
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], fields)


@pytest.mark.parametrize("batch", ["10000", "3"])
def test_prefix_trie(spark, batch):
    rng = random.Random(int(batch))
    rows = []
    for c in [*range(60), 71, 72, 10**12, -7, -5]:
        for turn in range(rng.choice([0, 1, 2, 3, 9, 12, 30]) if c != 5 else 90):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "é", "", None])))
    rows += [(71, None, "user", "first"), (71, None, "user", "first"), (72, 0, "user", "a"), (None, 0, "user", "no id")]
    rows += [(c, t, "user", f"same {t}") for c in range(200, 300) for t in range(40)]  # copies of one conversation
    rows = [r for r in rows if r[0] != 72 or r[1] != 0] + [(72, 0, "user", "a")] * 2
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    sequences = prefix_trie.turn_sequences(conversations(spark, rows))
    got = prefix_trie.prefix_trie(prefix_trie.with_shared_heads(sequences)).collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_prefix_trie_of_few_rows(spark):
    assert prefix_trie.prefix_trie(prefix_trie.turn_sequences(conversations(spark, []))).count() == 0
    one = prefix_trie.turn_sequences(conversations(spark, [(4, 0, "user", "abc")])).withColumn("turns", F.slice("turns", 1, 0))
    assert [tuple(r)[:7] for r in prefix_trie.prefix_trie(one).collect()] == [(4, 0, None, 1, 0, 1, 0)]
