"""N-gram join, shared passages, tokenizers, sharding and the pipeline, against plain Python."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lodestone.llm import bitmaps, bpe, bucket_links, ngram_join, sharding, substring_dedup, token_files
from lodestone.llm.chunks import chunks
from lodestone.llm.common import table
from lodestone.llm.components import components
from lodestone.session import stage

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_shingles int, seed string, shard_no int, ids string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, None, 2, "x") for i, t in rows], DOCS)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))


def edited(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = "zz" + str(rng.randrange(1000))
    return " ".join(words)


# --- n-gram join -----------------------------------------------------------------------------------


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, min(len(words), 1)))}


def brute_components(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                group = [group[j] if g == group[i] else g for g in group]
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    return sorted(((d, len(s), least[g]) for (d, _), s, g in zip(rows, sets, group)), key=str)


@pytest.mark.parametrize(("k", "percent", "hot"), [(3, 90, 10**6), (5, 80, 10**6), (3, 90, 0)])
def test_ngram_components(spark, monkeypatch, k, percent, hot):
    monkeypatch.setattr(ngram_join, "HOT_ROWS", hot)
    rng = random.Random(k)
    rows = [(100, None), (101, ""), (102, " \n"), (103, "One two"), (104, "one TWO"), (105, "one"), (None, "one two"), (None, "lone words here now")]
    base = [sentence(rng, n) for n in (8, 12, 22, 24, 60, 150, 400)]
    for text in base:
        for e in (0, 0, 1, 1, 2, 3, 5, 8):
            rows.append((len(rows), edited(rng, text, e)))
    rows += [(5, "repeated id with other words than before"), (200, "w " * 6000)]
    got = ngram_join.ngram_components(docs_of(spark, rows), k, percent).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows, k, percent)


def test_ngram_empty_table_and_scheme(spark):
    assert ngram_join.ngram_components(docs_of(spark, [])).count() == 0
    assert ngram_join.Scheme(90).light == 9 and ngram_join.Scheme(90).subset_sizes(9) == [9]
    assert ngram_join.Scheme(90, 20.0).light > ngram_join.Scheme(90, 2.0).light > 1


@pytest.mark.parametrize("length", [1.0, 3.0, 50.0])
def test_linked_sets_share_a_list(length):
    """For any boundary, and any frequencies."""
    rng = np.random.default_rng(4)
    for percent in (80, 90):
        plan = ngram_join.Scheme(percent, length)
        for n in [1, 2, 5, 8, 9, 10, 11, 12, 19, 20, 21, 25, 60, 300]:
            for _ in range(20):
                frequency = rng.integers(0, 4, ngram_join.SLOTS)
                one = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
                other = np.union1d(rng.permutation(one)[: rng.integers(n * 7 // 10, n + 1)], rng.integers(0, 2**63, rng.integers(0, n // 5 + 1)).astype(np.uint64))
                both = len(np.intersect1d(one, other))
                if both and 100 * both >= percent * (len(one) + len(other) - both):
                    assert len(np.intersect1d(plan.keys(one, frequency), plan.keys(other, frequency)))


def random_sets(rng):
    """Sets of several sizes, some of them alike."""
    sets = []
    for n in (1, 3, 20, 33, 70, 300, 3000):
        for _ in range(4):
            one = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            sets.append(one)
            for share in (0.02, 0.1, 0.3):
                gone = int(share * n * rng.random())
                sets.append(np.union1d(rng.permutation(one)[gone:], rng.integers(0, 2**63, gone).astype(np.uint64)))
    return sorted(sets, key=len)


def linked(one, other, percent):
    both = len(np.intersect1d(one, other))
    return 100 * both >= percent * (len(one) + len(other) - both)


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_bitmaps_allow_all_links(percent):
    sets = random_sets(np.random.default_rng(percent))
    n = np.array([len(s) for s in sets])
    maps = bitmaps.Bitmaps(n, [bitmaps.bitmap(s).tobytes() for s in sets], percent)
    part, every, allowed, found = bitmaps.parts(maps), np.ones(len(sets), bool), 0, 0
    for i in range(len(sets)):
        near = set(maps.near(i, every))
        links = {j for j in range(len(sets)) if linked(sets[i], sets[j], percent)}
        assert links <= near and all(part[j] == part[i] for j in near)
        allowed, found = allowed + len(near), found + len(links)
    assert allowed < 1.5 * found


@pytest.mark.parametrize("block", [10**6, 10])
def test_lists_are_split_where_no_link_is(spark, block):
    rng = np.random.default_rng(block)
    sets = random_sets(rng)
    lists = {key: sorted(rng.permutation(len(sets))[:size].tolist()) for key, size in enumerate((5, 9, 40, len(sets)))}
    rows = [(key, i, len(sets[i])) for key, members in lists.items() for i in members]
    rows = stage(spark.createDataFrame(rows, "key long, set_no long, n long"), "rows")
    marks = spark.createDataFrame([(i, bytearray(bitmaps.bitmap(s).tobytes())) for i, s in enumerate(sets)], "set_no long, bits binary")
    got = {}
    for r in ngram_join._alike_lists(rows, marks, 80, block).collect():
        assert r.n == len(sets[r.set_no])
        got.setdefault(r.key, []).append(r.set_no)
    assert all(len(x) == len(set(x)) > 1 for x in got.values())
    assert max(map(len, got.values())) <= 4
    for members in lists.values():
        for i in members:
            for j in members:
                if i < j and linked(sets[i], sets[j], 80):
                    assert any(i in x and j in x and set(x) <= set(members) for x in got.values())


def test_few_sets_are_read(spark, monkeypatch):
    """Of documents that share a passage, in lists of it as frequencies don't tell, only those with a link are read."""
    monkeypatch.setattr(ngram_join, "frequencies", lambda docs, words: np.zeros(ngram_join.SLOTS, np.int64))
    read = []
    whole = ngram_join._sets
    monkeypatch.setattr(ngram_join, "_sets", lambda docs, wanted, words: read.append(wanted.count()) or whole(docs, wanted, words))
    rng = random.Random(6)
    common = sentence(rng, 60)
    rows = [(i, common + " " + sentence(rng, 60)) for i in range(80)]
    rows += [(100 + i, rows[i][1] + " more") for i in range(3)]
    got = ngram_join.ngram_components(docs_of(spark, rows), 3, 90).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows, 3, 90)
    assert read[0] < 12


@pytest.mark.parametrize("pairs", [20_000_000, 40])
def test_chains_of_near_copies(spark, monkeypatch, pairs):
    """Hubs of lists are linked with few of their members, and dealt over tasks."""
    monkeypatch.setattr(bucket_links, "TASK_PAIRS", pairs)
    rng = random.Random(2)
    words, rows = sentence(rng, 60).split(" "), []
    for i in range(60):
        rows.append((i, " ".join(words)))
        words[rng.randrange(60)] = f"new{i}"
    got = ngram_join.ngram_components(docs_of(spark, rows), 3, 85).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows, 3, 85)


def test_shared_lists_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    rng = random.Random(3)
    rows = [(i, 5, [rng.randrange(40) for _ in range(2)]) for i in range(60)]
    rows = [(i, n, sorted(set(k))) for i, n, k in rows]
    got = ngram_join._shared_lists(spark.createDataFrame(rows, "set_no long, n_shingles long, keys array<long>")).collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    count = {}
    for _, _, keys in rows:
        for k in keys:
            count[k] = count.get(k, 0) + 1
    assert sorted((r.key, r.set_no) for r in got) == sorted((k, i) for i, _, keys in rows for k in keys if count[k] > 1)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    found = [dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long"), n).collect())) for n in (0, 10**6)]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    want = {n: v for n, v in label.items() if any(n in e for e in edges if e[0] != e[1])}
    assert found == [want, want]


# --- shared passages -------------------------------------------------------------------------------


def test_shared_passages(spark):
    rng = random.Random(9)
    passage, whole = sentence(rng, 80), sentence(rng, 120)
    own = lambda n: sentence(rng, n)
    rows = [(i, f"{own(60)} {passage} {own(40)}") for i in range(6)]
    rows += [(10, f"{own(30)}\n{edited(rng, passage, 2)} {own(9)}"), (11, own(300)), (12, None), (13, ""), (14, " ".join(passage.split()[:30]))]
    rows += [(20, whole), (21, whole.upper()), (22, whole), (20, own(70)), (None, f"{passage} {own(10)}"), (30, "w " * 5000), (31, "w " * 4000)]
    got = substring_dedup.shared_passages(docs_of(spark, rows)).collect()
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append((r.start, r.end))
        assert r.end - r.start >= 50 and r.similarity >= 0.8
    assert set(found) == {0, 1, 2, 3, 4, 5, 10, 20, 21, 22, None, 30, 31}
    assert all(min(s for s, _ in found[i]) == 60 and max(e for _, e in found[i]) == 140 for i in range(6))
    assert found[21] == [(0, 120)]
    assert substring_dedup.shared_passages(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize(("similarity", "n", "least"), [(1.0, 50, 1.0), (0.95, 50, 0.95), (0.9, 50, 0.9), (0.9, 100, 0.95), (0.85, 100, 0.9)])
def test_recall_of_edited_passages(spark, similarity, n, least):
    """Pairs of documents with a passage whose words are replaced at random places: found if 80 % of it is covered."""
    rng = random.Random(int(100 * similarity) + n)
    rows = []
    for x in range(40):
        words = sentence(rng, n).split(" ")
        other = list(words)
        for at in rng.sample(range(1, n - 1), round((1 - similarity) * n)):
            other[at] = f"zz{rng.randrange(10**6)}"
        rows.append((2 * x, f"{sentence(rng, 70)} {' '.join(words)} {sentence(rng, 30)}"))
        rows.append((2 * x + 1, f"{sentence(rng, 20)} {' '.join(other)} {sentence(rng, 60)}"))
    got = substring_dedup.shared_passages(docs_of(spark, rows)).collect()
    covered = {}
    for r in got:
        assert r.similarity >= 0.8 and r.doc_id // 2 == r.other_id // 2
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    found = sum(len(covered.get(2 * x, set()) & set(range(70, 70 + n))) >= 0.8 * n for x in range(40))
    assert found >= least * 40


def test_two_passages_of_a_pair(spark):
    """Two shared passages, close enough to be one chain that as a whole is too little alike."""
    rng = random.Random(7)
    own = lambda n: sentence(rng, n)
    gaps = [(25, 25), (31, 31), (45, 45), (60, 60), (40, 0), (0, 55)]
    rows = []
    for x, (n, m) in enumerate(gaps):
        one, two = own(60), own(60)
        rows += [(2 * x, f"{own(30)} {one} {own(n)} {two} {own(20)}"), (2 * x + 1, f"{own(10)} {one} {own(m)} {two} {own(30)}")]
    got = substring_dedup.shared_passages(docs_of(spark, rows)).collect()
    assert all(r.similarity >= 0.8 for r in got)
    for x, (n, m) in enumerate(gaps):
        for doc, start, between in ((2 * x, 30, n), (2 * x + 1, 10, m)):
            covered = {w for r in got if r.doc_id == doc for w in range(r.start, r.end)}
            assert covered >= {*range(start, start + 60), *range(start + 60 + between, start + 120 + between)}


def test_parts_of_a_chain():
    """A passage with a wide edit beside words with many small ones: the widest gap is no place to cut."""
    a = np.arange(1000)
    b = a.copy()
    b[128:138] += 5000
    b[166:400:3] += 5000
    b[420:430] += 5000
    places = np.array([100, 110, 118, 138, 150, 156, 400, 410, 430, 440, 450, 460, 470])
    parts = substring_dedup._parts(a, b, places, places, 50, 0.8, 10)
    assert parts == [(0, 5), (6, 12)]


def test_chains_after_a_long_passage(spark):
    """The end of a long shared section is too far away for a later passage, but doesn't part its matches."""
    far = [*range(0, 500, 8)]
    chains = substring_dedup.chain([*far, 700, 718, 734], [*far, 640, 658, 674], 10)
    assert sorted(chains) == [(0, 506, 0, 506, 63), (700, 744, 640, 684, 3)]
    rng = random.Random(12)
    own = lambda n: sentence(rng, n)
    long, rows = own(500), []
    for x in range(8):
        one, two = own(36), own(36)
        rows += [(y, f"{own(20)} {long} {own(80)} {one} {own(6)} {two} {own(20)}") for y in (2 * x, 2 * x + 1)]
        long = own(500)
    got = substring_dedup.shared_passages(docs_of(spark, rows)).collect()
    assert {r.doc_id for r in got if r.start <= 600 and r.end >= 678} == set(range(16))


def test_every_two_documents_of_a_passage(spark, monkeypatch):
    """Documents that sort between two others and have parts of their passage don't part them; rows are the same for any blocks."""
    rng = random.Random(15)
    own = lambda n: sentence(rng, n)
    rows, want = [], set()
    for x in range(12):
        words = own(60).split(" ")
        rows += [(100 * x + y, f"{own(20)} {' '.join(words)} {own(20 + y)}") for y in range(5)]
        rows += [(100 * x + 10 + y, f"{own(25)} {' '.join(words[at : at + 40])} {own(25)}") for y in range(8) for at in (0, 20)]
        want |= {(100 * x + y, 100 * x + z) for y in range(5) for z in range(5) if y != z}
    each = []
    for words, matches in ((8_000_000, 1_000_000), (1500, 200)):
        monkeypatch.setattr(substring_dedup, "BLOCK_WORDS", words, raising=False)
        monkeypatch.setattr(substring_dedup, "STEP_MATCHES", matches, raising=False)
        each.append(sorted(map(tuple, substring_dedup.shared_passages(docs_of(spark, rows)).collect())))
    assert each[0] == each[1]
    assert {(r[0], r[3]) for r in each[0] if r[0] % 100 < 10 and r[3] % 100 < 10} == want
    assert all(r[1] <= 20 and r[2] >= 80 for r in each[0] if (r[0], r[3]) in want)


def test_seed_neighbours_for_any_partitions(spark):
    """Each document of a seed meets the two before it, wherever the ranges of tasks begin."""
    rng = random.Random(6)
    rows = [(s, n, p) for s, most in ((5, 40), (6, 3), (7, 1), (8, 200), (9, 2)) for n in range(most) for p in rng.sample(range(99), rng.choice([1, 1, 2]))]
    seeds = spark.createDataFrame(rows, "seed long, no long, place long").repartition(3)
    want = {(s, a, b) for s, b, _ in rows for a in (b - 1, b - 2) if a >= 0}
    each = []
    for tasks in (1, 2, 7, 60):
        got = substring_dedup._neighbours(seeds, tasks)
        assert got.columns == ["a", "b", "i", "j"]
        each.append(sorted(map(tuple, got.collect())))
    assert all(x == each[0] for x in each)
    assert {(a, b) for a, b, _, _ in each[0]} == {(a, b) for _, a, b in want}


def test_edits_and_chains():
    rng = random.Random(3)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for x, c in enumerate(a, 1):
            new = [x]
            for y, d in enumerate(b, 1):
                new.append(min(row[y] + 1, new[-1] + 1, row[y - 1] + (c != d)))
            row = new
        return row[-1]

    for _ in range(60):
        a = [rng.randrange(3) for _ in range(rng.randrange(30))]
        b = [x if rng.random() < 0.8 else 9 for x in a][: rng.randrange(20, 40)] + [1] * rng.randrange(3)
        assert substring_dedup.edits(np.array(a, int), np.array(b, int), 40) == plain(a, b)
    assert substring_dedup.chain([0, 12, 24, 500], [100, 112, 125, 3], 10) == [(0, 34, 100, 135, 3), (500, 510, 3, 13, 1)]


# --- tokenizers ------------------------------------------------------------------------------------

TEXTS = [
    None, "", " ", "\n", "a\n\nb", "a\n\n\nb", "x\n\n", " lead", "trail ", "two  spaces", "tab\there", "nbsp\xa0x", "nul\x00x",
    "it's we'll 12345 ümläut 日本語 😀!!", "x" * 3000, "end <|endoftext|> of", "word. " * 500, "a b", "a b",
]


def tiktoken_encoding():
    with open(bpe.RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def some_texts(spark):
    return TEXTS + [r.text for r in table(spark, SF, "documents").select("text").collect()]


def test_bpe(spark):
    texts, other = some_texts(spark), tiktoken_encoding()
    rows = bpe.decode(bpe.encode(docs_of(spark, [*enumerate(texts), (None, "x y")]))).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert list(r.ids) == other.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode(docs_of(spark, [])).count() == 0


def test_long_pieces():
    """Runs without spaces, of thousands of letters, as the library encodes them."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.Bpe(path)
    rng = random.Random(2)
    texts = ["".join(rng.choice(letters) for _ in range(n)) for letters in ("abcdefghij", "etaoinshrdlu", "ab", "aé漢") for n in (2050, 9000)]
    texts += ["a" * 5000, "ab" * 4000, "aab" * 2000, "thethe" * 1500, "=" * 3333]
    for text in texts:
        assert own.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_chunks_join_to_the_text():
    assert all("".join(chunks(t)) == t for t in TEXTS if t)


def test_token_files(spark, tmp_path):
    texts = [*some_texts(spark), "end <|endoftext|> of", "<|endoftext|>", "a<|endoftext|>\n<|endoftext|> b"]
    rows = list(enumerate(texts))
    random.Random(0).shuffle(rows)
    token_files.write_token_files(docs_of(spark, [*rows, (None, "no id"), (3, "again")]), f"{tmp_path}/f", shard_ids=20_000)
    got = token_files.read_token_files(spark, f"{tmp_path}/f").orderBy("start").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tie = {t: spark.range(1).select(F.xxhash64(F.lit(t))).first()[0] for t in ("again", dict(rows)[3])}
    start, want = 0, []
    for i, text in sorted([*rows, (-1, "no id"), (3, "again")], key=lambda x: (x[0], tie.get(x[1], 0))):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want.append((None if i < 0 else i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want


def test_re_pair():
    rng = np.random.default_rng(0)
    for ids in [[], [5], [1, 1, 1, 1, 1], rng.integers(0, 4, 5000), np.tile(rng.integers(0, 70_000, 40), 200)]:
        ids = np.array(ids, np.uint32)
        payload = token_files.compress(ids, min_count=2)
        assert (token_files.decompress(payload) == ids).all()
        for _ in range(30 if len(ids) else 0):
            a, b = sorted(rng.integers(0, len(ids) + 2, 2).tolist())
            assert (token_files.read_range(payload, a, b) == ids[a:b]).all()
    assert len(payload) < 4 * len(ids) / 10


# --- sharding --------------------------------------------------------------------------------------


def test_sharding(spark):
    rows = [(i, "x" * (i % 50)) for i in range(400)] + [(7, "same")] * 60 + [(None, "y" * 30)] * 20 + [(999, "z" * 5000), (1000, None)]
    got = sharding.assign_shards(docs_of(spark, rows), 300).collect()
    assert len(got) == len(rows) and len({r.row_no for r in got}) == len(rows)
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r.bytes)
    assert all(sum(x) <= 300 or len(x) == 1 for x in shards.values())
    names = sorted(shards)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))  # no prefix of another
    halves = {n[:-1] for n in names if n}
    for h in halves:  # only buckets that were too large are split
        inside = [b for n, x in shards.items() if n.startswith(h) for b in x]
        assert sum(inside) > 300 and len(inside) > 1
    assert sharding.assign_shards(docs_of(spark, [])).count() == 0


def brute_shards(rows, limit):
    """Splits buckets bit by bit; the row's own number is the last part of the hash."""

    def bits(text):
        return f"{int(hashlib.md5(text.encode()).hexdigest()[:15], 16):060b}"

    hashed = [(bits("" if i is None else str(i)) + bits(t or ""), len((t or "").encode())) for i, t in rows]
    out = {}

    def split(prefix, members):
        if sum(hashed[m][1] for m in members) <= limit or len(members) == 1:
            for m in members:
                out[m] = prefix
            return
        for bit in "01":
            part = [m for m in members if hashed[m][0][len(prefix)] == bit]
            if part:
                split(prefix + bit, part)

    split("", range(len(rows)))
    return sorted((rows[m][0], hashed[m][1], prefix) for m, prefix in out.items())


def test_shards_by_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, "é" * rng.choice([0, 1, 5, 40, 300])) for i in range(500)] + [(9, f"text {i}") for i in range(80)]
    for limit in (100, 2000, 10**6):
        got = sharding.assign_shards(docs_of(spark, rows), limit).collect()
        assert sorted((r.doc_id, r.bytes, r.shard) for r in got) == brute_shards(rows, limit)


def test_written_shards_with_clashing_names(spark, tmp_path):
    rows = [(1, "a", "s", 5, 7, "z"), (2, None, None, None, None, None), (None, "b" * 50, "s", 1, 1, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Shard string, _row_no int, no int, doc string")
    assert sharding.write_shards(docs, f"{tmp_path}/s", 20) == "shard_1"
    back = spark.read.parquet(f"{tmp_path}/s")
    assert back.columns == [*docs.columns, "shard_1"]
    assert sorted(map(tuple, back.drop("shard_1").collect()), key=str) == sorted(rows, key=str)


def test_written_shards(spark, tmp_path):
    docs = table(spark, SF, "documents")
    sharding.write_shards(docs, f"{tmp_path}/s", 100_000)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert sorted(back.drop("shard").collect()) == sorted(docs.collect())
    assert back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("b")).agg(F.max("b")).first()[0] <= 100_000
    assert back.select("shard").distinct().count() > 3


def test_written_shards_of_split_files(spark, tmp_path, monkeypatch):
    """The staged rows are split otherwise once the shards are known, as they are when executors are lost."""
    docs = spark.range(2000).selectExpr("id AS doc_id", "repeat(cast(id AS string), 30) AS text", "'x' AS row_no").repartition(7)
    plain, size = sharding.assign_shards, "spark.sql.files.maxPartitionBytes"

    def split_otherwise(*args):
        shards = plain(*args)
        spark.conf.set(size, 2000)
        return shards

    monkeypatch.setattr(sharding, "assign_shards", split_otherwise)
    before = spark.conf.get(size)
    try:
        sharding.write_shards(docs, f"{tmp_path}/s", 20_000)
    finally:
        spark.conf.set(size, before)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert sorted(map(tuple, back.select("doc_id", "text", "row_no").collect())) == sorted(map(tuple, docs.collect()))
    want = {r.doc_id: r.shard for r in plain(docs, 20_000).collect()}
    assert {r.doc_id: r.shard[1:] for r in back.collect()} == want


# --- pipeline --------------------------------------------------------------------------------------


def test_stages_of_odd_rows(spark):
    """Null and empty texts, rows without an id, repeated rows and ids, and an empty table."""
    rng = random.Random(31)
    prose = [". ".join(sentence(rng, 12) for _ in range(12)) + "." for _ in range(4)]
    rows = [(1, prose[0]), (1, prose[0]), (2, prose[0] + " more"), (3, prose[1]), (None, prose[2]), (None, prose[2]), (4, None), (5, ""), (3, prose[3])]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    stages = dict(corpus_pipeline.STAGES)
    one = stages["near_duplicates"](spark, docs, SF)
    kept = sorted(((r.doc_id, r.text) for r in one.collect()), key=str)
    assert kept == sorted([(1, prose[0]), (1, prose[0]), (3, prose[1]), (None, prose[2]), (None, prose[2]), (4, None), (5, ""), (3, prose[3])], key=str)
    assert one.columns == docs.columns
    tokens = stages["tokenize"](spark, docs, SF).collect()
    assert len(tokens) == len(rows) and {r.n_tokens for r in tokens if r.doc_id in (4, 5)} == {0}
    for name, f in corpus_pipeline.STAGES[:-1]:
        assert f(spark, docs, SF).columns == docs.columns, name
        assert f(spark, docs.limit(0), SF).count() == 0, name
    assert stages["tokenize"](spark, docs.limit(0), SF).count() == 0


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SF)
        assert left.columns == docs.columns
    rows, other = left.collect(), tiktoken_encoding()
    assert sorted(got) == sorted(r.doc_id for r in rows) and 0 < len(got) < docs.count()
    assert all(got[r.doc_id].n_tokens == len(other.encode_ordinary(r.text)) for r in rows)
    sets = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    assert all(d == c for d, _, c in brute_components(sets, 5, 80))
