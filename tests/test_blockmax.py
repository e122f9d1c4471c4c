import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators.blockmax import bm25_top_k
from lodestone.operators import index as index_parts
from lodestone.operators.index import build_index, impacts
from lodestone.operators.rank import bm25, named_in, top_k
from lodestone.sources import index_store
from lodestone.sources.index_store import append_docs, compact_index, lookup_postings, read_index, write_index


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def zipf(spark):
    """3,000 documents of words with Zipf-like frequencies, of very different lengths."""
    rng = random.Random(9)
    words = [f"word{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    texts = [(i, " ".join(rng.choices(words, weights, k=rng.choice([3, 8, 30, 200])))) for i in range(3000)]
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(4).cache()


@pytest.fixture(scope="module")
def asked(spark):
    texts = ["word0 word1", "word399", "word3 word150 word151", "word0 word2 word90 word91 word92", "nosuch", "", "word7"]
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")


@pytest.mark.parametrize("k", [1, 100, 1001])
@pytest.mark.parametrize("digits", [5, None])
def test_same_rows_as_the_complete_ranking(zipf, asked, tmp_path, k, digits):
    index = write_index(zipf.where("doc_id % 5 > 0"), f"{tmp_path}/i", "simple", min_df=1)
    index = append_docs(zipf.where("doc_id % 5 = 0"), f"{tmp_path}/i")
    want = top_k(bm25(index, asked), k, digits)
    assert rows(bm25_top_k(index, asked, k, digits).withColumn("score", F.round("score", 9))) == rows(
        want.withColumn("score", F.round("score", 9))
    )


def test_other_parameters_and_indexes_in_the_session(zipf, asked):
    index = build_index(zipf, "simple")
    for options in ({"length_norm": "zero"}, {"k1": 0.9, "b": 0.2}):
        want = top_k(bm25(index, asked, **options), 10, 5)
        assert rows(bm25_top_k(index, asked, 10, 5, **options)) == rows(want)


def test_fewer_postings_are_scored(spark, zipf, tmp_path, monkeypatch):
    """Counts the rows that reach the sums."""
    from lodestone.operators import blockmax, rank

    index = write_index(zipf, f"{tmp_path}/i", "simple")
    asked = spark.createDataFrame([(1, "word0 word350"), (2, "word1 word300 word301")], "query_id long, text string")
    seen = []

    def counted(pairs, value, kind="double"):
        seen.append(pairs.count())
        return rank_sums(pairs, value, kind)

    rank_sums = rank.score_sums
    monkeypatch.setattr(rank, "score_sums", counted)
    monkeypatch.setattr(blockmax, "score_sums", counted)
    whole = top_k(bm25(index, asked), 10, 5).collect()
    every, seen[:] = sum(seen), []
    assert rows(bm25_top_k(index, asked, 10, 5)) == sorted(map(tuple, whole), key=str)
    assert sum(seen) < every / 3


def scanned(df) -> int:
    """Rows that the file scans of a query without a shuffle have given."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_rows_read_follow_the_asked_postings(spark, tmp_path, monkeypatch):
    """For any number of terms, pages without any of them stay unread."""
    monkeypatch.setattr(index_store, "PAGE_ROWS", 100)
    docs = spark.range(20_000).selectExpr(
        "id AS doc_id", "concat('term', lpad(id % 2000, 5, '0'), ' t', id % 7, 'xyz') AS text"
    )
    index = write_index(docs, f"{tmp_path}/i", "simple", n_buckets=2)
    read = {}
    for n in (5, 11, 65, 500):
        terms = [f"term{i:05d}" for i in range(n)]
        found = lookup_postings(index, terms)
        assert found.count() == 10 * n
        read[n] = scanned(lookup_postings(index, terms))
    assert read[5] <= 1200 and read[11] <= 1200 and read[65] <= 3000 and read[500] <= 9000


def test_named_in_takes_any_number_of_values(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("x"))
    for n in (0, 1, 10, 11, 999, 5000):
        assert df.where(named_in("x", [str(i) for i in range(n)])).count() == n


def test_compaction_equals_a_build(spark, docs, queries, tmp_path):
    words = docs.select("doc_id", F.posexplode(F.split("text", " ")).alias("at", "text"))
    path = f"{tmp_path}/i"
    write_index(words.where("at % 3 = 0").drop("at"), path, "simple", min_df=1, norms=True, fragments=True)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("i/*/gen=0/**/*.parquet")}
    for k in (1, 2):
        append_docs(words.where(f"at % 3 = {k}").drop("at"), path)
    assert before == {p: p.stat().st_mtime_ns for p in tmp_path.glob("i/*/gen=0/**/*.parquet")}
    built = build_index(docs, "simple", min_df=1, norms=True)
    for index in (read_index(spark, path), compact_index(spark, path), read_index(spark, path)):
        for part, cols in (
            ("postings", ["term", "doc_id", "tf", "doc_len"]),
            ("terms", ["term", "df", "term_total"]),
            ("doc_stats", ["doc_id", "doc_len", "norm"]),
        ):
            assert rows(getattr(index, part).select(*cols)) == rows(getattr(built, part).select(*cols))
        assert rows(bm25(index, queries)) == rows(bm25(built, queries))
        assert rows(bm25_top_k(index, queries, 2, 5)) == rows(top_k(bm25(built, queries), 2, 5))
    index_store.remove_replaced(spark, path)
    assert rows(read_index(spark, path).terms) == rows(built.terms)


def test_buckets_follow_the_size(docs, tmp_path, monkeypatch):
    assert write_index(docs, f"{tmp_path}/a", "simple").n_buckets == 1
    monkeypatch.setattr(index_store, "BUCKET_BYTES", 300)
    assert write_index(docs, f"{tmp_path}/b", "simple").n_buckets > 1


def test_side_tables_are_committed_whole(spark, docs, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(ValueError, match="no table"):
        index_store.read_table(spark, path)
    index_store.write_table(docs, path)
    pinned = index_store.read_table(spark, path)
    docs.limit(1).write.parquet(f"{path}/version-lost")  # a writer that ended before its commit
    assert rows(index_store.read_table(spark, path)) == rows(docs)
    index_store.write_table(docs.where("doc_id = 1"), path)
    assert rows(pinned) == rows(docs) and index_store.read_table(spark, path).count() == 1
    index_store.remove_old_versions(spark, path)
    assert index_store.read_table(spark, path).count() == 1
    with pytest.raises(Exception):  # noqa: B017
        pinned.collect()


def test_complete_rankings_are_shuffled_once(spark):
    from lodestone.operators.rank import rank_all

    scored = spark.range(1000).selectExpr("id % 3 AS query_id", "id AS doc_id", "double(id % 50) AS score", "0 AS first_term")
    ranked = rank_all(scored, partitions=5)
    assert "Exchange hashpartitioning(query_id" not in ranked._jdf.queryExecution().executedPlan().toString()
    want = sorted((r.query_id, -r.score, r.doc_id) for r in scored.collect())
    got = sorted((r.query_id, r.rank, -r.score, r.doc_id) for r in ranked.collect())
    assert [(q, s, d) for q, _, s, d in got] == want
    assert [r for _, r, _, _ in got] == [i + 1 for q in range(3) for i in range(sum(w[0] == q for w in want))]


def test_bounds_of_rarer_terms_are_not_dealt_again(zipf, tmp_path, monkeypatch):
    """Each posting is a part of its block; only the blocks of frequent terms are grouped and dealt by range."""
    dealt, whole = [], index_store._ranges
    monkeypatch.setattr(index_store, "_ranges", lambda rows, size, *by: dealt.append(by) or whole(rows, size, *by))
    monkeypatch.setattr(index_parts, "BLOCKS_PER_LENGTH", 4)
    layouts = []
    for name, most in (("rare", 3000), ("both", 200)):
        monkeypatch.setattr(index_parts, "UNGROUPED_DOCS", most, raising=False)
        write_index(zipf.where("doc_id % 5 > 0"), f"{tmp_path}/{name}", "simple", n_buckets=3)
        index = append_docs(zipf.where("doc_id % 5 = 0"), f"{tmp_path}/{name}")
        assert rows(index.impacts) == rows(impacts(index.postings, ["term", "block", "bucket"]).select(*index.impacts.columns))
        layouts.append((dealt[:], index.block_impacts.count()))
        dealt.clear()
    postings, bounds = ("bucket", "term", "doc_id"), ("bucket", "term", "block")
    assert [x for x, _ in layouts] == [[postings] * 2, [postings, bounds] * 2]
    assert layouts[1][1] < layouts[0][1] == index.postings.count()
