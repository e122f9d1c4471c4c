import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestone.operators.index import build_index
from lodestone.operators.rank import bm25, match_count, rank_all, tfidf_cosine, top_k
from lodestone.plans.search import search, search_body, search_title
from tests.brute import Model
from tests.test_index import pairs


@pytest.fixture(scope="module")
def index(docs):
    return build_index(docs, "simple", norms=True)


def scores(df):
    return {(r.query_id, r.doc_id): r.score for r in df.collect()}


def test_rankers_against_brute_force(docs, queries, index):
    model, asked = Model(pairs(docs)), pairs(queries)
    assert scores(bm25(index, queries)) == pytest.approx(model.bm25(asked))
    assert scores(bm25(index, queries, k1=1.2, b=0.0)) == pytest.approx(model.bm25(asked, 1.2, 0.0))
    assert scores(tfidf_cosine(index, queries)) == pytest.approx(model.cosine(asked))
    assert scores(match_count(index, queries)) == model.counts(asked)


def test_real_texts_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    queries = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(5).toDF("query_id", "text")
    queries = spark.createDataFrame(queries.collect(), queries.schema)
    for analyzer, stemmed in (("simple", False), ("simple_stem", True)):
        index = build_index(docs, analyzer, min_df=3, norms=True)
        model = Model(pairs(docs), 3, stemmed)
        assert scores(bm25(index, queries)) == pytest.approx(model.bm25(pairs(queries)))
        assert scores(tfidf_cosine(index, queries)) == pytest.approx(model.cosine(pairs(queries)))


def test_batch_is_the_union_of_single_queries(queries, index):
    batch = scores(bm25(index, queries))
    single = {}
    for q in range(1, 6):
        single |= scores(bm25(index, queries.where(F.col("query_id") == q)))
    assert single == pytest.approx(batch)


def test_ranges(queries, index):
    assert all(s >= 0 for s in scores(bm25(index, queries)).values())
    assert all(s <= 1 + 1e-9 for s in scores(tfidf_cosine(index, queries)).values())


def test_salting_changes_nothing(queries, index):
    for ranker in (bm25, tfidf_cosine, match_count):
        assert scores(ranker(index, queries, salt_rows=1)) == pytest.approx(scores(ranker(index, queries)))


def test_length_options(spark, docs, queries, index):
    plain, zero = scores(bm25(index, queries)), scores(bm25(index, queries, length_norm="zero"))
    assert zero.keys() == plain.keys() and all(zero[k] > plain[k] for k in plain)
    twice = scores(bm25(index, queries, length_stats=[index.doc_stats, index.doc_stats]))
    assert twice == pytest.approx(plain)  # doubling every length changes no ratio
    stemmed = build_index(docs, "simple_stem")
    assert scores(bm25(stemmed.with_analyzer("simple"), queries)).keys() <= scores(bm25(stemmed, queries)).keys()


def test_top_k_ties(spark):
    rows = [(1, 7, 0.1234561, 2), (1, 5, 0.1234559, 2), (1, 9, 0.1234558, 1), (1, 8, 0.5, 3), (2, 1, 0.0, 0)]
    scored = spark.createDataFrame(rows, "query_id long, doc_id long, score double, first_term int")
    out = top_k(scored, 3, digits=5).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.doc_id) for r in out] == [(1, 1, 8), (1, 2, 9), (1, 3, 5), (2, 1, 1)]


def test_rank_all_equals_row_number(spark):
    """One query holds nearly all rows; slices cut through it."""
    scored = spark.range(5000).select(
        F.when(F.col("id") < 4900, 1).otherwise(F.col("id") % 7).alias("query_id"),
        F.col("id").alias("doc_id"),
        (F.xxhash64("id") % 5).alias("score"),
        (F.xxhash64("id", F.lit(1)) % 3).alias("first_term"),
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "first_term", "doc_id")
    want = scored.select("query_id", F.row_number().over(order).cast("long").alias("rank"), "doc_id", "score")
    got = rank_all(scored, partitions=13)
    assert got.count() == 5000 and got.exceptAll(want).isEmpty()


def test_endpoints(spark, docs, queries, index):
    titles = docs.select("doc_id", F.concat(F.lit("t"), "doc_id").alias("title")).where("doc_id <> 2")
    found = search_title(index, queries, titles).where("query_id = 5").orderBy("rank").collect()
    assert [(r.doc_id, r.score, r.title) for r in found] == [(1, 3, "t1"), (2, 2, None), (4, 2, "t4")]
    body = search_body(index, queries, titles, k=1).collect()
    assert sorted(r.query_id for r in body) == [1, 2, 5]  # nothing for stop words and the empty query


def test_search_blends_priors(spark, docs, queries, index):
    titles = docs.select("doc_id", F.lit("t").alias("title"))
    ranks = spark.createDataFrame([(4, 9.0), (1, 1.0)], "id long, pagerank double")
    views = spark.createDataFrame([(4, 100)], "id long, views long")
    fields = {"body": index, "title": index}
    text_only = search(fields, queries, ranks, views, titles, blend_weights=(1, 0, 0), k=2)
    priors = search(fields, queries, ranks, views, titles, blend_weights=(0, 0.5, 0.5))
    best = {r.query_id: r.doc_id for r in text_only.where("rank = 1").collect()}
    merged = scores(bm25(index, queries))
    assert best == {q: max((s, d) for (p, d), s in merged.items() if p == q)[1] for q in best}
    assert text_only.groupBy("query_id").count().agg(F.max("count")).first()[0] == 2
    assert {r.doc_id: r.score for r in priors.where("query_id = 5").collect()} == {4: 1.0, 1: pytest.approx(1 / 18), 2: 0}
