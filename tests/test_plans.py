"""What Spark makes of the operators: what is read, shuffled, broadcast and split."""

import contextlib
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lodestone import session
from lodestone.operators.index import build_index
from lodestone.operators.rank import bm25, candidates, known_query_terms, match_count, top_k
from lodestone.operators.termstats import doc_terms
from lodestone.session import scratch, stage, stage_bucketed
from lodestone.sources import corpus, index_store
from lodestone.sources.index_store import append_docs, write_index


@contextlib.contextmanager
def settings(spark, **conf):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df, run=False):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def hot(spark):
    """Documents of five words, one of which is in all of them."""
    other = [F.concat(F.lit("word"), (F.col("id") * k % 997).cast("string")) for k in (1, 3, 5, 7)]
    docs = spark.range(0, 6000, 1, 8).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("everywhere"), *other).alias("text")
    )
    queries = spark.range(1, 7).select(F.col("id").alias("query_id"), F.concat(F.lit("everywhere word"), "id").alias("text"))
    return docs, queries


def test_small_query_batches_leave_postings_in_place(spark, hot):
    docs, queries = hot
    index = build_index(docs, "simple")
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "20000"}):  # below the postings' size
        joined = plan(bm25(index, queries))
    assert "BroadcastHashJoin" in joined and "BuildRight" in joined
    assert joined.count("Exchange hashpartitioning") == 1  # the sum per query and document


def test_frequent_terms_are_split_in_large_batches(spark, hot):
    docs, queries = hot
    index = build_index(docs, "simple")
    want = {tuple(r) for r in match_count(index, queries).collect()}
    with settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5000",
        },
    ):
        counted = match_count(index, queries)
        assert "SortMergeJoin(skew=true)" in plan(counted, run=True)
        assert {tuple(r) for r in counted.collect()} == want
        salted = match_count(index, queries, salt_rows=500)
        assert {tuple(r) for r in salted.collect()} == want
        per_salt = plan(salted, run=True)
        assert "salt" in per_salt


def test_pairs_of_small_batches_are_grouped_where_they_are(spark, hot):
    """Postings are dealt by document before they meet the queries, salted or not."""
    docs, queries = hot
    index = build_index(docs, "simple")
    for options in ({}, {"salt_rows": 500}):
        joined = plan(bm25(index, queries, **options))
        assert "Exchange hashpartitioning(doc_id" in joined and "Exchange hashpartitioning(query_id" not in joined


def test_salt_has_no_more_parts_than_tasks(spark, hot):
    docs, queries = hot
    index = build_index(docs, "simple")
    scored = match_count(index, queries, salt_rows=1)
    assert scored.exceptAll(match_count(index, queries)).isEmpty() and scored.count() == 6000 * 6
    salts = candidates(index, known_query_terms(index, queries), salt_rows=1).select("salt").distinct().count()
    assert salts <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_kept_terms_have_files_of_their_own(spark, hot, tmp_path):
    """So that the planner knows that they are small."""
    docs, _ = hot
    path = str(tmp_path / "i")
    write_index(docs.where("doc_id % 2 = 0"), path, "simple", min_df=100, norms=True)
    index = append_docs(docs.where("doc_id % 2 = 1"), path)
    assert all("/kept/gen=1/" in file for file in index.terms.inputFiles())
    assert [tuple(r) for r in index.terms.collect()] == [("everywhere", 6000, 6000)]


def test_ranges_follow_the_size(spark, hot, tmp_path, monkeypatch):
    docs, _ = hot
    monkeypatch.setattr(index_store, "RANGE_BYTES", 4000)
    index = write_index(docs, str(tmp_path / "i"), "simple", n_buckets=1)
    files = glob.glob(f"{tmp_path}/i/postings/gen=0/bucket=0/*.parquet")
    assert len(files) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert index.postings.count() == build_index(docs, "simple").postings.count()


def test_top_k_is_cut_before_the_shuffle(spark, hot):
    docs, queries = hot
    scored = bm25(build_index(docs, "simple"), queries)
    assert plan(top_k(scored, 10)).count("WindowGroupLimit") == 2
    small = top_k(scored, 2000)
    assert small.where("rank > 2000").isEmpty() and small.where("query_id = 1").count() == 2000
    assert {tuple(r) for r in small.where("rank <= 5").collect()} == {tuple(r) for r in top_k(scored, 5).collect()}


def test_bucketed_tables_are_joined_without_a_shuffle(spark):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        left = stage_bucketed(spark.range(1000).withColumn("k", F.col("id") % 50), "k")
        right = spark.range(50).select(F.col("id").alias("k"), F.col("id").alias("v"))
        joined = left.join(right, "k")
        assert plan(joined).count("Exchange hashpartitioning") == 1
        assert joined.count() == 1000


def test_scans_read_only_their_columns(spark, corpus_rows, tmp_path):
    corpus_rows.write.parquet(str(tmp_path / "c"))
    articles = corpus.read_corpus(spark, str(tmp_path / "c"))
    assert "ReadSchema: struct<id:bigint,title:string>" in plan(corpus.titles(articles))
    assert "ReadSchema: struct<id:bigint,text:string>" in plan(corpus.body_docs(articles))


def test_posting_files_are_sorted_and_frequent_terms_span_files(spark, hot, tmp_path):
    docs, _ = hot
    with settings(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):  # the test table is tiny
        write_index(docs, str(tmp_path / "i"), "simple", n_buckets=3)
    files = glob.glob(f"{tmp_path}/i/postings/gen=0/bucket=*/*.parquet")
    holding = 0
    for path in files:
        table = pq.ParquetFile(path).read(["term", "doc_id"])
        rows = list(zip(table["term"].to_pylist(), table["doc_id"].to_pylist()))
        assert rows == sorted(rows)
        holding += any(term == "everywhere" for term, _ in rows)
    assert holding > 1


def test_null_and_pretokenized_texts(spark):
    docs = spark.createDataFrame([(1, ["b", "a", "b"]), (2, None), (3, [])], "doc_id long, text array<string>")
    index = build_index(docs, lambda tokens: tokens, norms=True)
    assert sorted(tuple(r) for r in index.postings.select("term", "doc_id", "tf").collect()) == [("a", 1, 1), ("b", 1, 2)]
    nulls = spark.createDataFrame([(1, None), (2, "word")], "doc_id long, text string")
    assert [r.doc_id for r in build_index(nulls, "simple_stem").postings.collect()] == [2]


def test_scratch_tables_survive_their_source(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "src"))
    staged = stage(spark.read.parquet(str(tmp_path / "src")), "copy")
    spark.range(1).write.mode("overwrite").parquet(str(tmp_path / "src"))
    assert staged.count() == 5


@pytest.mark.parametrize("n", [2, 5, 11, 65])
def test_only_the_buckets_of_query_terms_are_read(spark, hot, tmp_path, n):
    docs, _ = hot
    index = write_index(docs, str(tmp_path / "i"), "simple", n_buckets=500)
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("word"), i.cast("string"))), " ")
    joined = bm25(index, spark.range(1).select(F.col("id").alias("query_id"), words.alias("text")))
    filters = [line.split("PartitionFilters: [")[1].split("]")[0] for line in plan(joined).splitlines() if "PartitionFilters" in line]
    assert any("bucket" in f for f in filters)


def test_rankers_do_not_filter_by_the_dictionary(spark, hot):
    docs, queries = hot
    assert "LeftSemi" not in plan(bm25(build_index(docs, "simple", min_df=5), queries))


def test_scratch_is_removed(spark, docs, queries, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_dir", lambda _: str(tmp_path))
    kept = stage(docs, "kept")
    with scratch(spark):
        index = build_index(docs, "simple")
        with scratch(spark):
            stage_bucketed(docs, "doc_id").count()
        found = top_k(bm25(index, queries), 3).collect()
    assert found and [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["kept"]
    assert kept.count() == docs.count()


def test_link_queries_are_those_of_every_fiftieth_page(spark, tmp_path):
    from checks.queries import _link_queries

    pages = spark.range(120).selectExpr("id AS page_id", "concat('<title>Page ', id, '</title>') AS html")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted(map(tuple, _link_queries(spark, str(tmp_path)).collect())) == [(k, f"Page {k}") for k in (0, 50, 100)]


def test_terms_are_counted_in_generated_code(spark, hot):
    docs, _ = hot
    lines = plan(doc_terms(docs, "simple")).splitlines()
    assert any("*(" in line.split("Generate")[0] for line in lines if "Generate" in line)
    assert sum("regexp_extract_all" in line for line in lines) == 1
