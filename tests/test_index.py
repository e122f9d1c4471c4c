import pytest
from pyspark.sql import functions as F

from lodestone.operators import termstats
from lodestone.operators.index import build_index
from lodestone.operators.rank import bm25
from lodestone.sources.index_store import (
    append_docs,
    lookup_postings,
    read_index,
    read_table,
    remove_replaced,
    write_index,
    write_table,
)
from tests.brute import Model


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def pairs(df):
    return [(r[0], r[1]) for r in df.collect()]


def test_term_counts(docs):
    assert rows(termstats.doc_terms(docs, "simple"), "doc_id", "term", "tf", "doc_len") == [
        (1, "blue", 2, 5), (1, "sea", 1, 5), (1, "sky", 2, 5),
        (2, "bird", 1, 3), (2, "blue", 1, 3), (2, "look", 1, 3),
        (4, "bird", 2, 5), (4, "sea", 3, 5),
    ]


def test_dictionary_and_lengths(docs):
    counted = termstats.doc_terms(docs, "simple")
    assert rows(termstats.dictionary(counted), "term", "df", "term_total") == [
        ("bird", 2, 3), ("blue", 2, 3), ("look", 1, 1), ("sea", 2, 4), ("sky", 1, 2)]
    assert rows(termstats.dictionary(counted, 1), "term") == [("bird",), ("blue",), ("sea",)]
    lengths = termstats.doc_lengths(counted)
    assert rows(lengths, "doc_id", "doc_len") == [(1, 5), (2, 3), (4, 5)]
    stats = termstats.collection_stats(lengths).first()
    assert stats.n_docs == 3 and stats.avg_len == pytest.approx(13 / 3)
    assert rows(termstats.combined_lengths(lengths, lengths), "doc_id", "doc_len") == [(1, 10), (2, 6), (4, 10)]


def test_fragments_add_up(spark, docs):
    """Every word its own row, many rows per document: same counts as whole documents, for a text of plain words."""
    words = docs.select("doc_id", F.explode(F.split("text", " ")).alias("text"))
    want = rows(termstats.doc_terms(docs, "simple"), "doc_id", "term", "tf", "doc_len")
    assert rows(termstats.fragment_terms(words, "simple"), "doc_id", "term", "tf", "doc_len") == want


@pytest.mark.parametrize("stage", [True, False])
def test_norms(docs, stage):
    for min_df in (0, 1):
        index = build_index(docs, "simple", min_df, norms=True, stage=stage)
        model = Model(pairs(docs), min_df)
        got = {r.doc_id: r.norm for r in index.doc_stats.collect()}
        assert got == pytest.approx({d: model.norm(d) for d in model.tf})


def test_min_df_keeps_lengths(docs):
    index = build_index(docs, "simple", min_df=1)
    assert rows(index.postings, "term", "doc_id", "tf", "doc_len") == [
        ("bird", 2, 1, 3), ("bird", 4, 2, 5), ("blue", 1, 2, 5), ("blue", 2, 1, 3), ("sea", 1, 1, 5), ("sea", 4, 3, 5),
    ]


def test_posting_blocks_are_bounded_and_whole(spark):
    postings = spark.range(1000).select(F.lit("hot").alias("term"), F.col("id").alias("doc_id"), F.lit(1).alias("tf"))
    blocks = termstats.posting_blocks(postings, width=64).orderBy("block").collect()
    assert max(b.n for b in blocks) == 64
    assert [p.doc_id for b in blocks for p in b.postings] == list(range(1000))


def test_store_round_trip(spark, docs, queries, tmp_path):
    path = str(tmp_path / "index")
    stored = write_index(docs, path, "simple", min_df=1, norms=True)
    built = build_index(docs, "simple", min_df=1, norms=True)
    for index in (stored, read_index(spark, path)):
        for part, cols in (
            ("postings", ["term", "doc_id", "tf", "doc_len"]),
            ("terms", ["term", "df", "term_total"]),
            ("doc_stats", ["doc_id", "doc_len", "norm"]),
            ("meta", ["n_docs", "avg_len"]),
        ):
            assert rows(getattr(index, part), *cols) == rows(getattr(built, part), *cols)
    assert rows(lookup_postings(stored, ["sea", "nosuch"]), "doc_id", "tf") == [(1, 1), (4, 3)]
    plan = lookup_postings(stored, ["sea"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(gen" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "PushedFilters: [" in plan and "EqualTo(term,sea)" in plan.split("PushedFilters")[1]


def test_append_equals_build(spark, docs, queries, tmp_path):
    path = str(tmp_path / "index")
    write_index(docs.where("doc_id in (1, 3)"), path, "simple", min_df=1, norms=True)
    append_docs(docs.where("doc_id = 2"), path)
    index = append_docs(docs.where("doc_id in (4, 5)"), path)
    built = build_index(docs, "simple", min_df=1, norms=True)
    for part, cols in (
        ("postings", ["term", "doc_id", "tf", "doc_len"]),
        ("terms", ["term", "df", "term_total"]),
        ("doc_stats", ["doc_id", "doc_len", "norm"]),
    ):
        assert rows(getattr(index, part), *cols) == rows(getattr(built, part), *cols)
    assert rows(bm25(index, queries), "query_id", "doc_id", "score") == rows(
        bm25(built, queries), "query_id", "doc_id", "score"
    )
    with pytest.raises(ValueError, match="already"):
        append_docs(docs.where("doc_id = 2"), path)


def test_unfinished_append_is_not_seen(spark, docs, tmp_path):
    path = str(tmp_path / "index")
    write_index(docs.where("doc_id = 1"), path, "simple")
    before = rows(read_index(spark, path).postings, "term", "doc_id")
    stray = termstats.doc_terms(docs.where("doc_id = 2"), "simple").withColumn("bucket", F.lit(1))
    stray.write.partitionBy("bucket").parquet(f"{path}/postings/gen=1")
    assert rows(read_index(spark, path).postings, "term", "doc_id") == before
    append_docs(docs.where("doc_id = 4"), path)
    assert {r.doc_id for r in read_index(spark, path).postings.collect()} == {1, 4}


def test_side_tables(spark, docs, tmp_path):
    write_table(docs, str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t")).count() == docs.count()


def test_rebuild_replaces_an_appended_index(spark, docs, tmp_path):
    path = str(tmp_path / "index")
    write_index(docs.where("doc_id = 1"), path, "simple")
    append_docs(docs.where("doc_id = 2"), path)
    # a rebuild that ends before its meta row leaves the old index as it is
    stray = termstats.doc_terms(docs.where("doc_id = 5"), "simple")
    stray.write.parquet(f"{path}/counted/gen=2")
    stray.withColumn("bucket", F.lit(1)).write.partitionBy("bucket").parquet(f"{path}/postings/gen=2")
    assert {r.doc_id for r in read_index(spark, path).postings.collect()} == {1, 2}
    other = docs.where("doc_id = 4").withColumn("doc_id", F.col("doc_id").cast("string"))
    for index in (write_index(other, path, "simple"), read_index(spark, path)):
        assert rows(index.postings, "term", "doc_id", "tf") == [("bird", "4", 2), ("sea", "4", 3)]
        assert rows(index.terms, "term") == [("bird",), ("sea",)]
        assert rows(index.doc_stats, "doc_id") == [("4",)]
    remove_replaced(spark, path)
    assert sorted(p.name for p in (tmp_path / "index" / "meta").glob("gen=*")) == ["gen=2"]
    assert rows(read_index(spark, path).postings, "doc_id") == [("4",), ("4",)]


def test_fragments_are_appended(spark, docs, tmp_path):
    words = docs.select("doc_id", F.posexplode(F.split("text", " ")).alias("at", "text"))
    path = str(tmp_path / "index")
    write_index(words.where("at % 2 = 0").drop("at"), path, "simple", min_df=1, norms=True, fragments=True)
    index = append_docs(words.where("at % 2 = 1").drop("at"), path)
    built = build_index(docs, "simple", min_df=1, norms=True)
    for part, cols in (
        ("postings", ["term", "doc_id", "tf", "doc_len"]),
        ("terms", ["term", "df", "term_total"]),
        ("doc_stats", ["doc_id", "doc_len", "norm"]),
    ):
        assert rows(getattr(index, part), *cols) == rows(getattr(built, part), *cols)


def test_repeated_ids_are_not_appended(docs, tmp_path):
    path = str(tmp_path / "index")
    write_index(docs.where("doc_id = 1"), path, "simple")
    with pytest.raises(ValueError, match="same id"):
        append_docs(docs.where("doc_id = 2").union(docs.where("doc_id = 2")), path)
