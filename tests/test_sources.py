import bz2

import pytest

from lodestone.operators.index import build_index
from lodestone.plans.search import get_pagerank, get_pageview, search_anchor
from lodestone.sources import corpus
from lodestone.sources.pageviews import page_views, read_page_view_lines

LINES = """\
en.wikipedia Blue 12 desktop 5 A1
en.wikipedia Blue 12 mobile-web 7 B2
de.wikipedia Blau 12 desktop 100 A1
en.wikipedia Null null desktop 9 A1
en.wikipedia Short 13
en.wikipedia Word 14 desktop many A1
en.wikipedia Red 15 desktop 1 A1
"""


def test_page_views_from_bz2(spark, tmp_path):
    (tmp_path / "views.bz2").write_bytes(bz2.compress(LINES.encode()))
    lines = read_page_view_lines(spark, str(tmp_path / "views.bz2"))
    assert sorted(tuple(r) for r in page_views(lines).collect()) == [(12, 12), (15, 1)]
    assert [tuple(r) for r in page_views(lines, "de.wikipedia").collect()] == [(12, 100)]


def test_lookups_keep_order_misses_and_repeats(spark):
    requests = spark.createDataFrame([(1, [1, 5, 8, 1]), (2, [])], "request_id long, ids array<long>")
    ranks = spark.createDataFrame([(1, 0.5), (8, 2.5)], "id long, pagerank double")
    views = spark.createDataFrame([(5, 7)], "id long, views long")
    got = get_pagerank(requests, ranks).orderBy("request_id", "pos").collect()
    assert [(r.pos, r.id, r.pagerank) for r in got] == [(0, 1, 0.5), (1, 5, 0.0), (2, 8, 2.5), (3, 1, 0.5)]
    got = get_pageview(requests, views).orderBy("request_id", "pos").collect()
    assert [r.views for r in got] == [0, 7, 0, 0]


def test_read_corpus(spark, corpus_rows, tmp_path):
    path = str(tmp_path / "corpus")
    corpus_rows.write.parquet(path)
    assert corpus.read_corpus(spark, path).count() == 4
    corpus_rows.select("id").write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="lacks"):
        corpus.read_corpus(spark, str(tmp_path / "other"), schema=None)


def test_field_documents(corpus_rows):
    by_target = sorted(tuple(r) for r in corpus.anchor_fragments(corpus_rows).collect())
    assert by_target == [(2, "self"), (2, "two page"), (3, "three"), (3, "three"), (9, "two page")]
    by_source = sorted(tuple(r) for r in corpus.anchor_fragments(corpus_rows, "source").collect())
    assert by_source == [(1, "three"), (1, "two page"), (2, "self"), (2, "three"), (4, "two page")]
    joined = {r.doc_id: r.text for r in corpus.anchor_docs(corpus_rows).collect()}
    assert joined == {1: "three two page", 2: "self three", 4: "two page"}
    assert corpus.field_docs(corpus_rows).groupBy("field").count().count() == 3
    with pytest.raises(ValueError):
        corpus.anchor_fragments(corpus_rows, "both")


def test_search_anchor_counts_links_to_the_page(spark, corpus_rows):
    queries = spark.createDataFrame([(1, "page three self")], "query_id long, text string")
    index = build_index(corpus.anchor_fragments(corpus_rows), "simple", fragments=True)
    found = search_anchor(index, queries, corpus.titles(corpus_rows)).orderBy("rank").collect()
    assert [(r.doc_id, r.score, r.title) for r in found] == [(2, 2, "Two"), (9, 1, None), (3, 1, "Three")]


def test_scans_with_enough_splits_are_not_shuffled(spark):
    many = spark.range(0, 100, 1, 64)
    assert corpus.spread(many, "id") is many
    assert corpus.spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == 8
