"""name -> (spark, sf_dir) -> DataFrame, for every operator and endpoint."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from lodestone.functions.analyzers import analyze
from lodestone.functions.stemmer import stem_tokens
from lodestone.operators import blockmax, fuse, graph, rank, termstats
from lodestone.operators.index import Index, build_index
from lodestone.plans import search as plans
from lodestone.session import scratch_dir
from lodestone.sources import corpus, index_store, pageviews

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def rounded(df: DataFrame, *columns: str, digits: int = 5) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


def body_index(spark: SparkSession, sf_dir: str, analyzer: str = "simple", norms: bool = False) -> Index:
    return build_index(fx.bodies(spark, sf_dir), analyzer, fx.MIN_DF_BODY, norms)


def title_index(spark: SparkSession, sf_dir: str, analyzer: str = "simple") -> Index:
    return build_index(fx.first_lines(spark, sf_dir), analyzer)


# --- text analysis ---------------------------------------------------------------------------------


def _positions(docs: DataFrame, analyzer: str) -> DataFrame:
    tokens = analyze(docs, "text", analyzer)
    return tokens.select("doc_id", F.posexplode("tokens").alias("pos", "term")).withColumn(
        "pos", F.col("pos").cast("long")
    )


@register
def tokenize_simple(spark, sf_dir):
    return _positions(fx.bodies(spark, sf_dir), "simple")


@register
def tokenize_simple_stem(spark, sf_dir):
    return _positions(fx.bodies(spark, sf_dir), "simple_stem")


@register
def tokenize_rich_stem(spark, sf_dir):
    return _positions(fx.bodies(spark, sf_dir), "rich_stem")


@register
def stem_terms(spark, sf_dir):
    terms = termstats.dictionary(termstats.doc_terms(fx.bodies(spark, sf_dir), "simple")).select("term")
    return terms.select("term", stem_tokens(F.array("term"))[0].alias("stem"))


@register
def pattern_classes(spark, sf_dir):
    """The classes that other regular expression engines can check."""
    texts = fx.pattern_texts(spark, sf_dir)
    return termstats.class_counts(texts, "text", ["website", "slash_date", "date", "time", "html"])


@register
def pattern_classes_all(spark, sf_dir):
    return termstats.class_counts(fx.pattern_texts(spark, sf_dir), "text")


# --- counts and index ------------------------------------------------------------------------------


@register
def term_freq(spark, sf_dir):
    return termstats.doc_terms(fx.bodies(spark, sf_dir), "simple").select("doc_id", "term", "tf")


@register
def doc_freq(spark, sf_dir):
    return termstats.dictionary(termstats.doc_terms(fx.bodies(spark, sf_dir), "simple")).select("term", "df")


@register
def term_total(spark, sf_dir):
    return termstats.dictionary(termstats.doc_terms(fx.bodies(spark, sf_dir), "simple")).select("term", "term_total")


@register
def min_df_vocab(spark, sf_dir):
    return termstats.dictionary(termstats.doc_terms(fx.bodies(spark, sf_dir), "simple"), fx.MIN_DF_BODY)


@register
def doc_len(spark, sf_dir):
    return termstats.doc_lengths(termstats.doc_terms(fx.bodies(spark, sf_dir), "simple"))


@register
def combined_doc_len(spark, sf_dir):
    body = termstats.doc_lengths(termstats.doc_terms(fx.bodies(spark, sf_dir), "simple"))
    title = termstats.doc_lengths(termstats.doc_terms(fx.first_lines(spark, sf_dir), "simple"))
    return termstats.combined_lengths(body, title)


@register
def index_stats(spark, sf_dir):
    stats = termstats.collection_stats(
        termstats.doc_lengths(termstats.doc_terms(fx.bodies(spark, sf_dir), "simple"))
    )
    return rounded(stats, "avg_len")


@register
def doc_norm(spark, sf_dir):
    return rounded(body_index(spark, sf_dir, norms=True).doc_stats, "norm")


@register
def posting_lists(spark, sf_dir):
    blocks = termstats.posting_blocks(body_index(spark, sf_dir).postings)
    entry = F.transform("postings", lambda p: F.concat_ws(":", p["doc_id"], p["tf"]))
    return blocks.select("term", "block", "n", F.concat_ws(",", entry).alias("postings"))


def _stored(spark, docs, name, *args, **options) -> tuple[Index, str]:
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    return index_store.write_index(docs, path, *args, **options), path


@register
def posting_lookup(spark, sf_dir):
    index, _ = _stored(spark, fx.bodies(spark, sf_dir), "body", "simple")
    return index_store.lookup_postings(index, fx.SAMPLE_TERMS)


@register
def index_append(spark, sf_dir):
    """Half of the documents indexed, the other half appended: equal to indexing all at once."""
    docs = fx.bodies(spark, sf_dir)
    _, path = _stored(spark, docs.where("doc_id % 2 = 0"), "halves", "simple", fx.MIN_DF_BODY, norms=True)
    index = index_store.append_docs(docs.where("doc_id % 2 = 1"), path)
    postings = index.postings.join(index.terms, "term").join(index.doc_stats.select("doc_id", "norm"), "doc_id")
    return rounded(postings.select("term", "doc_id", "tf", "doc_len", "df", "term_total", "norm"), "norm")


@register
def index_rebuild(spark, sf_dir):
    """Some documents indexed and more appended, then replaced by others: only the last build counts."""
    docs = fx.bodies(spark, sf_dir)
    _, path = _stored(spark, docs.where("doc_id % 3 = 0"), "rebuilt", "simple")
    index_store.append_docs(docs.where("doc_id % 3 = 1"), path)
    index = index_store.write_index(docs, path, "simple", fx.MIN_DF_BODY, norms=True)
    index_store.remove_replaced(spark, path)
    postings = index.postings.join(index.terms, "term").join(index.doc_stats.select("doc_id", "norm"), "doc_id")
    return rounded(postings.select("term", "doc_id", "tf", "doc_len", "df", "term_total", "norm"), "norm")


@register
def anchor_append(spark, sf_dir):
    """Links of half of the pages indexed, those of the others appended; pages that both link to get both texts."""
    fragments = corpus.anchor_fragments(fx.page_corpus(spark, sf_dir))
    half = F.pmod(F.xxhash64("doc_id", "text"), F.lit(2))
    _, path = _stored(spark, fragments.where(half == 0), "anchors", "simple", fragments=True)
    index = index_store.append_docs(fragments.where(half == 1), path)
    return index.postings.select("term", "doc_id", "tf", "doc_len")


@register
def index_compact(spark, sf_dir):
    """Links of three parts of the pages, in three generations, written as one."""
    fragments = corpus.anchor_fragments(fx.page_corpus(spark, sf_dir))
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(3))
    _, path = _stored(spark, fragments.where(part == 0), "compacted", "simple", fragments=True)
    for k in (1, 2):
        index_store.append_docs(fragments.where(part == k), path)
    index = index_store.compact_index(spark, path)
    index_store.remove_replaced(spark, path)
    return index.postings.select("term", "doc_id", "tf", "doc_len")


@register
def anchor_fragments(spark, sf_dir):
    return corpus.anchor_fragments(fx.page_corpus(spark, sf_dir))


@register
def anchor_docs(spark, sf_dir):
    return corpus.anchor_docs(fx.page_corpus(spark, sf_dir))


@register
def field_docs(spark, sf_dir):
    return corpus.field_docs(fx.page_corpus(spark, sf_dir))


@register
def titles(spark, sf_dir):
    return corpus.titles(fx.page_corpus(spark, sf_dir))


@register
def anchor_terms(spark, sf_dir):
    fragments = corpus.anchor_fragments(fx.page_corpus(spark, sf_dir))
    return termstats.fragment_terms(fragments, "simple")


# --- ranking ---------------------------------------------------------------------------------------


@register
def query_terms(spark, sf_dir):
    return rank.query_terms(fx.benchmark_queries(spark, sf_dir), "simple").drop("term_no")


@register
def bm25_idf(spark, sf_dir):
    return rounded(rank.term_idf(body_index(spark, sf_dir)), "idf")


def _scores(scored: DataFrame) -> DataFrame:
    return rounded(scored.select("query_id", "doc_id", "score"), "score")


@register
def bm25_body(spark, sf_dir):
    return _scores(rank.bm25(body_index(spark, sf_dir), fx.benchmark_queries(spark, sf_dir)))


@register
def bm25_title(spark, sf_dir):
    return _scores(rank.bm25(title_index(spark, sf_dir), fx.benchmark_queries(spark, sf_dir)))


@register
def bm25_salted(spark, sf_dir):
    """The same result as bm25_body, with frequent terms split by document."""
    index, _ = _stored(spark, fx.bodies(spark, sf_dir), "salted", "simple", fx.MIN_DF_BODY)
    return _scores(rank.bm25(index, fx.benchmark_queries(spark, sf_dir), salt_rows=100))


@register
def bm25_zero_length(spark, sf_dir):
    index = body_index(spark, sf_dir)
    return _scores(rank.bm25(index, fx.benchmark_queries(spark, sf_dir), length_norm="zero"))


@register
def bm25_combined_length(spark, sf_dir):
    body, title = body_index(spark, sf_dir), title_index(spark, sf_dir)
    lengths = [body.doc_stats, title.doc_stats]
    return _scores(rank.bm25(title, fx.benchmark_queries(spark, sf_dir), length_stats=lengths))


@register
def bm25_stemmed(spark, sf_dir):
    return _scores(rank.bm25(body_index(spark, sf_dir, "simple_stem"), fx.benchmark_queries(spark, sf_dir)))


@register
def tfidf_query_vector(spark, sf_dir):
    vector = rank.query_vector(body_index(spark, sf_dir), fx.benchmark_queries(spark, sf_dir))
    return rounded(vector.drop("term_no"), "q_weight")


@register
def tfidf_cosine(spark, sf_dir):
    index = body_index(spark, sf_dir, norms=True)
    return _scores(rank.tfidf_cosine(index, fx.benchmark_queries(spark, sf_dir)))


@register
def search_body(spark, sf_dir):
    return plans.search_body(
        body_index(spark, sf_dir, norms=True),
        fx.benchmark_queries(spark, sf_dir),
        fx.first_line_titles(spark, sf_dir),
        k=40,
    )


@register
def search_title(spark, sf_dir):
    page_titles = fx.page_titles(spark, sf_dir)
    index = build_index(page_titles.withColumnRenamed("title", "text"), "simple")
    return plans.search_title(index, fx.benchmark_queries(spark, sf_dir), page_titles)


@register
def search_title_normalized(spark, sf_dir):
    page_titles = fx.page_titles(spark, sf_dir)
    index = build_index(page_titles.withColumnRenamed("title", "text"), "simple", norms=True)
    return plans.search_title(index, fx.benchmark_queries(spark, sf_dir), page_titles, normalize=True)


@register
def search_anchor(spark, sf_dir):
    """By the pages that links point to. A target is an address here, and has no title."""
    pages = fx.page_corpus(spark, sf_dir)
    index = build_index(corpus.anchor_fragments(pages), "simple", fragments=True)
    return plans.search_anchor(index, _link_queries(spark, sf_dir), corpus.titles(pages))


@register
def search_anchor_source(spark, sf_dir):
    """By the pages that contain the links."""
    pages = fx.page_corpus(spark, sf_dir)
    index = build_index(corpus.anchor_fragments(pages, by="source"), "simple", fragments=True)
    return plans.search_anchor(index, _link_queries(spark, sf_dir), corpus.titles(pages))


def _link_queries(spark, sf_dir) -> DataFrame:
    """Page titles, as their words are the kind found in link texts."""
    return fx.page_titles(spark, sf_dir).select(F.col("doc_id").alias("query_id"), F.col("title").alias("text"))


@register
def bm25_blockmax(spark, sf_dir):
    """The best ten, scoring only blocks of documents that can have them."""
    index, _ = _stored(spark, fx.bodies(spark, sf_dir), "blocks", "simple", fx.MIN_DF_BODY)
    return blockmax.bm25_top_k(index, fx.benchmark_queries(spark, sf_dir), 10, digits=5)


# --- endpoints on stored indexes -------------------------------------------------------------------


def _reopened(spark, docs: DataFrame, name: str, *args, **options) -> Index:
    """An index of two thirds of the rows, appended by the rest and opened again."""
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(3))
    _, path = _stored(spark, docs.where(part > 0), name, *args, **options)
    index_store.append_docs(docs.where(part == 0), path)
    return index_store.read_index(spark, path)


@register
def search_stored(spark, sf_dir):
    body = _reopened(spark, fx.bodies(spark, sf_dir), "body", "simple", fx.MIN_DF_BODY)
    title = _reopened(spark, fx.first_lines(spark, sf_dir), "title", "simple")
    return _search_in(spark, sf_dir, {"body": body, "title": title})


@register
def search_body_stored(spark, sf_dir):
    index = _reopened(spark, fx.bodies(spark, sf_dir), "body", "simple", fx.MIN_DF_BODY, norms=True)
    queries = fx.benchmark_queries(spark, sf_dir)
    return plans.search_body(index, queries, fx.first_line_titles(spark, sf_dir), k=40)


@register
def search_title_stored(spark, sf_dir):
    page_titles = fx.page_titles(spark, sf_dir)
    index = _reopened(spark, page_titles.withColumnRenamed("title", "text"), "title", "simple")
    return plans.search_title(index, fx.benchmark_queries(spark, sf_dir), page_titles)


@register
def search_anchor_stored(spark, sf_dir):
    pages = fx.page_corpus(spark, sf_dir)
    index = _reopened(spark, corpus.anchor_fragments(pages), "anchor", "simple", fragments=True)
    return plans.search_anchor(index, _link_queries(spark, sf_dir), corpus.titles(pages))


@register
def search_empty_queries(spark, sf_dir):
    """Every second query is empty, and has no rows."""
    page_titles = fx.page_titles(spark, sf_dir)
    index = build_index(page_titles.withColumnRenamed("title", "text"), "simple")
    queries = fx.benchmark_queries(spark, sf_dir)
    text = F.when(F.col("query_id") % 4 == 1, "").when(F.col("query_id") % 4 == 3, F.lit(None)).otherwise(F.col("text"))
    return plans.search_title(index, queries.withColumn("text", text), page_titles)


# --- fusion ----------------------------------------------------------------------------------------


def _two_lists(spark, sf_dir) -> list[DataFrame]:
    queries = fx.benchmark_queries(spark, sf_dir)
    indexes = [title_index(spark, sf_dir), body_index(spark, sf_dir)]
    return [rank.top_k(rank.bm25(index, queries), 100, digits=5) for index in indexes]


@register
def merge_results(spark, sf_dir):
    # weights of one digit on scores of five: seven digits keep clear of ties
    return rounded(fuse.merge_results(_two_lists(spark, sf_dir), [0.1, 0.9], 100), "score", digits=7)


@register
def min_max(spark, sf_dir):
    scores = rank.bm25(body_index(spark, sf_dir), fx.benchmark_queries(spark, sf_dir))
    scores = rounded(scores.select("query_id", "doc_id", "score"), "score")
    return rounded(fuse.min_max(scores, out="scaled"), "scaled")


@register
def blend(spark, sf_dir):
    title, body = (fuse.min_max(r, cut=True) for r in _two_lists(spark, sf_dir))
    views = body.select("query_id", "doc_id").join(
        fx.article_views(spark, sf_dir).select(F.col("id").alias("doc_id"), F.col("views").alias("score")), "doc_id"
    )
    return rounded(fuse.blend([body, title, fuse.min_max(views)], [0.6, 0.2, 0.2]), "score")


@register
def search(spark, sf_dir):
    return _search(spark, sf_dir, "simple", "simple")


@register
def search_stemmed(spark, sf_dir):
    return _search(spark, sf_dir, "simple_stem", "simple_stem")


@register
def search_rich_titles(spark, sf_dir):
    return _search(spark, sf_dir, "simple_stem", "rich_stem")


def _search(spark, sf_dir, body: str, title: str) -> DataFrame:
    indexes = {"body": body_index(spark, sf_dir, body), "title": title_index(spark, sf_dir, title)}
    return _search_in(spark, sf_dir, indexes)


def _search_in(spark, sf_dir, indexes: dict[str, Index]) -> DataFrame:
    found = plans.search(
        indexes,
        fx.benchmark_queries(spark, sf_dir),
        rounded(fx.part_pagerank(spark, sf_dir), "pagerank"),
        fx.article_views(spark, sf_dir),
        fx.first_line_titles(spark, sf_dir),
        per_field_k=10,
        k=10,
    )
    return rounded(found, "score")


# --- graph, page views, lookups --------------------------------------------------------------------


@register
def link_edges(spark, sf_dir):
    return graph.link_edges(fx.page_corpus(spark, sf_dir))


@register
def link_vertices(spark, sf_dir):
    return graph.link_graph(fx.page_corpus(spark, sf_dir), staged=False)[1]


@register
def pagerank(spark, sf_dir):
    return rounded(fx.part_pagerank(spark, sf_dir), "pagerank")


@register
def page_views(spark, sf_dir):
    return fx.article_views(spark, sf_dir)


@register
def lookup_pagerank(spark, sf_dir):
    key = F.col("p_partkey")
    requests = fx.table(spark, sf_dir, "part").select(
        key.alias("request_id"), F.array(key, -key, F.pmod(key, F.lit(100)), key).alias("ids")
    )
    return rounded(plans.get_pagerank(requests, fx.part_pagerank(spark, sf_dir)), "pagerank")


@register
def lookup_pageview(spark, sf_dir):
    key = F.col("doc_id")
    requests = fx.table(spark, sf_dir, "documents").select(
        key.alias("request_id"), F.array(key, F.pmod(key, F.lit(200)), key + 1, key).alias("ids")
    )
    return plans.get_pageview(requests, fx.article_views(spark, sf_dir))


@register
def lookup_empty_lists(spark, sf_dir):
    """Every second list of ids is empty or null, and has no rows."""
    key = F.col("doc_id")
    ids = F.when(key % 4 == 1, F.array().cast("array<bigint>")).when(key % 4 != 3, F.array(key, key + 1))
    requests = fx.table(spark, sf_dir, "documents").select(key.alias("request_id"), ids.alias("ids"))
    return plans.get_pageview(requests, fx.article_views(spark, sf_dir))


# --- sources ---------------------------------------------------------------------------------------


def _corpus_files(spark, sf_dir) -> DataFrame:
    """Pages as corpus files, some of them without an id or without any content, read from a folder that has other
    files, too."""
    path = f"{scratch_dir(spark)}/corpus-{uuid.uuid4().hex}"
    key = F.col("id").cast("long")
    pages = fx.page_corpus(spark, sf_dir).select(
        F.when(key % 10 != 3, key).alias("id"),
        F.when(key % 10 != 4, F.col("title")).alias("title"),
        F.when(key % 10 != 4, F.col("text")).alias("text"),
        F.transform("anchor_text", lambda a: F.struct(F.length(a["id"]).cast("long").alias("id"), a["text"].alias("text"))).alias("anchor_text"),
    )
    pages.write.parquet(path)
    spark.range(3).selectExpr("cast(id AS string) AS value").write.mode("append").text(path)
    return corpus.read_corpus(spark, path)


@register
def corpus_scan(spark, sf_dir):
    good, _ = corpus.split_rejects(_corpus_files(spark, sf_dir))
    return good.select("id", "title", F.length("text").cast("long").alias("n_chars"), F.size("anchor_text").cast("long").alias("n_links"))


@register
def corpus_rejects(spark, sf_dir):
    _, rejects = corpus.split_rejects(_corpus_files(spark, sf_dir))
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


def _dump(spark, sf_dir) -> DataFrame:
    """View lines in a dump that is compressed as the public ones are."""
    path = f"{scratch_dir(spark)}/dump-{uuid.uuid4().hex}"
    fx.view_lines(spark, sf_dir).coalesce(2).write.option("compression", "bzip2").text(path)
    return pageviews.read_page_view_lines(spark, path)


@register
def page_views_bz2(spark, sf_dir):
    return pageviews.page_views(_dump(spark, sf_dir))


@register
def page_view_rejects(spark, sf_dir):
    return pageviews.rejected_lines(_dump(spark, sf_dir)).groupBy("reason").agg(F.count("*").alias("n"))


@register
def side_tables(spark, sf_dir):
    """Titles and PageRank written, replaced and read back."""
    root = f"{scratch_dir(spark)}/side-{uuid.uuid4().hex}"
    found = fx.first_line_titles(spark, sf_dir), rounded(fx.part_pagerank(spark, sf_dir), "pagerank")
    for name, table in zip(("titles", "pagerank"), found):
        index_store.write_table(table.limit(1), f"{root}/{name}")
        index_store.write_table(table, f"{root}/{name}")
        index_store.remove_old_versions(spark, f"{root}/{name}")
    titles, ranks = (index_store.read_table(spark, f"{root}/{name}") for name in ("titles", "pagerank"))
    return titles.join(ranks.withColumnRenamed("id", "doc_id"), "doc_id", "full")
