"""The search endpoints over tables of queries ``(query_id, text)``; results are ``(query_id, rank, doc_id,
score, title)``. Queries without a match, empty ones among them, have no rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.operators.fuse import merge_results, min_max
from lodestone.operators.index import Index
from lodestone.operators.lookup import fetch, lookup
from lodestone.operators.rank import bm25, match_count, rank_all, tfidf_cosine, top_k
from lodestone.session import stage

SCORE_DIGITS = 5  # fixed value: scores are compared after rounding to this many digits
FIELD_WEIGHTS = {"title": 0.1, "body": 0.9}  # fixed values
BLEND_WEIGHTS = (0.6, 0.2, 0.2)  # fixed values: text score, PageRank, page views


def with_titles(results: DataFrame, titles: DataFrame) -> DataFrame:
    """Add the title, null where there is none."""
    return results.join(titles.select("doc_id", "title"), "doc_id", "left")


def _best_with_titles(best: DataFrame, titles: DataFrame) -> DataFrame:
    """The same for a top k: written first, so that the few titles are looked up instead of shuffling all."""
    return fetch(stage(best, "best"), titles, "doc_id", "title")


def search(
    indexes: Mapping[str, Index],
    queries: DataFrame,
    pagerank: DataFrame,
    page_views: DataFrame,
    titles: DataFrame,
    field_weights: Mapping[str, float] = FIELD_WEIGHTS,
    blend_weights: Sequence[float] = BLEND_WEIGHTS,
    k: int = 100,
    per_field_k: int | None = None,
    **bm25_options,
) -> DataFrame:
    """BM25 per field, the best of each field merged by weight, then blended with PageRank and page views,
    each scaled to [0, 1] within the query."""
    fields = list(field_weights)
    best = [
        top_k(bm25(indexes[f], queries, **bm25_options), per_field_k or k, SCORE_DIGITS).drop("rank") for f in fields
    ]
    # at most k rows per query, read several times below
    merged = stage(merge_results(best, [field_weights[f] for f in fields], k), "merged")
    ids = merged.select("doc_id").distinct()
    merged = fetch(merged, titles, "doc_id", "title", asked=ids)
    merged = fetch(merged, pagerank.withColumnRenamed("id", "doc_id"), "doc_id", "pagerank", 0.0, asked=ids)
    merged = fetch(merged, page_views.withColumnRenamed("id", "doc_id"), "doc_id", "views", 0, asked=ids)
    for score in ("score", "pagerank", "views"):
        merged = min_max(merged, score, cut=True)
    text, rank, views = (F.lit(float(w)) for w in blend_weights)
    blended = merged.select(
        "query_id",
        "doc_id",
        "title",
        F.col("rank").alias("prev_rank"),
        (F.col("score") * text + F.col("pagerank") * rank + F.col("views") * views).alias("score"),
    )
    return top_k(blended, k)


def search_body(index: Index, queries: DataFrame, titles: DataFrame, k: int = 100) -> DataFrame:
    """TF-IDF cosine similarity; the index is built with norms."""
    return _best_with_titles(top_k(tfidf_cosine(index, queries), k, SCORE_DIGITS), titles)


def search_title(index: Index, queries: DataFrame, titles: DataFrame, normalize: bool = False) -> DataFrame:
    """All documents whose title has a query word, most distinct query words first."""
    matches = match_count(index, queries, normalize)
    return with_titles(rank_all(matches, SCORE_DIGITS if normalize else None), titles)


def search_anchor(index: Index, queries: DataFrame, titles: DataFrame, normalize: bool = False) -> DataFrame:
    """The same for the texts of links; which links belong to a document is a matter of the index."""
    return search_title(index, queries, titles, normalize)


def get_pagerank(requests: DataFrame, pagerank: DataFrame) -> DataFrame:
    return lookup(requests, pagerank, "pagerank", 0.0)


def get_pageview(requests: DataFrame, page_views: DataFrame) -> DataFrame:
    return lookup(requests, page_views, "views", 0)
