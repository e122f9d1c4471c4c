"""The best k by BM25 without scoring every candidate.

Documents are in blocks of similar length. For each term and block the index knows the largest frequency and the smallest
length, from which follows the most that the term can add to a document of the block, for any k1, b and average length.
A first pass adds these up to a bound per query and block. The blocks with the largest bounds are scored; the k-th best
score there is a lower bound of what a result needs, and of the other blocks only those are scored whose bound reaches
it. The first k blocks of a query have k documents at least, so there is such a bound unless there are fewer blocks. The
rows are those of the complete ranking, cut at k.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.weights import bm25_idf, bm25_term
from lodestone.operators.index import Index
from lodestone.operators.rank import candidates, known_query_terms, score_sums, top_k
from lodestone.session import stage

#: Bounds are sums of rounded numbers.
SLACK = 1e-9


def _passes(bound: Column, needed: Column, digits: int | None) -> Column:
    """Whether scores up to ``bound`` can come before or be level with ``needed``."""
    bound = bound + SLACK
    return bound >= needed if digits is None else F.round(bound, digits) >= F.round(needed, digits)


def bm25_top_k(
    index: Index,
    queries: DataFrame,
    k: int,
    digits: int | None = None,
    k1: float = 1.5,
    b: float = 0.75,
    length_norm: str = "field",
) -> DataFrame:
    """``top_k(bm25(index, queries, ...), k, digits)``, row for row."""
    q_terms = known_query_terms(index, queries)
    idf = bm25_idf(index.n_docs, F.col("df")).alias("idf")
    q_terms = stage(q_terms.select("query_id", "term", "term_no", "df", idf), "query-terms")
    zero = length_norm == "zero"

    def weight(tf: str, length: str) -> Column:
        return bm25_term(F.col("idf"), F.col(tf), F.lit(0) if zero else F.col(length), index.avg_len, k1, b)

    blocks = replace(index, postings=index.impacts, counted=None)
    bounds = candidates(blocks, q_terms).withColumn("bound", weight("max_tf", "min_len"))
    bounds = stage(bounds.select("query_id", "term", "term_no", "df", "idf", "block", "bound"), "bounds")
    upper = bounds.groupBy("query_id", "block").agg(F.sum("bound").alias("upper"))
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("upper"), "block")
    upper = stage(upper.withColumn("place", F.row_number().over(by_bound)), "upper")

    def scored(chosen: DataFrame) -> DataFrame:
        asked = bounds.join(chosen.select("query_id", "block"), ["query_id", "block"])
        pairs = candidates(index, asked.drop("bound"), keys=["block"])
        return score_sums(pairs, weight("tf", "doc_len"))

    sure = stage(scored(upper.where(F.col("place") <= k)), "first-blocks")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"))
    kth = sure.withColumn("place", F.row_number().over(by_score)).where(F.col("place") == k)
    rest = upper.where(F.col("place") > k).join(kth.select("query_id", F.col("score").alias("needed")), "query_id", "left")
    rest = rest.where(F.col("needed").isNull() | _passes(F.col("upper"), F.col("needed"), digits))
    return top_k(sure.unionByName(scored(rest)), k, digits)
