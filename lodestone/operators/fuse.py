"""Combining result lists ``(query_id, doc_id, score)``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.weights import min_max_scale
from lodestone.operators.rank import top_k


def weighted_sum(results: Sequence[DataFrame], weights: Sequence[float]) -> DataFrame:
    """Weighted scores added up per query and document; a document missing from a list gets 0 from it."""
    if len(results) != len(weights):
        raise ValueError("one weight per result list")
    parts = [
        r.select("query_id", "doc_id", (F.col("score") * F.lit(float(w))).alias("score"))
        for r, w in zip(results, weights)
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("query_id", "doc_id").agg(F.sum("score").alias("score"))


def merge_results(results: Sequence[DataFrame], weights: Sequence[float], k: int = 100) -> DataFrame:
    """Best k of the weighted sum: ``(query_id, rank, doc_id, score)``."""
    return top_k(weighted_sum(results, weights), k)


def min_max(results: DataFrame, score: str = "score", out: str | None = None, cut: bool = False) -> DataFrame:
    """Scale the scores of each query into [0, 1].

    ``cut`` says that the lists are already cut to a top k, so a window over the query is small. Otherwise
    minimum and maximum are aggregated with partial aggregation and joined back, and a query with very many
    rows stays spread out.
    """
    out = out or score
    if cut:
        of_query = Window.partitionBy("query_id")
        low, high = F.min(score).over(of_query), F.max(score).over(of_query)
        return results.withColumn(out, min_max_scale(F.col(score), low, high))
    bounds = results.groupBy("query_id").agg(F.min(score).alias("_low"), F.max(score).alias("_high"))
    return (
        results.join(bounds, "query_id")
        .withColumn(out, min_max_scale(F.col(score), F.col("_low"), F.col("_high")))
        .drop("_low", "_high")
    )


def blend(results: Sequence[DataFrame], weights: Sequence[float], k: int | None = None) -> DataFrame:
    """Weighted sum of any number of lists. With ``k`` ranked and cut; without, all rows in a global sort by
    query, score and document."""
    summed = weighted_sum(results, weights)
    return top_k(summed, k) if k else summed.orderBy("query_id", F.desc("score"), "doc_id")
