"""Ranking a whole table of queries against an index.

Every ranker returns ``(query_id, doc_id, score, first_term)`` for all documents that share a term with the
query. ``first_term`` settles ties: it is the smallest matching term, by its number among the query's sorted
terms, as numbers are aggregated by hash and strings only by sorting. :func:`top_k` cuts, :func:`rank_all` numbers
everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.weights import bm25_idf, bm25_term, ratio, tfidf
from lodestone.operators.index import Index, doc_block
from lodestone.operators.termstats import combined_lengths, counted_tokens
from lodestone.session import is_small, stage

QUERY_SMOOTHING = 1e-7  # fixed value: added to df in the weights of query words


def query_terms(queries: DataFrame, analyzer) -> DataFrame:
    """``(query_id, text)`` -> ``(query_id, term, term_no, q_tf, q_len)``; the length counts repeats and unknown
    words."""
    return counted_tokens(queries.select("query_id", "text"), "text", analyzer, numbered=True).select(
        "query_id", "term", "term_no", F.col("tf").alias("q_tf"), F.col("n_tokens").alias("q_len")
    )


def known_query_terms(index: Index, queries: DataFrame) -> DataFrame:
    """Query terms that are in the dictionary, with their ``df``."""
    return query_terms(queries, index.analyzer).join(index.terms.select("term", "df"), "term")


def candidates(
    index: Index, q_terms: DataFrame, salt_rows: int | None = None, keys: list[str] | None = None
) -> DataFrame:
    """Postings of the query terms: q_terms joined with postings on term, and on further ``keys`` such as block.

    The query terms are written first, so that their size is known when the join is planned: if it is below
    ``spark.sql.autoBroadcastJoinThreshold`` they are broadcast, and other postings than theirs are not shuffled, as
    they would be for an unknown size. Of a stored index only the buckets of the query terms are read, however
    many these are; there are at most ``n_buckets`` to name in the filter. Up to NAMED_TERMS terms are named, too, so
    that in these buckets only the pages are read that can have one.

    What meets a broadcast is dealt by document first (bounds by block), as one row for each posting of a query
    term. Pairs, of which every query that has the term makes one, are then grouped by query and document where they are.

    Larger batches meet by shuffle, where adaptive execution splits skewed terms. With ``salt_rows`` the split is
    explicit: a term in more than that many documents is divided by document into ``ceil(df / salt_rows)`` parts,
    each of which gets its own copy of the query rows; more parts than there are shuffle partitions spread no further.
    """
    postings, keys = index.postings if index.counted is None else index.counted, ["term", *(keys or [])]
    q_terms = stage(q_terms, "query-terms")
    in_place = is_small(q_terms)
    if "block" in keys and "block" not in postings.columns:
        postings = postings.withColumn("block", doc_block(F.col("doc_id"), F.col("doc_len")))
    if index.n_buckets:
        q_terms = q_terms.withColumn("bucket", term_bucket(F.col("term"), index.n_buckets))
        keys.append("bucket")
        terms = q_terms.select("bucket", "term").distinct()
        named = [tuple(row) for row in terms.limit(NAMED_TERMS + 1).collect()]
        if len(named) <= NAMED_TERMS:
            asked = sorted({bucket for bucket, _ in named})
            postings = postings.where(named_in("term", sorted(term for _, term in named)))
        elif index.n_buckets > 1:
            asked = sorted(row["bucket"] for row in terms.select("bucket").distinct().collect())
        else:
            asked = [0]
        postings = postings.where(F.col("bucket").isin(asked))
    if salt_rows:
        most = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = F.least(F.ceil(F.col("df") / salt_rows), F.lit(most).cast("long"))
        of_term = q_terms.select("term", parts.alias("parts")).distinct()
        salt = F.pmod(F.xxhash64("doc_id"), F.col("parts"))
        postings = postings.join(of_term, "term").withColumn("salt", salt).drop("parts")
        q_terms = q_terms.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        keys.append("salt")
    elif in_place:
        asked = stage(q_terms.select(*keys).distinct(), "asked-terms")
        postings = postings.join(asked, keys)
    if in_place:
        postings = postings.repartition("doc_id" if "doc_id" in postings.columns else "block")
    return postings.join(q_terms, keys)


#: So many terms are named in the filter of a scan; rows don't depend on it.
NAMED_TERMS = 1000
#: Longer lists of values reach the scan as a range only (``spark.sql.parquet.pushdown.inFilterThreshold``).
_EXACT = 10


def named_in(column: str, values: list[str]) -> Column:
    """Membership in a list of any length, in short lists that scans compare with the statistics of their pages."""
    parts = [F.col(column).isin(values[i : i + _EXACT]) for i in range(0, len(values), _EXACT)]
    while len(parts) > 1:
        parts = [a | b for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) & ~1 :]
    return parts[0] if parts else F.lit(False)


def term_bucket(term: Column, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(n_buckets)).cast("int")


def score_sums(pairs: DataFrame, value: Column, kind: str = "double") -> DataFrame:
    """``(query_id, doc_id, score, first_term)`` from the value of each matching term."""
    return pairs.groupBy("query_id", "doc_id").agg(
        F.sum(value).cast(kind).alias("score"), F.min("term_no").alias("first_term")
    )


def term_idf(index: Index) -> DataFrame:
    """``(term, idf)`` by the BM25 formula."""
    return index.terms.select("term", bm25_idf(index.n_docs, F.col("df")).alias("idf"))


def bm25(
    index: Index,
    queries: DataFrame,
    k1: float = 1.5,
    b: float = 0.75,
    length_norm: str = "field",
    length_stats: list[DataFrame] | None = None,
    salt_rows: int | None = None,
) -> DataFrame:
    """BM25. Repeated query words count once.

    length_norm: ``field`` uses the document's length; ``zero`` treats every length as 0
    length_stats: length tables of several fields to add up; N, average and lengths then come from the sum
    """
    q_terms = known_query_terms(index, queries)
    n_docs, avg_len, doc_len = index.n_docs, index.avg_len, F.col("doc_len")
    lengths = None
    if length_stats:
        lengths = combined_lengths(*length_stats)
        n_docs, avg_len = lengths.agg(F.count("*")).scalar(), lengths.agg(F.avg("doc_len")).scalar()
    if length_norm == "zero":
        doc_len = F.lit(0)
    q_terms = q_terms.select("query_id", "term", "term_no", "df", bm25_idf(n_docs, F.col("df")).alias("idf"))
    pairs = candidates(index, q_terms, salt_rows)
    if lengths is not None:
        pairs = pairs.drop("doc_len").join(lengths, "doc_id")
    return score_sums(pairs, bm25_term(F.col("idf"), F.col("tf"), doc_len, avg_len, k1, b))


def query_vector(index: Index, queries: DataFrame) -> DataFrame:
    """``(query_id, term, term_no, df, q_weight)``: TF-IDF weights of the query words in the dictionary."""
    weight = tfidf(F.col("q_tf"), F.col("q_len"), index.n_docs, F.col("df"), QUERY_SMOOTHING)
    return known_query_terms(index, queries).select("query_id", "term", "term_no", "df", weight.alias("q_weight"))


def tfidf_cosine(index: Index, queries: DataFrame, salt_rows: int | None = None) -> DataFrame:
    """Cosine similarity of TF-IDF vectors; the index must be built with norms. 0 where a norm is 0."""
    of_query = Window.partitionBy("query_id")  # a query's own words
    vector = query_vector(index, queries).withColumn(
        "q_norm", F.sqrt(F.sum(F.col("q_weight") * F.col("q_weight")).over(of_query))
    )
    weight = tfidf(F.col("tf"), F.col("doc_len"), index.n_docs, F.col("df"))
    dots = (
        candidates(index, vector, salt_rows)
        .groupBy("query_id", "doc_id")
        .agg(
            F.sum(weight * F.col("q_weight")).alias("dot"),
            F.first("q_norm").alias("q_norm"),
            F.min("term_no").alias("first_term"),
        )
    )
    score = ratio(F.col("dot"), F.col("q_norm") * F.col("norm")).alias("score")
    return dots.join(index.doc_stats.select("doc_id", "norm"), "doc_id").select(
        "query_id", "doc_id", score, "first_term"
    )


def match_count(
    index: Index, queries: DataFrame, normalize: bool = False, salt_rows: int | None = None
) -> DataFrame:
    """Number of distinct query words in the document. ``normalize`` divides it by the norms of the binary
    query vector and of the document."""
    q_terms = known_query_terms(index, queries).select("query_id", "term", "term_no", "df")
    if not normalize:
        return score_sums(candidates(index, q_terms, salt_rows), F.lit(1), "long")
    q_terms = q_terms.withColumn("q_norm", F.sqrt(F.count("*").over(Window.partitionBy("query_id"))))
    counts = (
        candidates(index, q_terms, salt_rows)
        .groupBy("query_id", "doc_id")
        .agg(F.count("*").alias("n"), F.first("q_norm").alias("q_norm"), F.min("term_no").alias("first_term"))
    )
    score = ratio(F.col("n"), F.col("q_norm") * F.col("norm")).alias("score")
    return counts.join(index.doc_stats.select("doc_id", "norm"), "doc_id").select(
        "query_id", "doc_id", score, "first_term"
    )


def _order(scored: DataFrame) -> list[Column]:
    ties = ["first_term", "prev_rank", "doc_id"]
    return [F.desc("score")] + [F.asc(c) for c in ties if c in scored.columns]


def _kept(scored: DataFrame) -> list[str]:
    return ["title"] if "title" in scored.columns else []


def top_k(scored: DataFrame, k: int, digits: int | None = None) -> DataFrame:
    """``(query_id, rank, doc_id, score)``, and a title if there is one, of the best k per query. Each task first
    cuts its own rows to k per query, so what is shuffled is small even if one query has most of the rows. Spark
    does that up to a threshold; a larger k is cut from the complete ranking. ``digits`` rounds first."""
    if k > int(scored.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        return rank_all(scored, digits).where(F.col("rank") <= k)
    if digits is not None:
        scored = scored.withColumn("score", F.round("score", digits))
    by_query = Window.partitionBy("query_id").orderBy(*_order(scored))
    return (
        scored.withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score", *_kept(scored))
    )


def rank_all(scored: DataFrame, digits: int | None = None, partitions: int | None = None) -> DataFrame:
    """The same for every row, without gathering a query in one task.

    Rows are range-partitioned and sorted in rank order, numbered in place and written. A row's rank is its number less
    the first one of its query in its slice, plus the rows of the query in earlier slices: one row for each query in
    a slice, which is joined without another shuffle of the ranked rows while it is small.
    """
    if digits is not None:
        scored = scored.withColumn("score", F.round("score", digits))
    order = _order(scored)
    n = partitions or int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = scored.repartitionByRange(n, "query_id", *order).sortWithinPartitions("query_id", *order)
    sliced = sliced.withColumns({"slice": F.spark_partition_id(), "number": F.monotonically_increasing_id()})
    sliced = stage(sliced, "ranked")
    earlier = Window.partitionBy("query_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("query_id", "slice").agg(F.count("*").alias("n"), F.min("number").alias("first"))
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)) + 1 - F.col("first")
    offsets = stage(offsets.select("query_id", "slice", before.alias("offset")), "offsets")
    return sliced.join(offsets, ["query_id", "slice"]).select(
        "query_id", (F.col("number") + F.col("offset")).alias("rank"), "doc_id", "score", *_kept(scored)
    )
