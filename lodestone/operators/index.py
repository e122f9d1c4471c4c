"""The inverted index as a set of DataFrames, and its builder."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.analyzers import Analyzer
from lodestone.functions.weights import tfidf
from lodestone.operators import termstats
from lodestone.session import stage as stage_table


@dataclass(frozen=True)
class Index:
    """An inverted index of one field.

    postings: term, doc_id, tf, doc_len (and bucket, when stored) of the kept terms
    terms: term, df, term_total of the kept terms
    doc_stats: doc_id, doc_len (and norm, when built with norms) of documents with a token
    meta: one row n_docs, avg_len
    counted: where postings are still to be filtered, those of all terms: the terms of queries are looked up in the
        dictionary anyway, so rankers need no filter
    block_impacts: term, block, max_tf, min_len (and bucket, when stored), a row for each part of a block's postings
    """

    analyzer: str | Analyzer
    postings: DataFrame
    terms: DataFrame
    doc_stats: DataFrame
    meta: DataFrame
    n_buckets: int | None = None
    counted: DataFrame | None = None
    block_impacts: DataFrame | None = None

    @property
    def impacts(self) -> DataFrame:
        """``(term, block, max_tf, min_len)``, and bucket: one row per term and block of documents."""
        rows, keys = self.block_impacts, ["term", "block", *(["bucket"] if self.n_buckets else [])]
        if rows is None:
            return impacts(self.postings if self.counted is None else self.counted, keys)
        return rows.groupBy(*keys).agg(F.max("max_tf").alias("max_tf"), F.min("min_len").alias("min_len"))

    @property
    def n_docs(self) -> Column:
        return self.meta.select("n_docs").scalar()

    @property
    def avg_len(self) -> Column:
        return self.meta.select("avg_len").scalar()

    def with_analyzer(self, spec: str | Analyzer) -> Index:
        """The same index, with queries analyzed differently."""
        return replace(self, analyzer=spec)


#: Documents whose lengths differ by up to the square root of 2 can share a block; so many blocks hold them.
LENGTH_STEPS, BLOCKS_PER_LENGTH = 2, 1 << 16


def doc_block(doc_id: Column, doc_len: Column) -> Column:
    """The block of a document. It depends on the document alone, so that indexes can grow."""
    step = F.floor(F.log2(F.greatest(doc_len, F.lit(1)) + 0.0) * LENGTH_STEPS).cast("int")
    return (step * BLOCKS_PER_LENGTH + F.pmod(F.xxhash64(doc_id), F.lit(BLOCKS_PER_LENGTH))).cast("int")


def impacts(postings: DataFrame, keys: list[str]) -> DataFrame:
    rows = postings.withColumn("block", doc_block(F.col("doc_id"), F.col("doc_len")))
    return rows.groupBy(*keys).agg(F.max("tf").alias("max_tf"), F.min("doc_len").alias("min_len"))


#: In terms of up to so many documents, most blocks have one posting.
UNGROUPED_DOCS = 4 * BLOCKS_PER_LENGTH


def impact_parts(postings: DataFrame, terms: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows like those of :func:`impacts`, in two tables: of the terms (term, df) in few documents, where each posting is a
    part of its block and stays where it is; and of frequent terms, None if there are none."""
    frequent = stage_table(terms.where(F.col("df") > UNGROUPED_DOCS).select("term"), "frequent-terms")
    block = doc_block(F.col("doc_id"), F.col("doc_len")).alias("block")
    parts = [block if k == "block" else F.col(k) for k in keys]
    parts = [*parts, F.col("tf").alias("max_tf"), F.col("doc_len").alias("min_len")]
    if frequent.isEmpty():
        return postings.select(*parts), None
    of_frequent = postings.join(frequent, "term", "left_semi")
    return postings.join(frequent, "term", "left_anti").select(*parts), impacts(of_frequent, keys)


def keep_terms(doc_terms: DataFrame, terms: DataFrame, min_df: int) -> DataFrame:
    """Postings of the kept terms. The dictionary has one row per term, so a frequent term skews only the
    postings side, which adaptive execution splits when the dictionary is too large to broadcast."""
    return doc_terms.join(terms.select("term"), "term", "left_semi") if min_df > 0 else doc_terms


def doc_norms(postings: DataFrame, lengths: DataFrame) -> DataFrame:
    """``(doc_id, doc_len, norm)``: L2 norm of the TF-IDF weights of a document's ``postings`` (doc_id, tf, doc_len, df),
    those of the kept terms; 0 if it has none. They are best given as they were counted, a document's together, as
    their sum is then shuffled and not they."""
    n_docs = lengths.agg(F.count("*")).scalar()
    weight = tfidf(F.col("tf"), F.col("doc_len"), n_docs, F.col("df"))
    norms = (
        postings.select("doc_id", weight.alias("w"))
        .groupBy("doc_id")
        .agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    )
    return lengths.join(norms, "doc_id", "left").select(
        "doc_id", "doc_len", F.coalesce("norm", F.lit(0.0)).alias("norm")
    )


def build_index(
    docs: DataFrame,
    analyzer: str | Analyzer,
    min_df: int = 0,
    norms: bool = False,
    fragments: bool = False,
    stage: bool = True,
) -> Index:
    """Build an index over ``(doc_id, text)``. With an analyzer such as ``lambda tokens: tokens`` the text column may
    already be token arrays.

    min_df: keep terms found in more than this many documents; lengths still count the dropped ones
    norms: also compute document norms, for TF-IDF cosine ranking
    fragments: a document may span several rows (anchor texts)
    stage: write the counted terms and the dictionary to the scratch folder, so that text is analyzed once;
        without it the index stays fully lazy
    """
    keep = stage_table if stage else lambda df, _: df
    counted = termstats.fragment_terms(docs, analyzer) if fragments else termstats.doc_terms(docs, analyzer)
    counted = keep(counted, "doc-terms")
    terms = keep(termstats.dictionary(counted, min_df), "terms")
    stats = termstats.doc_lengths(counted)
    if norms:
        stats = keep(doc_norms(counted.join(terms.select("term", "df"), "term"), stats), "doc-norms")
    meta = keep(termstats.collection_stats(stats), "meta")
    return Index(analyzer, keep_terms(counted, terms, min_df), terms, stats, meta, counted=counted)
