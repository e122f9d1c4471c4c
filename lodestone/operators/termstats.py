"""Counts over analyzed documents: term frequencies, document lengths and the dictionary.

A document is one row, so its term frequencies and length are computed inside the row: sort the token array,
find where each run of equal tokens starts, and take the distance to the next start. No token ever crosses
the network; the first shuffle of an index build is the one over (already counted) terms.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.analyzers import Analyzer, analyzer, extract_classes
from lodestone.functions.patterns import TOKEN_CLASSES
from lodestone.session import stage


def counted_tokens(df: DataFrame, text: str, spec: str | Analyzer, numbered: bool = False) -> DataFrame:
    """Per row: the other columns, ``n_tokens``, and one output row per distinct token with its count.
    Rows without a token give nothing. ``numbered`` adds ``term_no``, the place of the token in sorted order."""
    rest = [c for c in df.columns if c != text]
    tokens = df.select(*rest, F.sort_array(analyzer(spec)(F.col(text))).alias("_sorted"))
    size = F.size("_sorted")  # a null or empty array has no runs
    positions = F.when(size > 0, F.sequence(F.lit(0), size - 1))
    starts = tokens.withColumn(
        "_starts",
        F.filter(positions, lambda i: (i == 0) | (F.get(F.col("_sorted"), i) != F.get(F.col("_sorted"), i - 1))),
    )
    # Only places are exploded, so that terms and counts are generated code. For an explode that isn't outer the
    # optimizer infers a filter on the places and pushes it down, repeating the whole expression.
    runs = starts.select(*rest, "_sorted", "_starts", F.posexplode_outer("_starts").alias("_run", "_at"))
    return runs.where(F.col("_at").isNotNull()).select(
        *rest,
        size.cast("long").alias("n_tokens"),
        F.get("_sorted", F.col("_at")).alias("term"),
        (F.coalesce(F.get("_starts", F.col("_run") + 1), size) - F.col("_at")).cast("long").alias("tf"),
        *([F.col("_run").alias("term_no")] if numbered else []),
    )


def class_counts(texts: DataFrame, text: str, classes: Iterable[str] = tuple(TOKEN_CLASSES)) -> DataFrame:
    """``(..., token_class, value, n)``: how often each match of the token classes occurs in all texts with the same other
    columns.

    Matches are counted in their row. Only those of rows whose other columns come again, null with null, are shuffled
    and added up.
    """
    keys = [c for c in texts.columns if c != text]
    again = texts.groupBy(*keys).agg(F.count("*").alias("_rows")).where("_rows > 1").select(*[F.col(c).alias(f"_{c}") for c in keys])
    again = stage(again, "repeated-keys")
    if again.isEmpty():
        return extract_classes(texts, text, classes, counted=True)
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    once = extract_classes(texts.join(again, same, "left_anti"), text, classes, counted=True)
    more = extract_classes(texts.join(again, same, "left_semi"), text, classes, counted=True)
    return once.unionByName(more.groupBy(*keys, "token_class", "value").agg(F.sum("n").alias("n")))


def doc_terms(docs: DataFrame, spec: str | Analyzer) -> DataFrame:
    """``(doc_id, text)`` with one row per document -> ``(term, doc_id, tf, doc_len)``."""
    return counted_tokens(docs.select("doc_id", "text"), "text", spec).select(
        "term", "doc_id", "tf", F.col("n_tokens").alias("doc_len")
    )


def fragment_terms(fragments: DataFrame, spec: str | Analyzer) -> DataFrame:
    """The same for documents spread over many ``(doc_id, text)`` rows, as anchor texts are: fragments are
    counted where they are and the counts added up, so a document with very many fragments is never
    gathered in one place."""
    return add_counts(counted_tokens(fragments.select("doc_id", "text"), "text", spec))


def add_counts(*counted: DataFrame) -> DataFrame:
    """``(term, doc_id, tf, doc_len)`` from parts of the counts ``(term, doc_id, tf)``, added up."""
    every = counted[0].select("doc_id", "term", "tf")
    for more in counted[1:]:
        every = every.unionByName(more.select("doc_id", "term", "tf"))
    tf = every.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))
    lengths = tf.groupBy("doc_id").agg(F.sum("tf").alias("doc_len"))
    return tf.join(lengths, "doc_id").select("term", "doc_id", "tf", "doc_len")


def doc_lengths(doc_terms: DataFrame) -> DataFrame:
    """``(doc_id, doc_len)`` of documents that have a token."""
    return doc_terms.groupBy("doc_id").agg(F.sum("tf").alias("doc_len"))


def combined_lengths(*lengths: DataFrame) -> DataFrame:
    """Lengths added up over fields."""
    every = lengths[0].select("doc_id", "doc_len")
    for more in lengths[1:]:
        every = every.unionByName(more.select("doc_id", "doc_len"))
    return every.groupBy("doc_id").agg(F.sum("doc_len").alias("doc_len"))


def dictionary(doc_terms: DataFrame, min_df: int = 0) -> DataFrame:
    """``(term, df, term_total)`` of the terms in more than ``min_df`` documents."""
    terms = doc_terms.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("term_total"))
    return terms.where(F.col("df") > min_df) if min_df > 0 else terms


def collection_stats(lengths: DataFrame) -> DataFrame:
    """One row ``(n_docs, avg_len)``."""
    return lengths.agg(F.count("*").alias("n_docs"), F.avg("doc_len").alias("avg_len"))


def posting_blocks(postings: DataFrame, width: int = 1 << 16) -> DataFrame:
    """Posting lists as arrays sorted by document id, for export and term-by-term iteration:
    ``(term, block, n, postings)``.

    A list is cut into blocks of document ids ``[block * width, (block + 1) * width)``, so the longest array is
    ``width`` entries however frequent the term; the blocks of a term in order are its whole list.
    """
    block = F.floor(F.col("doc_id") / width).alias("block")
    return postings.groupBy("term", block).agg(
        F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")
    )
