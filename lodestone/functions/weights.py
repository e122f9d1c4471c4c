"""Ranking formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bm25_idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def bm25_term(idf: Column, tf: Column, doc_len: Column, avg_len: Column, k1: float, b: float) -> Column:
    return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * doc_len / avg_len))


def tfidf(tf: Column, length: Column, n_docs: Column, df: Column, smoothing: float = 0.0) -> Column:
    """Frequency over length, times the base-10 log of N over df."""
    return tf / length * F.log10(n_docs / (df + smoothing))


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(a / F.nullif(b, F.lit(0.0)), F.lit(0.0))


def min_max_scale(x: Column, low: Column, high: Column) -> Column:
    """Into [0, 1]; a constant list becomes 0."""
    return ratio(x - low, high - low)
