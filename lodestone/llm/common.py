"""Helpers that several operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words; the characters of it.
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"

#: A table of at most so many rows of a few numbers (32 MB) may be sent to every executor.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text that is not null."""
    trimmed = F.btrim(text, F.lit(GAP_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def tail(array: Column, skip: int) -> Column:
    """The elements after the first ``skip``."""
    return F.slice(array, F.lit(skip + 1), F.greatest(F.size(array) - skip, F.lit(0)))


def same(left: DataFrame, right: DataFrame, **keys: str) -> Column:
    """Equality in which null equals null, of columns of ``left`` and columns of ``right``."""
    return reduce(Column.__and__, (left[a].eqNullSafe(right[b]) for a, b in keys.items()))


def small(df: DataFrame) -> DataFrame:
    """``df``, a written table of short rows, marked for broadcast if its counted rows are few enough; a larger
    one is joined by shuffling. The rows of the join are the same."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df
