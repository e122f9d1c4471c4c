"""Analyzers: text column -> array<string> token column, without leaving the expression tree.

Any ``Callable[[Column], Column]`` with that shape can be passed where an analyzer is expected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.patterns import (
    FIRST_CHARACTERS,
    RICH_TOKEN,
    RICH_TOKEN_WITHOUT_TAGS,
    SIMPLE_TOKEN,
    TOKEN_CLASSES,
    spark_pattern,
)
from lodestone.functions.stemmer import stem_tokens
from lodestone.functions.words import STOPWORDS

Analyzer = Callable[[Column], Column]

ANALYZERS = {
    # name: (pattern, stemmed)
    "simple": (SIMPLE_TOKEN, False),
    "simple_stem": (SIMPLE_TOKEN, True),
    "rich_stem": (RICH_TOKEN, True),
}


def remove_stopwords(tokens: Column, stopwords: Iterable[str] = STOPWORDS) -> Column:
    """Drop stop words, keeping order and repeats of the rest."""
    stopwords = list(stopwords)
    return F.filter(tokens, lambda t: ~t.isin(stopwords)) if stopwords else tokens


def _matches(text: Column, pattern: str, any_case: bool = False) -> Column:
    """All matches. Behind the last > no tag can end, so none is tried there: each < would have the rest of the text
    scanned for one."""

    def found(part: Column, pattern: str) -> Column:
        return F.regexp_extract_all(part, F.lit(spark_pattern(pattern, any_case)), F.lit(0))

    if pattern in FIRST_CHARACTERS:
        return found(text, f"(?={FIRST_CHARACTERS[pattern]})(?:{pattern})")
    if pattern not in (RICH_TOKEN, TOKEN_CLASSES["html"]):
        return found(text, pattern)
    after = F.substring_index(text, ">", -1)
    before = F.substr(text, F.lit(1), F.char_length(text) - F.char_length(after))
    if pattern == RICH_TOKEN:
        return F.concat(found(before, pattern), found(after, RICH_TOKEN_WITHOUT_TAGS))
    return found(before, pattern)


def _tokens(
    text: Column, *, pattern: str, stemmed: bool, stopwords: tuple[str, ...], any_case: bool, drop_html: bool
) -> Column:
    tokens = _matches(F.lower(text), pattern, any_case)
    tokens = remove_stopwords(tokens, stopwords)
    if drop_html:
        tokens = F.filter(tokens, lambda t: ~t.startswith("<"))
    return stem_tokens(tokens) if stemmed else tokens


def analyzer(
    spec: str | Analyzer,
    stopwords: Iterable[str] = STOPWORDS,
    any_case: bool = False,
    drop_html: bool = False,
) -> Analyzer:
    """``simple``, ``simple_stem`` or ``rich_stem``; a callable is returned as it is.

    Text is lowercased first, so the capitalised month names of the rich pattern match only with
    ``any_case``. Tags are tokens of the rich pattern unless ``drop_html``.
    """
    if callable(spec):
        return spec
    pattern, stemmed = ANALYZERS[spec]
    return partial(
        _tokens,
        pattern=pattern,
        stemmed=stemmed,
        stopwords=tuple(stopwords),
        any_case=any_case,
        drop_html=drop_html,
    )


def analyze(df: DataFrame, text: str, spec: str | Analyzer, out: str = "tokens", **options) -> DataFrame:
    """Replace the text column by its token array."""
    return df.withColumn(out, analyzer(spec, **options)(F.col(text))).drop(text)


def extract_classes(df: DataFrame, text: str, classes: Iterable[str] = tuple(TOKEN_CLASSES), counted: bool = False) -> DataFrame:
    """One row per match of each single token class in the raw text: ``..., token_class, value``; ``counted``, one per
    different match of a row, with how often it occurs there: ``..., token_class, value, n``."""
    found = F.array(
        *[
            F.struct(
                F.lit(name).alias("token_class"),
                _matches(F.col(text), TOKEN_CLASSES[name]).alias("found"),
            )
            for name in classes
        ]
    )
    rest = [c for c in df.columns if c != text]
    per_class = df.select(*rest, F.inline(found))
    if not counted:
        return per_class.select(*rest, "token_class", F.explode("found").alias("value"))
    from lodestone.operators.termstats import counted_tokens  # which imports this module

    counts = counted_tokens(per_class.where(F.size("found") > 0), "found", lambda matches: matches)
    return counts.select(*rest, "token_class", F.col("term").alias("value"), F.col("tf").alias("n"))
