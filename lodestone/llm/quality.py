"""Line-first cleaning: rules judge single lines, failing lines go, and documents that lose too much text are rejected.

Everything happens within the row of a document, with SQL functions only: no shuffle, and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import tail, words

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: A document has to keep so many percent of the characters of its lines.
MIN_KEPT_PERCENT = 50

A_WORD = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
#: Line rules, as patterns whose matches are counted: a line fails with more than one match for four words.
SEPARATOR = r"[|\x{BB}\x{203A}\x{2022}]"
SYMBOL_RUN = r"[#*$%&<>]{2,}"
SHOUT = r"!{2,}"
PUNCTUATION = r"[.!?,;:\x{2026}\x{3002}\x{FF01}\x{FF1F}\x{60C}\x{61F}\x{964}]"
BOILERPLATE = (
    r"(?i)all rights reserved|licensed under|released under the|copyright \d|cookie policy|privacy policy"
    r"|terms of (use|service)|subscribe to our|enable javascript|sign up for"
)
#: Longer lines that contain a boilerplate phrase are prose about it.
BOILERPLATE_WORDS = 25
#: Shorter lines are titles, which need no punctuation and may be in capitals.
PROSE_WORDS = 8


def line_fails(line: Column) -> Column:
    """Whether a line with a word breaks a rule: navigation (separators between the words), symbols or exclamation
    marks stuck to the words, capitals only, prose without any punctuation mark, or a boilerplate phrase."""
    n = F.regexp_count(line, F.lit(A_WORD + "+"))

    def many(pattern: str) -> Column:
        return F.regexp_count(line, F.lit(pattern)) * 4 > n

    capitals = (F.upper(line) == line) & (F.lower(line) != line)
    return (
        many(SEPARATOR)
        | many(SYMBOL_RUN)
        | many(SHOUT)
        | ((n >= PROSE_WORDS) & (capitals | ~line.rlike(PUNCTUATION)))
        | ((n <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE))
    )


def _repeated_words(frame: DataFrame) -> DataFrame:
    """Adds ``_n_repeat``: the words that lie in windows found twice or more in the text.

    Windows are compared by 64-bit hashes, built by doubling (1, 2, 4, 8 words). A text whose windows all differ
    is done after that; otherwise the windows are sorted, and the positions of equal neighbours are covered.
    """

    def paired(array: Column, skip: int) -> Column:
        return F.zip_with(array, tail(array, skip), lambda a, b: F.xxhash64(a, b))

    hashes = F.transform("_words", lambda w: F.xxhash64(w))
    frame = frame.withColumn("_h1", hashes).withColumn("_h2", paired(F.col("_h1"), 1))
    frame = frame.withColumn("_h4", paired(F.col("_h2"), 2)).withColumn("_h8", paired(F.col("_h4"), 4))
    count = F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))
    frame = frame.withColumn("_windows", F.slice("_h8", F.lit(1), count))
    placed = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    frame = frame.withColumn(
        "_placed", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), placed)
    )

    def twice(x: Column, k: Column) -> Column:
        before, after = F.get("_placed", k - 1)["h"], F.get("_placed", k + 1)["h"]
        return before.eqNullSafe(x["h"]) | after.eqNullSafe(x["h"])

    hits = F.array_sort(F.transform(F.filter("_placed", twice), lambda x: x["i"]))
    frame = frame.withColumn("_hits", hits)
    window = F.lit(WINDOW)
    covered = F.zip_with("_hits", tail(F.col("_hits"), 1), lambda a, b: F.coalesce(F.least(b - a, window), window))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)
    return frame.withColumn("_n_repeat", F.coalesce(total, F.lit(0).cast("long")))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): a struct ``doc`` of all its columns, the measures
    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``, ``base_failed``, the line counts ``n_lines,
    n_failed_lines``, the ``cleaned`` text and ``kept``.

    Failing lines and repetitions of earlier lines are taken out of ``cleaned``; a text that loses none is left as
    it is, to the byte, and from others blank lines go too. A document is kept if it passes the base rules and
    keeps half of the characters of its lines. A null text counts as empty: no words, hence rejected. Repeated rows
    are judged alike, each by itself, null ids included; no name of a column of ``docs`` clashes with the results.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    frame = docs.select(F.struct("*").alias("_doc"), text.alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(A_WORD))
    frame = frame.withColumn("_words", words(F.col("_text"))).withColumn("_lines", lines)
    frame = _repeated_words(frame)
    frame = frame.withColumn("_once", F.array_distinct("_lines"))
    frame = frame.withColumn("_good", F.filter("_once", lambda line: ~line_fails(line)))

    def chars(array: str) -> Column:
        return F.aggregate(array, F.lit(0).cast("long"), lambda n, line: n + F.char_length(line))

    n_words = F.size("_words").cast("long")
    base_failed = (n_words < MIN_WORDS) | (F.col("_n_repeat") * 100 > n_words * MAX_REPEAT_PERCENT)
    untouched = F.size("_good") == F.size("_lines")
    enough = chars("_good") * 100 >= chars("_lines") * MIN_KEPT_PERCENT
    return frame.select(
        F.col("_doc").alias("doc"),
        n_words.alias("n_words"),
        F.char_length(F.regexp_replace("_text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size("_once")).cast("long").alias("n_dup_lines"),
        F.col("_n_repeat").alias("n_repeat_words"),
        base_failed.alias("base_failed"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_once") - F.size("_good")).cast("long").alias("n_failed_lines"),
        F.when(untouched, F.col("_text")).otherwise(F.array_join("_good", "\n")).alias("cleaned"),
        (~base_failed & enough).alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The kept documents with their cleaned texts, in the columns of ``docs``. ``n_chars`` follows the text.

    A filter on computed columns is pushed below them with all their rules spelled out in it, again for each use. What
    a generator makes isn't: the judged rows pass through one, an array of one row each.
    """
    new = {"text": F.col("cleaned"), "n_chars": F.char_length("cleaned").cast("long")}
    doc = F.struct(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
    judged = quality_rules(docs).select(F.inline(F.array(F.struct(doc.alias("doc"), F.col("kept").alias("kept")))))
    return judged.where("kept").select("doc.*")
