"""Benchmark decontamination by template canonicalisation.

Numbers, units and names become typed placeholders that keep their values. Windows of template words of the
benchmark meet the windows of the documents in a hash join, and a document has an item if enough of the item's
windows occur in it with one consistent set of values for the placeholders: the item itself, or the item with other
numbers or names.

The documents' windows are made within their rows and joined with the benchmark's windows by broadcast where the
counted benchmark windows are few, so that no text and no window is shuffled; a larger benchmark is joined by
shuffling hashes. Only SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import small, tail
from lodestone.session import stage

#: Words in a window, and the share of an item's windows that have to occur in a document. A shorter item is one window.
WINDOW = 5
MIN_COVERAGE = 0.5
#: Windows of fewer words that are no placeholders say nothing.
MIN_PLAIN = 2

#: A capitalised word within a sentence, a number, and a unit after a number.
NAME = r"(?<=[\p{Ll},;]\x20)(\p{Lu}\p{L}*)"
NUMBER = r"(?<![\p{L}\p{N}])[+-]?[$\x{20AC}\x{A3}]?(\p{Nd}+(?:[.,:/]\p{Nd}+)*)"
UNIT = (
    r"(?<=\x{203A})\x20?((?:kg|mg|g|km|cm|mm|m|ml|l|s|ms|min|h|kmh|mph|lb|lbs|oz|ft|in|mi|hours?|minutes?|seconds?"
    r"|days?|weeks?|months?|years?|meters?|metres?|miles?|feet|inches|dollars?|euros?|cents?|percent|grams?"
    r"|kilograms?|liters?|litres?|degrees?)(?![\p{L}\p{N}]))"
)
#: What separates words. Within a number, its points and signs become the letter p.
NO_WORD = r"[^\p{L}\p{N}\x{2039}\x{203A}\x{2026}]+"


def template_words(text: Column) -> Column:
    """The lower-cased words of a text; a placeholder is one word, such as ``‹num…12›``, with its value."""
    text = F.regexp_replace(text, r"[\x{2039}\x{203A}\x{2026}]", " ")
    text = F.regexp_replace(text, NAME, " ‹name…$1›")
    text = F.regexp_replace(text, NUMBER, " ‹num…$1›")
    text = F.regexp_replace(text, r"(?<=\p{Nd})[.,:/](?=\p{Nd}+(?:[.,:/]\p{Nd}+)*\x{203A})", "p")
    text = F.regexp_replace(text, r"(?<=\x{203A})\x20?%", " ‹unit…percent› ")
    text = F.regexp_replace(text, UNIT, " ‹unit…$1› ")
    return F.filter(F.split(F.lower(text), NO_WORD), lambda w: w != "")


def _words(rows: DataFrame, key: str) -> DataFrame:
    """(key, w): the template words of each text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return rows.select(F.col(key).alias("key"), template_words(text).alias("w"))


def _windows(frame: DataFrame, lengths: list[int], whole: bool = False) -> DataFrame:
    """(key, pos, window, slots) of ``frame`` (key, w): the hash of each window's template, and its values. Windows have
    WINDOW words, and as many as the smaller numbers in ``lengths``; ``whole`` takes these of texts of that size only."""
    frame = frame.withColumn("slotted", F.exists("w", lambda w: w.startswith("‹")))
    kind = lambda w: F.when(w.startswith("‹"), F.substring_index(w, "…", 1)).otherwise(w)
    hashed = F.when(F.col("slotted"), F.transform("w", lambda w: F.xxhash64(kind(w)))).otherwise(
        F.transform("w", lambda w: F.xxhash64(w))
    )
    pair = lambda a, b: F.xxhash64(a, b)

    def joined(left: str, skip: int, right: str) -> Column:
        return F.zip_with(left, tail(F.col(right), skip), pair)

    frame = frame.withColumn("h1", hashed).withColumn("h2", joined("h1", 1, "h1"))
    frame = frame.withColumn("h4", joined("h2", 2, "h2")).withColumn("h5", joined("h4", 4, "h1"))
    if 3 in lengths:
        frame = frame.withColumn("h3", joined("h2", 2, "h1"))
    empty = F.array().cast("array<string>")

    def each(n: int) -> Column:
        """The windows of ``n`` words."""
        hashes = F.slice(f"h{n}", F.lit(1), F.greatest(F.size("w") - (n - 1), F.lit(0)))
        if whole and n < WINDOW:
            hashes = F.when(F.size("w") == n, hashes).otherwise(F.array().cast("array<bigint>"))

        def slots(i: Column) -> Column:
            return F.filter(F.slice("w", i + 1, n), lambda w: w.startswith("‹"))

        fields = lambda h, i, s: F.struct(i.alias("pos"), h.alias("window"), s.alias("slots"), F.lit(n).alias("n"))
        return F.when(F.col("slotted"), F.transform(hashes, lambda h, i: fields(h, i, slots(i)))).otherwise(
            F.transform(hashes, lambda h, i: fields(h, i, empty))
        )

    parts = [each(n) for n in sorted({WINDOW, *lengths})]
    frame = frame.select("key", F.inline(F.concat(*parts) if len(parts) > 1 else parts[0]))
    return frame.where(F.size("slots") <= F.col("n") - MIN_PLAIN).drop("n")


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, n_slots, same_values): the items of ``benchmark`` (item_id, text)
    that ``docs`` (doc_id, text) contain.

    ``n_windows`` of the item's ``item_windows`` different window positions occur in the document, at least
    ``min_coverage`` of them. Windows are judged along one diagonal (place in the document minus place in the item). A
    value of the item stands for the value of the document that it meets most often there (the larger of equals);
    windows that have it meet another one don't count. ``n_slots`` counts the values met, and ``same_values`` tells if
    all stand for themselves.

    An item of two to four words is one window. Null texts, empty texts and items of fewer than two words that are no
    placeholders have no windows and match nothing. Repeated items give a row each if their ids differ; rows that share
    a doc_id (or have none) are judged as one document.
    """
    item_words = stage(_words(benchmark, "item_id"), "benchmark-words")
    short = item_words.select(F.size("w").alias("n")).where(F.col("n").between(MIN_PLAIN, WINDOW - 1)).distinct()
    lengths = [row.n for row in short.collect()]
    items = stage(_windows(item_words, lengths, whole=True), "benchmark-windows")
    sizes = items.groupBy("key").agg(F.countDistinct("pos").alias("item_windows"))
    wanted = items.select(
        F.col("key").alias("item_id"), F.col("pos").alias("item_pos"), "window", F.col("slots").alias("item_slots")
    )
    known = small(stage(items.select("window").distinct(), "benchmark-hashes"))
    found = stage(_windows(_words(docs, "doc_id"), lengths).join(known, "window", "left_semi"), "benchmark-hits")
    hits = found.join(wanted, "window").withColumn("diagonal", F.col("pos") - F.col("item_pos"))
    pairs = hits.select(
        F.col("key").alias("doc_id"), "item_id", "diagonal", "item_pos", F.arrays_zip("item_slots", "slots").alias("z")
    )
    where = ["doc_id", "item_id", "diagonal"]
    met = pairs.select(*where, F.explode("z").alias("s")).groupBy(*where, "s.item_slots", "s.slots")
    met = met.agg(F.count("*").alias("n"))
    stands = met.groupBy(*where, "item_slots").agg(F.max(F.struct("n", "slots")).alias("most"))
    values = stands.groupBy(*where).agg(
        F.map_from_entries(F.collect_list(F.struct("item_slots", "most.slots"))).alias("values"),
        F.count("*").alias("n_slots"), F.min(F.col("item_slots") == F.col("most.slots")).alias("own"),
    )
    plain = pairs.where(F.size("z") == 0).select(*where, "item_pos")
    slotted = pairs.where(F.size("z") > 0).alias("l")
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"v.{c}")) for c in where]
    fits = F.forall("z", lambda s: F.col("values")[s["item_slots"]] == s["slots"])
    slotted = slotted.join(values.alias("v"), on[0] & on[1] & on[2]).where(fits)
    slotted = slotted.select(*[f"l.{c}" for c in where], "item_pos", "n_slots", "own")
    lined = plain.withColumns({"n_slots": F.lit(0).cast("long"), "own": F.lit(True)}).unionByName(slotted)
    covered = lined.groupBy(*where).agg(
        F.collect_set("item_pos").alias("places"), F.max("n_slots").alias("n_slots"), F.min("own").alias("own")
    )
    covered = covered.groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("n_windows"),
        F.sum("n_slots").alias("n_slots"),
        F.min("own").alias("same_values"),
    )
    result = covered.alias("c").join(sizes.alias("s"), F.col("c.item_id").eqNullSafe(F.col("s.key")))
    return result.where(F.col("n_windows") >= F.col("item_windows") * min_coverage).select(
        "doc_id", "item_id", "n_windows", "item_windows", "n_slots", "same_values"
    )


def drop_leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    leaked = decontaminate(docs, benchmark).select(F.col("doc_id").alias("_leaked")).distinct()
    return docs.join(leaked, docs["doc_id"].eqNullSafe(leaked["_leaked"]), "left_anti")
