"""Personal data: fixed patterns, and contextual patterns that are bootstrapped from what the fixed ones find.

The entities of the fixed patterns are seeds, and so are long hexadecimal keys, for a kind that has no fixed pattern of
its own. A seed's contexts (the word before it, the two words before it, the word after it), each with the shape of the
token, are lexical patterns. Patterns and the identifier-like tokens they surround form a bipartite graph, on which scores go to
and fro: a pattern's confidence in a kind is the mean score of its tokens that are decided, which seeds are and tokens
with a score; a token's score follows from the confident patterns around any of its occurrences. Tokens in a confident pattern are found as identifiers of its kind, though no
fixed pattern matches them.

Fixed patterns and tokens are matched within the row of a document. Only the tokens with a digit or an ``@`` leave
it, so what is shuffled grows with those. Only SQL functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.session import stage

KINDS = ("email", "ip", "card", "phone")
#: With the kind that only seeds and patterns find: keys and tokens that give access.
ALL_KINDS = (*KINDS, "secret")
SECRET = len(KINDS)
#: A key that is a seed, and what else can be one.
HEX_KEY = r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]{32,}$"
KEY = r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_+/=-]{16,}$"

#: The fixed patterns. Local parts, addresses and numbers can't start within a run of their own characters unless the
#: run was cut by the match before, and nothing is given back, so that matching is linear; matches are the same.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: A word with a digit or an @.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"

#: A pattern is confident in a kind at this mean score of its decided tokens, if their scores add up to so much.
MIN_CONFIDENCE = 0.9
MIN_SEEDS = 5
ROUNDS = 3
#: Numbers with fewer digits are no identifiers.
MIN_DIGITS = 7

_SPANS = "array<struct<s:int,e:int,v:string>>"


def occurrences(text: Column, pattern: str) -> Column:
    """The matches of a pattern that never matches nothing: (s, e, v), in code points, ``e`` exclusive."""
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("v")
    )

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.char_length(piece["gap"])
        end = start + F.char_length(piece["v"])
        match = F.struct(start.alias("s"), end.alias("e"), piece["v"].alias("v"))
        out = F.when(piece["v"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(match)))
        return F.struct(F.coalesce(end, start).alias("at"), out.cast(_SPANS).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))
    none = F.array().cast(_SPANS)
    return F.when(text.rlike(pattern), F.aggregate(pieces, start, step, lambda s: s["out"])).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weight(i: Column) -> Column:
        d = F.substr(digits, F.char_length(digits) + 1 - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    places = F.sequence(F.lit(1), F.greatest(F.char_length(digits), F.lit(1)))
    return F.aggregate(F.transform(places, weight), F.lit(0), lambda a, b: a + b) % 10 == 0


def _is_card(m: Column) -> Column:
    n = F.char_length(_digits(m["v"]))
    return F.when((n >= 14) & (n <= 19), _luhn(_digits(m["v"]))).otherwise(False)


def _is_phone(m: Column) -> Column:
    n = F.char_length(_digits(m["v"]))
    return (n >= 10) & (n <= 15)


def _is_ip(m: Column) -> Column:
    return m["v"].rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` as (doc_id, text_key, base, tokens): the spans (s, k, e, v) of the fixed patterns, ``k`` being a kind's
    place in KINDS and ``v`` what is found, sorted by start and kind, and the tokens with a digit or an @."""
    frame = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    text = F.col("t")
    frame = frame.select(
        "doc_id",
        F.md5("t").alias("text_key"),
        F.when(text.contains("@"), occurrences(text, EMAIL)).otherwise(F.array().cast(_SPANS)).alias("k0"),
        F.filter(occurrences(text, IP), _is_ip).alias("k1"),
        F.filter(occurrences(text, CARD), _is_card).alias("k2"),
        F.filter(F.when(text.contains("+"), occurrences(text, PHONE)).otherwise(F.array().cast(_SPANS)), _is_phone).alias("k3"),
        _tokens(text).alias("tokens"),
    )

    def of(k: int) -> Column:
        return F.transform(f"k{k}", lambda m: F.struct(m["s"].alias("s"), F.lit(k).alias("k"), m["e"].alias("e"), m["v"].alias("v")))

    base = F.array_sort(F.concat(*[of(k) for k in range(len(KINDS))]))
    return frame.select("doc_id", "text_key", base.alias("base"), "tokens")


def _tokens(text: Column) -> Column:
    """The tokens (s, e, v, left, left2, right): one and two words before, and the word after, in lower case and with
    digits as 0; ^ and $ at the ends of the text."""
    found, gaps = occurrences(text, TOKEN), F.split(text, TOKEN, -1)

    def plain(gap: Column) -> Column:
        return F.trim(F.translate(gap, "\t\n\x0b\x0c\r", "     "))

    def word(x: Column) -> Column:
        return F.lower(F.regexp_replace(x, "[0-9]+", "0"))

    def context(m: Column, i: Column) -> Column:
        gap, after = plain(F.get(gaps, i)), plain(F.get(gaps, i + 1))
        token_before = F.coalesce(F.get(found, i - 1)["v"], F.lit("^"))
        token_after = F.coalesce(F.get(found, i + 1)["v"], F.lit("$"))
        left = F.when(gap == "", token_before).otherwise(F.substring_index(gap, " ", -1))
        left2 = F.when(gap.contains(" "), F.substring_index(gap, " ", -2)).otherwise(F.concat_ws(" ", token_before, gap))
        right = F.when(after == "", token_after).otherwise(F.substring_index(after, " ", 1))
        return F.struct(
            m["s"].alias("s"), m["e"].alias("e"), m["v"].alias("v"),
            word(left).alias("left"), word(left2).alias("left2"), word(right).alias("right"),
        )

    return F.transform(found, context)


def _occurrences_of_tokens(base: DataFrame) -> DataFrame:
    """One row per token and pattern: its bare value (without punctuation around it) and place, the pattern, and the
    kind of the base span that starts in it, or of a key; tokens within or across a base span are left out."""
    rows = base.where(F.size("tokens") > 0).select("doc_id", "text_key", "base", F.explode("tokens").alias("t"))
    touching = F.filter("base", lambda b: (b["s"] < F.col("t.e")) & (b["e"] > F.col("t.s")))
    rows = rows.select("doc_id", "text_key", "t.*", touching.alias("touching"))
    first = F.get("touching", F.lit(0))
    seed = (first["s"] >= F.col("s")) & (first["s"] < F.col("e"))
    rows = rows.where(F.size("touching").eqNullSafe(0) | seed)
    skip = F.char_length(F.regexp_extract("v", r"^[^\p{L}\p{N}+@]*", 0))
    bare = F.regexp_replace(F.regexp_replace("v", r"^[^\p{L}\p{N}+@]+", ""), r"(?<=[\p{L}\p{N}])[^\p{L}\p{N}]+$", "")
    key = F.col("touching_size").eqNullSafe(0) & F.col("bare").rlike(HEX_KEY)
    rows = rows.withColumns({"bare": bare, "skip": skip, "touching_size": F.size("touching")})
    rows = rows.withColumn("kind", F.when(F.col("touching_size") > 0, first["k"]).when(key, SECRET))
    digits = F.char_length(_digits(F.col("bare")))
    number = F.col("bare").rlike(r"^[+(]?[0-9][0-9().+/-]*$") & (digits >= MIN_DIGITS)
    shape = F.when(F.col("kind") == SECRET, "key").when(F.col("kind") == 0, "at").when(F.col("kind").isNotNull(), "number")
    shape = F.coalesce(
        shape,
        F.when(F.col("bare").rlike(r"^[^@]+@[^@]+$"), "at").when(number, "number").when(F.col("bare").rlike(KEY), "key"),
    )
    start = F.col("s") + F.col("skip")
    patterns = F.array(*[F.concat_ws(" ", F.lit(c), "shape", c) for c in ("left", "left2", "right")])
    return rows.withColumn("shape", shape).where(F.col("shape").isNotNull()).select(
        "doc_id", "text_key", start.alias("s"), (start + F.char_length("bare")).alias("e"),
        F.lower(F.when(F.col("touching_size") > 0, first["v"]).otherwise(F.col("bare"))).alias("value"), "kind",
        F.explode(patterns).alias("pattern"),
    )


def _never(value: Column, kind: Column) -> Column:
    """Whether a token is no identifier of a kind: a number as long as cards, which isn't one, or too long for phones, or
    without the four parts of addresses."""
    n = F.char_length(_digits(value))
    wrong = ((kind == 2) & (n >= 14) & (n <= 19)) | ((kind == 3) & (n > 15))
    return wrong | ((kind == 1) & ~value.rlike(r"^[0-9]+(\.[0-9]+){3}$"))


def confident_patterns(tokens: DataFrame, min_confidence: float, min_seeds: int, rounds: int) -> DataFrame:
    """(pattern, kind, confidence): ``rounds`` times, patterns are scored by their tokens and tokens by their patterns.

    A token is one value in one pattern, counted once however often it occurs; a seed scores 1 for its kind and 0
    for others. Another token's score for a kind is 1 - Π(1 - confidence) over the confident patterns around its value,
    of the round before; as long as it has none for any kind it is undecided, and no evidence against a kind unless its
    digits rule the kind out. (Nothing rules a key out, so that every value counts for secrets.) A pattern
    needs scores of ``min_seeds`` in all, from seeds or from tokens that rounds before have found.
    """
    edges = stage(tokens.groupBy("pattern", "value").agg(F.min("kind").alias("seed")), "pii-edges")
    scores = edges.where("seed IS NOT NULL").select("pattern", "value", F.col("seed").alias("kind"), F.lit(1.0).alias("score"))
    kinds = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("kind")
    ruled_out = edges.where("seed IS NULL AND split(pattern, ' ')[1] = 'number'").select("pattern", "value", kinds).where(_never(F.col("value"), F.col("kind")))
    keys = edges.where("seed IS NULL AND split(pattern, ' ')[1] = 'key'")
    ruled_out = ruled_out.unionByName(keys.select("pattern", "value", F.lit(SECRET).alias("kind")))
    found = scores
    for _ in range(rounds):
        scored = found.groupBy("pattern", "kind").agg(F.sum("score").alias("score"))
        decided = found.select("pattern", "value").join(scored.select("pattern", "kind"), "pattern")
        decided = decided.unionByName(ruled_out).distinct().groupBy("pattern", "kind").agg(F.count("*").alias("n"))
        confidence = F.col("score") / F.col("n")
        # scores are added up in any order
        enough = (F.col("score") >= min_seeds - 1e-9) & (confidence >= min_confidence - 1e-9)
        confident = scored.join(decided, ["pattern", "kind"]).where(enough)
        confident = stage(confident.select("pattern", "kind", confidence.alias("confidence")), "pii-patterns")
        around = edges.join(confident, "pattern").groupBy("value", "kind")
        by_value = around.agg(F.product(1 - F.col("confidence")).alias("miss"))
        unseen = edges.where("seed IS NULL").join(by_value, "value").where(~_never(F.col("value"), F.col("kind")))
        found = scores.unionByName(unseen.select("pattern", "value", "kind", (1 - F.col("miss")).alias("score")))
    best = confident.groupBy("pattern").agg(F.max(F.struct("confidence", (-F.col("kind")).alias("k"))).alias("b"))
    return best.select("pattern", (-F.col("b.k")).alias("kind"), "b.confidence")


def find_pii(
    docs: DataFrame, min_confidence: float = MIN_CONFIDENCE, min_seeds: int = MIN_SEEDS, rounds: int = ROUNDS
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): (doc_id, text_key, base, spans). ``base`` and ``spans`` are arrays
    of (s, k, e), sorted: start, kind (place in ALL_KINDS) and end in code points, end exclusive. ``spans`` holds the base
    spans, keys, and what confident patterns add, each of the kind of its most confident pattern; the latter touch no
    base span.

    A null text counts as empty and has no spans. Rows that share doc_id and text (null ids included) get the same
    spans. Without seeds, nothing is added. Other columns of ``docs`` are ignored.
    """
    base = stage(base_spans(docs), "pii-base")
    tokens = stage(_occurrences_of_tokens(base), "pii-tokens")
    patterns = confident_patterns(tokens, min_confidence, min_seeds, rounds)
    new = tokens.where("kind IS NULL").drop("kind").join(patterns, "pattern").where(~_never(F.col("value"), F.col("kind")))
    place = ["doc_id", "text_key", "s", "e"]
    new = new.groupBy(*place).agg(F.max(F.struct("confidence", (-F.col("kind")).alias("k"))).alias("b"))
    new = new.select(*place, (-F.col("b.k")).alias("kind")).unionByName(tokens.where(F.col("kind") == SECRET).select(*place, "kind"))
    new = new.select("doc_id", "text_key", F.struct("s", F.col("kind").alias("k"), "e").alias("span"))
    new = new.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.collect_set("span").alias("_added")
    )
    plain = F.transform("base", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    base = base.withColumn("base", plain)
    match = base["doc_id"].eqNullSafe(new["_id"]) & (base["text_key"] == new["_key"])
    spans = F.when(F.col("_added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "_added")))
    return base.join(new, match, "left").select("doc_id", "text_key", "base", spans.alias("spans"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in ALL_KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, spans that overlap taken together, as the name of its first kind: ``<EMAIL>``."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in ALL_KINDS])

    def step(state: Column, x: Column) -> Column:
        gap = F.substr(text, state["at"] + 1, F.greatest(x["s"] - state["at"], F.lit(0)))
        inside = x["s"] < state["at"]
        out = F.when(inside, state["out"]).otherwise(F.concat(state["out"], gap, F.get(names, x["k"])))
        return F.struct(F.greatest(state["at"], x["e"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    end = lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.char_length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, end))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind; ``n_chars``, if there, follows the text. Null texts stay, and so do
    other columns, whatever their names."""
    found = find_pii(docs).where(F.size("spans") > 0).select("doc_id", "text_key", "spans")
    found = found.dropDuplicates(["doc_id", "text_key"]).alias("found")
    rows = docs.select(F.struct("*").alias("doc")).alias("rows")
    same = F.col("rows.doc.doc_id").eqNullSafe(F.col("found.doc_id")) & (F.md5("rows.doc.text") == F.col("found.text_key"))
    text = F.col("rows.doc.text")
    text = F.when(F.col("found.spans").isNull(), text).otherwise(redacted(text, F.col("found.spans")))
    joined = rows.join(found, same, "left").select("rows.doc", text.alias("text"))
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return joined.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
