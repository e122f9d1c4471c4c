"""Porter stemming of token arrays (M. F. Porter, "An algorithm for suffix stripping", 1980), with the
widely used extensions: a pool of irregular words, words of one or two letters left alone, ``y`` -> ``i``
only after a consonant that is not the first letter, ``ies``/``ied`` -> ``ie`` in four-letter words, and the
suffix rules ``-alli``, ``-fulli`` and ``-logi``.

The Spark side is one Arrow function per batch: the batch's distinct words are stemmed once and the result
is spread over the arrays by dictionary index, so a frequent word costs no Python work.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Irregular forms.
_IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}

# Suffix tables of steps 2, 3 and 4, tried in this order; the first that fits decides.
_STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
)
_STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
)
_STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """One letter per character: v for a vowel, c for a consonant (y is a vowel after a consonant)."""
    out: list[str] = []
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and out and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_syllable(word: str) -> bool:
    shape = _shape(word)
    if len(word) == 2:
        return shape == "vc"
    return shape.endswith("cvc") and word[-1] not in "wxy"


def _plural(w: str) -> str:
    if w.endswith("ies") and len(w) == 4:
        return w[:-1]
    for suffix, repl in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(suffix):
            return w[: len(w) - len(suffix)] + repl
    return w


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-3] + ("ie" if len(w) == 4 else "i")
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suffix in ("ed", "ing"):
        if w.endswith(suffix) and _has_vowel(w[: len(w) - len(suffix)]):
            stem = w[: len(w) - len(suffix)]
            break
    else:
        return w
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _double_consonant(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    if _measure(stem) == 1 and _short_syllable(stem):
        return stem + "e"
    return stem


def _replace(w: str, table: tuple[tuple[str, str], ...]) -> str:
    for suffix, repl in table:
        if w.endswith(suffix):
            stem = w[: len(w) - len(suffix)]
            return stem + repl if _measure(stem) > 0 else w
    return w


def _step2(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _step2(w[:-4] + "al")
    if w.endswith("logi"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    return _replace(w, _STEP2)


def _step4(w: str) -> str:
    for suffix in _STEP4:
        if w.endswith(suffix):
            stem = w[: len(w) - len(suffix)]
            fits = _measure(stem) > 1 and (suffix != "ion" or stem[-1] in "st")
            return stem if fits else w
    return w


def _final_e(w: str) -> str:
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _short_syllable(stem)):
            w = stem
    if w.endswith("ll") and _measure(w[:-1]) > 1:
        w = w[:-1]
    return w


@lru_cache(maxsize=1 << 17)
def porter_stem(word: str) -> str:
    word = word.lower()
    if word in _IRREGULAR:
        return _IRREGULAR[word]
    if len(word) <= 2:
        return word
    w = _past(_plural(word))
    if w.endswith("y") and len(w) > 2 and _shape(w)[-2] == "c":
        w = w[:-1] + "i"
    return _final_e(_step4(_replace(_step2(w), _STEP3)))


def _stem_batch(tokens: pa.Array) -> pa.Array:
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("int32")
    words = tokens.flatten().dictionary_encode()
    stems = pa.array([porter_stem(w) for w in words.dictionary.to_pylist()], pa.string())
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), stems.take(words.indices), mask=tokens.is_null() if tokens.null_count else None
    )


def stem_tokens(tokens: Column) -> Column:
    """array<string> -> array<string> of Porter stems, same length and order.

    It is marked as not deterministic, though it is, so that the planner never copies it: a filter that it infers from
    an explode of the stems would have every text analyzed and stemmed twice, with two Python workers for each task.
    """
    return F.arrow_udf(_stem_batch, "array<string>").asNondeterministic()(tokens)
