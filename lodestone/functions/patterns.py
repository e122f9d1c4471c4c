r"""Token patterns, written once and usable from Spark (java.util.regex), Python ``re`` and, where it has
no lookaround, from RE2 engines.

``\w`` in this file means "letter, number or underscore" of any script, and ``\d`` and ``\s`` the digits and
spaces of any script. :func:`spark_pattern` spells that out for the JVM, whose own classes are ASCII by default
and, in Unicode mode, slower and slightly different (``\w`` would take combining marks).

Every repetition that could backtrack badly is possessive, so matching stays linear in practice and does not
use the JVM's call stack: text of any length is tokenized whole.
"""

from __future__ import annotations

import re

_JVM_SETS = {
    r"\w": r"\p{L}\p{N}_",
    r"\d": r"\p{Nd}",
    r"\s": r"\s\x1C-\x1F\x85\p{Z}",
}

# 3 to 25 word characters, optionally starting with # or @, with single ' or - inside.
SIMPLE_TOKEN = r"[#@\w](?:['\-]?\w){2,24}"

# One pattern per token class, in order of priority.
TOKEN_CLASSES = {
    "website": r"\b(?:www\.)?\w++\.com\b",
    "slash_date": r"\b(?:0?[1-9]|[12][0-9]|3[01])\/(?:0[1-9]|1[0-2])(?:\/\d{4})?",
    "date": (
        r"(?:January|March|April|May|June|July|August|September|October|November|December"
        r"|Jan|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s(?:0?[1-9]|[12][0-9]|3[01])\,\s[12][0-9]{3}"
        r"|(?:0?[1-9]|[12][0-9]|3[01])\s(?:Jan(?:uary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?"
        r"|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)\s(?:[12][0-9]{3}|\d{3})"
        r"|(?:February|Feb)\s(?:0?[1-9]|[12][0-9])\,\s[12][0-9]{3}"
        r"|(?:0?[1-9]|[12][0-9])\sFeb\s[12][0-9]{3}"
    ),
    "time": (
        r"\b(?:1[012]|0?[1-9])\.[0-5][0-9](?:AM|PM)\b"
        r"|\b(?:1[012]|0?[1-9])\:?[0-5][0-9]\s?(?:a\.m\.?|p\.m\.?|am|pm)"
        r"|\b(?:2[0-3]|[01]?[0-9])\:[0-5]?[0-9](?:\:[0-5]?[0-9])?\b"
    ),
    "number": (
        r"(?<![\w+\-.,])[+-]?\d{1,3}+(?:\,\d{3})*+(?:\.\d++)?+"
        r"(?!\d*\%|\d*\.[a-zA-Z]|\d*\,\S|\d*\.\S|\d*[a-zA-Z]|\d)"
    ),
    "percent": (
        r"(?<![\w+\-.,])[+-]?\d++(?:\,(?:\d{3})++)*+(?:\.\d++)?+\%"
        r"(?!\d*\%|\d*\.[a-zA-Z]|\d*\,\S|\d*\.\S|\d*[a-zA-Z])"
    ),
    "abbreviation": r"\b[A-Za-z]\.[A-Za-z]\.[A-Za-z]\b|\b[A-Za-z]\.[A-Za-z]\.(?!\w)",
    # A word with hyphens and at most one apostrophe, not followed by a percent sign. The three branches are:
    # up to and with the apostrophe part; up to the end of the hyphenated run; and, where a percent sign
    # follows, back to the last hyphen.
    "word": r"(?<![\-\w])(?:\w[\w\-]*+'\w*+(?!\%)|\w[\w\-]*+(?!\%)|\w[\w\-]*(?=\-\w*+\%))",
    # A tag, whose “…” and '…’ parts may hold a >; from a “ that is never closed on, “ is an ordinary character.
    # Where that finds no end, a tag in which every “ is an ordinary character.
    "html": (
        r"<(?:[^'“”>]++|“[^”]*+”|'[^’]*+’)*+(?:“(?:[^'”>]++|'[^’]*+’)*+)?+>"
        r"|<(?:[^'”>]++|'[^’]*+’)*+>"
    ),
}

#: What a match of a pattern begins with, where that is few characters: other places in a text need not be tried.
FIRST_CHARACTERS = {
    TOKEN_CLASSES["slash_date"]: "[0-9]",
    TOKEN_CLASSES["date"]: "[0-9ADFJMNOS]",
    TOKEN_CLASSES["time"]: "[0-9]",
}

RICH_TOKEN = "|".join(TOKEN_CLASSES.values())
#: What is left of it where no tag can end.
RICH_TOKEN_WITHOUT_TAGS = "|".join(pattern for name, pattern in TOKEN_CLASSES.items() if name != "html")


def spark_pattern(pattern: str, any_case: bool = False) -> str:
    r"""The pattern in JVM syntax: Unicode classes, and ``\b`` as the lookaround it stands for here
    (before a group it starts a token, elsewhere it ends one)."""
    pattern = re.sub(r"\\b(?=\(|\[)", lambda _: r"(?<!\w)", pattern)
    pattern = pattern.replace(r"\b", r"(?!\w)")
    out, in_set, i = [], False, 0
    while i < len(pattern):
        pair = pattern[i : i + 2]
        if pair in _JVM_SETS:
            out.append(_JVM_SETS[pair] if in_set else f"[{_JVM_SETS[pair]}]")
        elif pair == r"\S":
            out.append("[^" + _JVM_SETS[r"\s"] + "]")
        elif pair[0] == "\\":
            out.append(pair)
        else:
            in_set = (in_set or pair[0] == "[") and pair[0] != "]"
            out.append(pair[0])
        i += 2 if pair[0] == "\\" else 1
    return ("(?iu)" if any_case else "") + "".join(out)
