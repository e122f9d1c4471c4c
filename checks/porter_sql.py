"""Porter stemming in SQL, to check the stemmed queries: CTEs from words(term) to stem_of(term, stem).

A ``y`` that counts as a consonant is written ``Y`` up front, so that vowels are ``[aeiouy]`` from then on and the
measure conditions are plain regular expressions.
"""

from __future__ import annotations

from lodestone.functions import stemmer

V, C = "[aeiouy]", "[^aeiouy]"


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def some(x: str) -> str:  # measure > 0
    return f"regexp_matches({x}, '^{C}*{V}+{C}')"


def more(x: str) -> str:  # measure > 1
    return f"regexp_matches({x}, '^{C}*{V}+{C}+{V}+{C}')"


def short(x: str) -> str:
    return f"regexp_matches({x}, '^{V}{C}$|{C}{V}[^aeiouywxY]$')"


def suffix_case(rules, condition) -> str:
    """The first suffix that fits decides; it is replaced if the condition holds for the stem."""
    cases = ""
    for suffix, repl in rules:
        stem = f"left(w, -{len(suffix)})"
        test = condition(stem)
        if suffix == "ion":
            test += f" AND regexp_matches({stem}, '[st]$')"
        cases += f" WHEN ends_with(w, '{suffix}') THEN CASE WHEN {test} THEN {stem} || '{repl}' ELSE w END"
    return f"CASE{cases} ELSE w END"


def stem_ctes(words: str) -> str:
    irregular = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in stemmer._IRREGULAR.items())
    steps = [
        # plurals
        """CASE WHEN ends_with(w, 'ies') THEN left(w, CASE WHEN length(w) = 4 THEN -1 ELSE -2 END)
           WHEN ends_with(w, 'sses') THEN left(w, -2) WHEN ends_with(w, 'ss') THEN w
           WHEN ends_with(w, 's') THEN left(w, -1) ELSE w END""",
        # past and -ing; a cut word gets a mark, and is repaired in the next step
        f"""CASE WHEN ends_with(w, 'ied') THEN left(w, CASE WHEN length(w) = 4 THEN -1 ELSE -2 END)
           WHEN ends_with(w, 'eed') THEN CASE WHEN {some("left(w, -3)")} THEN left(w, -1) ELSE w END
           WHEN ends_with(w, 'ed') AND regexp_matches(left(w, -2), '{V}') THEN left(w, -2) || '|'
           WHEN ends_with(w, 'ing') AND regexp_matches(left(w, -3), '{V}') THEN left(w, -3) || '|' ELSE w END""",
        f"""CASE WHEN NOT ends_with(w, '|') THEN w
           WHEN regexp_matches(w, '(at|bl|iz)[|]$') THEN left(w, -1) || 'e'
           WHEN length(w) > 2 AND lower(substr(w, -2, 1)) = lower(substr(w, -3, 1))
                AND regexp_matches(w, '{C}[|]$')
             THEN CASE WHEN regexp_matches(w, '[lsz][|]$') THEN left(w, -1) ELSE left(w, -2) END
           WHEN {some("left(w, -1)")} AND NOT {more("left(w, -1)")} AND {short("left(w, -1)")}
             THEN left(w, -1) || 'e'
           ELSE left(w, -1) END""",
        "CASE WHEN ends_with(w, 'y') AND length(w) > 2 THEN left(w, -1) || 'i' ELSE w END",
        f"CASE WHEN ends_with(w, 'alli') AND {some('left(w, -4)')} THEN left(w, -2) ELSE w END",
        f"""CASE WHEN ends_with(w, 'logi') THEN CASE WHEN {some("left(w, -3)")} THEN left(w, -1) ELSE w END
           ELSE {suffix_case(stemmer._STEP2, some)} END""",
        suffix_case(stemmer._STEP3, some),
        suffix_case([(s, "") for s in stemmer._STEP4], more),
        f"""CASE WHEN ends_with(w, 'e') AND ({more("left(w, -1)")}
                OR {some("left(w, -1)")} AND NOT {short("left(w, -1)")}) THEN left(w, -1) ELSE w END""",
        f"CASE WHEN ends_with(w, 'll') AND {more('left(w, -1)')} THEN left(w, -1) ELSE w END",
    ]
    marked = "regexp_replace(regexp_replace(term, '(^|[aeiou])y', '\\1Y', 'g'), 'yy', 'yY', 'g')"
    ctes = f"words AS ({words}),\nstep0 AS (SELECT term, {marked} AS w FROM words),\n"
    for i, step in enumerate(steps, 1):
        ctes += f"step{i} AS (SELECT term, {step} AS w FROM step{i - 1}),\n"
    return (
        ctes
        + f"""stem_of AS (
  SELECT term, CASE term {irregular} ELSE CASE WHEN length(term) <= 2 THEN term ELSE replace(w, 'Y', 'y') END
    END AS stem
  FROM step{len(steps)})"""
    )
