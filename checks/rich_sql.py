r"""The rich tokenizer in SQL, for an engine whose regular expressions have no lookaround.

A token can only begin where a run of word characters does, or at a sign or a tag. From each such place every class is
tried on the rest of the text, anchored: what a pattern looks ahead at is consumed outside a group or tested on what
follows the match, and what it looks back at is the character before the place. Of the matches of a place the first class
counts. Places that an earlier token covers are passed over, group by group of overlapping matches.
"""

from __future__ import annotations

W = r"[\p{L}\p{N}_]"
NOT_W = r"(?:[^\p{L}\p{N}_]|$)"
S = r"[\s\x1C-\x1F\x{85}\p{Z}]"
NOT_S = r"[^\s\x1C-\x1F\x{85}\p{Z}]"
#: What a number must not be followed by.
AFTER = rf"\p{{Nd}}*%|\p{{Nd}}*\.[a-zA-Z]|\p{{Nd}}*,{NOT_S}|\p{{Nd}}*\.{NOT_S}|\p{{Nd}}*[a-zA-Z]"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _first(pattern: str) -> str:
    """The first group of an anchored match on the rest of the text; empty without a match."""
    return f"regexp_extract(rest, {_text('^(?s:' + pattern + ')')}, 1)"


NUMBER = _first(r"([+-]?\p{Nd}{1,3}(?:,\p{Nd}{3})*(?:\.\p{Nd}+)?)")
PERCENT = _first(r"([+-]?\p{Nd}+(?:,(?:\p{Nd}{3})+)*(?:\.\p{Nd}+)?)")
RUN = _first(rf"({W}[\p{{L}}\p{{N}}_\-]*)")
NO_WORD_BEFORE = f"NOT regexp_matches(prev, {_text(W)})"
NO_NUMBER_BEFORE = f"NOT regexp_matches(prev, {_text(r'[\p{L}\p{N}_+\-.,]')})"
FOLLOWED = f"regexp_matches(substr(rest, length(num) + 1), {_text('^(?:' + AFTER + r'|\p{Nd})')})"
PERCENT_FOLLOWED = f"regexp_matches(substr(rest, length(per) + 2), {_text('^(?:' + AFTER + ')')})"
#: Class -> (what stands before, the match).
CLASSES = {
    "website": (NO_WORD_BEFORE, _first(rf"((?:www\.)?{W}+\.com){NOT_W}")),
    "slash_date": (NO_WORD_BEFORE, _first(r"((?:0?[1-9]|[12][0-9]|3[01])/(?:0[1-9]|1[0-2])(?:/\p{Nd}{4})?)")),
    "time": (
        NO_WORD_BEFORE,
        "CASE WHEN {0} <> '' THEN {0} ELSE {1} END".format(
            _first(rf"((?:1[012]|0?[1-9]):?[0-5][0-9]{S}?(?:a\.m\.?|p\.m\.?|am|pm))"),
            _first(rf"((?:2[0-3]|[01]?[0-9]):[0-5]?[0-9](?::[0-5]?[0-9])?){NOT_W}"),
        ),
    ),
    "number": (NO_NUMBER_BEFORE, f"CASE WHEN num <> '' AND NOT {FOLLOWED} THEN num ELSE '' END"),
    "percent": (
        NO_NUMBER_BEFORE,
        f"CASE WHEN per <> '' AND substr(rest, length(per) + 1, 1) = '%' AND NOT {PERCENT_FOLLOWED}"
        " THEN per || '%' ELSE '' END",
    ),
    "abbreviation": (
        NO_WORD_BEFORE,
        "CASE WHEN {0} <> '' THEN {0} ELSE {1} END".format(
            _first(rf"([A-Za-z]\.[A-Za-z]\.[A-Za-z]){NOT_W}"), _first(rf"([A-Za-z]\.[A-Za-z]\.){NOT_W}")
        ),
    ),
    "word": (
        f"NOT regexp_matches(prev, {_text(r'[\p{L}\p{N}_\-]')})",
        f"""CASE
          WHEN part <> '' AND substr(rest, length(run) + length(part) + 1, 1) <> '%' THEN run || part
          WHEN substr(rest, length(run) + 1, 1) <> '%' THEN run
          ELSE regexp_extract(run, {_text(r'^(.+)-[^-]*$')}, 1) END""",
    ),
    "html": ("true", _first("(<(?:“[^”]*”|'[^’]*’|[^'”>])*>)")),
}


def matches(name: str, source: str, keys: str, classes: list[str], lower: bool = True) -> str:
    """CTEs; the last, ``name``, has the keys, start (from 0) and tok of all matches of the classes taken together in
    the rows (keys, text) of ``source``."""
    text = "lower(text)" if lower else "text"
    found = ", ".join(f"CASE WHEN {before} THEN {match} ELSE '' END" for before, match in (CLASSES[c] for c in classes))
    part = f"regexp_extract(substr(rest, length(run) + 1), {_text(rf"^('{W}*)")}, 1)"
    by = f"PARTITION BY {keys}"
    return f"""
{name}_texts AS MATERIALIZED (SELECT {keys}, {text} AS t FROM ({source}) WHERE text IS NOT NULL),
{name}_pieces AS (
  SELECT {keys}, unnest(ps) AS piece, generate_subscripts(ps, 1) AS i
  FROM (SELECT {keys}, regexp_extract_all(t, {_text(f'(?s:{W}+|.)')}) AS ps FROM {name}_texts)),
{name}_places AS (
  SELECT {keys}, piece, coalesce(right(lag(piece) OVER o, 1), '') AS prev,
         CAST(coalesce(sum(length(piece)) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM {name}_pieces WINDOW o AS ({by} ORDER BY i)),
{name}_rests AS MATERIALIZED (
  SELECT {keys}, start, prev,
         CASE WHEN piece = '<' THEN substr(t, start + 1) ELSE substr(t, start + 1, length(piece) + 400) END AS rest
  FROM {name}_places JOIN {name}_texts USING ({keys})
  WHERE piece IN ('+', '-', '<') OR regexp_matches(piece, {_text(W)})),
{name}_found AS (
  SELECT {keys}, start, list_filter([{found}], lambda x: x <> '')[1] AS tok
  FROM (SELECT *, {part} AS part FROM (
    SELECT *, {NUMBER} AS num, {PERCENT} AS per, {RUN} AS run FROM {name}_rests))),
{name}_spans AS MATERIALIZED (
  SELECT {keys}, start, start + length(tok) AS stop, tok,
         CASE WHEN start < max(start + length(tok)) OVER (
           {by} ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens
  FROM {name}_found WHERE tok IS NOT NULL),
{name}_groups AS MATERIALIZED (
  SELECT *, sum(opens) OVER ({by} ORDER BY start) AS grp FROM {name}_spans),
{name}_alone AS (SELECT {keys}, grp FROM {name}_groups GROUP BY ALL HAVING count(*) = 1),
{name}_chains AS (
  SELECT {keys}, grp, start, stop, tok FROM {name}_groups WHERE opens = 1
  UNION ALL
  SELECT * FROM (
    SELECT g.* EXCLUDE (opens) FROM (
      SELECT {', '.join('c.' + k.strip() for k in keys.split(','))}, c.grp, min(n.start) AS start
      FROM {name}_chains c JOIN {name}_groups n
        ON {' AND '.join(f'n.{k.strip()} = c.{k.strip()}' for k in keys.split(','))} AND n.grp = c.grp AND n.start >= c.stop
      GROUP BY ALL) f
    JOIN (SELECT {keys}, grp, start, stop, tok, opens FROM {name}_groups) g USING ({keys}, grp, start))),
{name} AS (SELECT {keys}, start, tok FROM {name}_chains)"""
