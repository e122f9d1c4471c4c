"""DuckDB SQL of the registered queries, where SQL can express them. The others need a tokenizer, iteration, Spark's
hashes or positional matches and are tested against brute-force versions in tests/llm."""

from __future__ import annotations

#: Per conversation from its turns; an escaped control string is one character longer, a newline in a role five.
CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
written AS (
  SELECT *, length(role) + len(regexp_extract_all(role, '<\\*[|]')) + 5 * len(regexp_extract_all(role, '\n'))
            + length(text) + len(regexp_extract_all(text, '<\\*[|]'))
            + length('<|im_start|>') + length('<|im_end|>') + 2 AS chars
  FROM turns),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         CAST(sum(chars) AS BIGINT) AS formatted_chars
  FROM written GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars
FROM joined"""

QUALITY = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM texts),
placed AS (SELECT doc_id, unnest(range(len(ws))) AS pos, unnest(ws) AS w FROM split),
windows AS (
  SELECT doc_id, pos, lead(w, 7) OVER o AS last,
         concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o,
                   lead(w, 5) OVER o, lead(w, 6) OVER o, lead(w, 7) OVER o) AS k
  FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
twice AS (
  SELECT doc_id, pos FROM windows WHERE last IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
repeated AS (
  SELECT doc_id, CAST(sum(covers) AS BIGINT) AS n_repeat_words
  FROM (SELECT doc_id, least(8, coalesce(lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) - pos, 8)) AS covers FROM twice)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
once AS (SELECT DISTINCT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM lines),
judged AS (
  SELECT doc_id, line,
         len(regexp_extract_all(line, '[|\x{BB}\x{203A}\x{2022}]')) * 4 > n
         OR len(regexp_extract_all(line, '[#*$%&<>]{2,}')) * 4 > n
         OR len(regexp_extract_all(line, '!{2,}')) * 4 > n
         OR n >= 8 AND (upper(line) = line AND lower(line) <> line
                        OR NOT regexp_matches(line, '[.!?,;:\x{2026}\x{3002}\x{FF01}\x{FF1F}\x{60C}\x{61F}\x{964}]'))
         OR n <= 25 AND regexp_matches(line, '(?i)all rights reserved|licensed under|released under the|copyright \d|cookie policy|privacy policy|terms of (use|service)|subscribe to our|enable javascript|sign up for') AS fails
  FROM once),
all_lines AS (SELECT doc_id, count(*) AS n_lines, sum(length(line)) AS chars FROM lines GROUP BY doc_id),
own_lines AS (
  SELECT doc_id, count(*) AS n_once, count(*) FILTER (fails) AS n_failed_lines,
         coalesce(sum(length(line)) FILTER (NOT fails), 0) AS good_chars
  FROM judged GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         coalesce(n_lines - n_once, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_failed_lines, 0) AS n_failed_lines,
         coalesce(good_chars * 100 >= chars * 50, false) AS enough
  FROM split LEFT JOIN repeated USING (doc_id) LEFT JOIN all_lines USING (doc_id) LEFT JOIN own_lines USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND enough AS kept, n_lines, n_failed_lines
FROM measured"""


#: All scores of the anchors, by joining components.
HARD_NEGATIVES = """
WITH fine AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, label, unnest(range(len(v))) AS i, unnest(v) AS x FROM fine),
scores AS (
  SELECT a.vec_id AS a, r.vec_id AS r, a.label = r.label AS same, CAST(sum(a.x * r.x) AS BIGINT) AS score
  FROM parts a JOIN parts r ON a.i = r.i AND a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0 GROUP BY ALL),
positives AS (
  SELECT a, r, score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, r) <= 5)
SELECT p.a AS anchor_id, p.r AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.r ORDER BY n.score DESC, n.r) AS INTEGER) AS rank,
       n.r AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.a = p.a AND NOT n.same
WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.r ORDER BY n.score DESC, n.r) <= 10"""

#: Every node with all its ancestors; the checksum is the bitwise CRC-32 of the decimal id.
PREFIX_TRIE = """
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (
  SELECT *, xor(list_reduce(
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda c, b: list_reduce(range(8), lambda y, z: xor(y >> 1, (y & 1) * 3988292384), xor(c, b)), 4294967295),
    4294967295) % 9 AS h
  FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
prefixes AS (
  SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt),
nodes AS (
  SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends
  FROM prefixes GROUP BY ALL),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(n.path[-1].t) END AS saved
  FROM nodes n LEFT JOIN children c ON c.path = n.path),
above AS (SELECT path, unnest(range(depth + 1)) AS up, n_children, saved FROM full_nodes),
sums AS (
  SELECT path[1:up] AS path, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM above GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN sums s ON s.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chat": CHAT, "op7_quality": QUALITY, "op11_hard_negatives": HARD_NEGATIVES, "op13_prefix_trie": PREFIX_TRIE}
