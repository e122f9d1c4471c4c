"""DuckDB SQL equivalents of the registered queries."""

from __future__ import annotations

from checks import porter_sql, rich_sql
from checks.fixtures import LINK, MIN_DF_BODY, SAMPLE_TERMS, TITLE
from lodestone.functions.patterns import SIMPLE_TOKEN, TOKEN_CLASSES, spark_pattern
from lodestone.functions.words import STOPWORDS


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


STOP = ", ".join(text(w) for w in dict.fromkeys(STOPWORDS))
SIMPLE = text(spark_pattern(SIMPLE_TOKEN))

BODIES = "SELECT doc_id, text FROM documents"
FIRST_LINES = "SELECT doc_id, split_part(text, chr(10), 1) AS text FROM documents"
PAGE_TITLES = f"SELECT page_id AS doc_id, regexp_extract(html, {text(TITLE)}, 1) AS title FROM pages"
TITLE_TEXTS = f"SELECT doc_id, title AS text FROM ({PAGE_TITLES})"
QUERIES = "SELECT item_id AS query_id, text FROM benchmark"
LINK_QUERIES = f"SELECT doc_id AS query_id, title AS text FROM ({PAGE_TITLES})"

LINKS = f"""
SELECT CAST(page_id AS VARCHAR) AS id,
       unnest(regexp_extract_all(html, {text(LINK)}, 1)) AS target,
       unnest(regexp_extract_all(html, {text(LINK)}, 2)) AS text
FROM pages"""
BY_TARGET = f"SELECT target AS doc_id, text FROM (SELECT DISTINCT id, target, text FROM ({LINKS}))"
BY_SOURCE = f"SELECT DISTINCT id AS doc_id, text FROM ({LINKS})"
CORPUS_TITLES = f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, title FROM ({PAGE_TITLES})"

VIEWS = """
SELECT user_id AS id, CAST(sum(event_id % 7 + 1) AS BIGINT) AS views
FROM events WHERE event_type = 'view' GROUP BY user_id"""


def tokens(source: str, key: str = "doc_id") -> str:
    return f"""
SELECT {key}, list_filter(regexp_extract_all(lower(text), {SIMPLE}), lambda t: t NOT IN ({STOP})) AS toks
FROM ({source})"""


def stems(*sources: tuple[str, str]) -> str:
    """CTE stem_of(term, stem) for the words of the sources."""
    words = " UNION ".join(f"SELECT DISTINCT unnest(toks) AS term FROM ({tokens(s, key)})" for s, key in sources)
    return porter_sql.stem_ctes(words)


def rich_words(name: str, source: str, key: str = "doc_id") -> str:
    """CTE {name}: key, start, term of the rich tokenizer, without stop words."""
    return f"""{rich_sql.matches(f"{name}_rich", source, key, list(rich_sql.CLASSES))},
{name} AS MATERIALIZED (SELECT {key}, start, tok AS term FROM {name}_rich WHERE tok NOT IN ({STOP}))"""


def index(p: str, source: str, min_df: int = 0, stemmed: bool = False, rich: str | None = None) -> str:
    """CTEs {p}_tf, {p}_len, {p}_terms, {p}_meta, {p}_norm. ``rich`` is the CTE of the words if they are at hand."""
    words = f"SELECT doc_id, unnest(toks) AS term FROM ({tokens(source)})"
    if rich:
        words = f"SELECT doc_id, term FROM {rich}"
    if stemmed:
        words = f"SELECT doc_id, stem AS term FROM ({words}) JOIN stem_of USING (term)"
    return f"""
{p}_tf AS (SELECT doc_id, term, count(*) AS tf FROM ({words}) GROUP BY doc_id, term),
{p}_len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS doc_len FROM {p}_tf GROUP BY doc_id),
{p}_terms AS (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS term_total FROM {p}_tf
  GROUP BY term HAVING count(*) > {min_df}),
{p}_meta AS (SELECT count(*) AS n_docs, avg(doc_len) AS avg_len FROM {p}_len),
{p}_norm AS (
  SELECT l.doc_id, l.doc_len, coalesce(n.norm, 0) AS norm
  FROM {p}_len l LEFT JOIN (
    SELECT t.doc_id, sqrt(sum(power(t.tf / d.doc_len * log10(m.n_docs / w.df), 2))) AS norm
    FROM {p}_tf t JOIN {p}_len d USING (doc_id) JOIN {p}_terms w USING (term), {p}_meta m
    GROUP BY t.doc_id) n USING (doc_id))"""


def asked(source: str = QUERIES, stemmed: bool = False) -> str:
    """CTE q: query_id, term, q_tf, q_len."""
    words = "SELECT query_id, len(toks) AS q_len, unnest(toks) AS term FROM q_toks"
    if stemmed:
        words = f"SELECT query_id, q_len, stem AS term FROM ({words}) JOIN stem_of USING (term)"
    return f"""
q_toks AS ({tokens(source, "query_id")}),
q AS (
  SELECT query_id, term, count(*) AS q_tf, any_value(q_len) AS q_len FROM ({words}) GROUP BY query_id, term)"""


def bm25(p: str, lengths: str | None = None, doc_len: str = "l.doc_len", q: str = "q") -> str:
    """CTE {p}_bm25: query_id, doc_id, score, first_term."""
    lengths = lengths or f"{p}_len"
    return f"""
{p}_avg AS (SELECT count(*) AS n_docs, avg(doc_len) AS avg_len FROM {lengths}),
{p}_bm25 AS (
  SELECT q.query_id, t.doc_id, min(term) AS first_term,
         sum(ln(1 + (m.n_docs - w.df + 0.5) / (w.df + 0.5)) * t.tf * 2.5
             / (t.tf + 1.5 * (1 - 0.75 + 0.75 * {doc_len} / m.avg_len))) AS score
  FROM {q} q JOIN {p}_terms w USING (term) JOIN {p}_tf t USING (term) JOIN {lengths} l USING (doc_id), {p}_avg m
  GROUP BY q.query_id, t.doc_id)"""


def vector(p: str) -> str:
    return f"""
{p}_vec AS (
  SELECT query_id, term, w.df, q_tf / q_len * log10(m.n_docs / (w.df + 1e-7)) AS q_weight
  FROM q JOIN {p}_terms w USING (term), {p}_meta m)"""


def cosine(p: str) -> str:
    return f"""
{vector(p)},
{p}_cos AS (
  SELECT query_id, doc_id, first_term, coalesce(dot / nullif(q_norm * norm, 0), 0) AS score
  FROM (
    SELECT v.query_id, t.doc_id, min(term) AS first_term,
           sum(t.tf / n.doc_len * log10(m.n_docs / v.df) * v.q_weight) AS dot, any_value(n.norm) AS norm
    FROM {p}_vec v JOIN {p}_tf t USING (term) JOIN {p}_norm n USING (doc_id), {p}_meta m
    GROUP BY v.query_id, t.doc_id)
  JOIN (SELECT query_id, sqrt(sum(q_weight * q_weight)) AS q_norm FROM {p}_vec GROUP BY query_id)
  USING (query_id))"""


def counts(p: str) -> str:
    return f"""
{p}_count AS (
  SELECT query_id, doc_id, count(*) AS score, min(term) AS first_term
  FROM q JOIN {p}_tf USING (term) GROUP BY query_id, doc_id)"""


def ranked(source: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order}) AS rank FROM {source}"


def best(name: str, source: str, k: int) -> str:
    rounded = f"(SELECT query_id, doc_id, round(score, 5) AS score, first_term FROM {source})"
    return f"""
{name} AS (
  SELECT query_id, doc_id, score, rank
  FROM ({ranked(rounded, "score DESC, first_term, doc_id")}) WHERE rank <= {k})"""


def scaled(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT query_id, doc_id, coalesce((score - low) / nullif(high - low, 0), 0) AS score
  FROM (SELECT *, min(score) OVER (PARTITION BY query_id) AS low, max(score) OVER (PARTITION BY query_id) AS high
        FROM {source}))"""


def merged(name: str, k: int) -> str:
    """Of title_best and body_best."""
    both = """(
    SELECT query_id, doc_id, sum(score) AS score
    FROM (SELECT query_id, doc_id, score * 0.1 AS score FROM title_best
          UNION ALL SELECT query_id, doc_id, score * 0.9 FROM body_best)
    GROUP BY query_id, doc_id)"""
    return f"""
{name} AS (SELECT query_id, rank, doc_id, score FROM ({ranked(both, "score DESC, doc_id")}) WHERE rank <= {k})"""


def part_ranks(iterations: int = 6) -> str:
    steps = "".join(
        f"""
pr{i} AS (
  SELECT v.id, CAST(0.15 + 0.85 * coalesce(sum(r.rank / d.degree), 0) AS DOUBLE) AS rank
  FROM nodes v LEFT JOIN edges e ON e.dst = v.id LEFT JOIN pr{i - 1} r ON r.id = e.src
       LEFT JOIN degrees d ON d.src = e.src
  GROUP BY v.id),"""
        for i in range(1, iterations + 1)
    )
    return f"""
edges AS (
  SELECT DISTINCT src, dst FROM (
    SELECT l_partkey AS src,
           lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS dst
    FROM lineitem)
  WHERE dst IS NOT NULL),
nodes AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges),
degrees AS (SELECT src, count(*) AS degree FROM edges GROUP BY src),
pr0 AS (SELECT id, CAST(1 AS DOUBLE) AS rank FROM nodes),{steps}
part_rank AS (
  SELECT id, round(rank * (SELECT count(*) / sum(rank) FROM pr{iterations}), 5) AS pagerank FROM pr{iterations})"""


def patterns() -> str:
    """RE2 has no lookaround and an ASCII \\b, so word characters are spelled out where they matter."""
    word = r"[\p{L}\p{N}_]"
    # One pattern per class.
    classes = {
        "website": rf"(?:www\.)?{word}+\.com\b",
        "slash_date": TOKEN_CLASSES["slash_date"],
        "date": TOKEN_CLASSES["date"],
        "time": TOKEN_CLASSES["time"],
        "html": "<(?:“[^”]*”|'[^’]*’|[^'”>])*>",
    }
    return " UNION ALL ".join(
        f"SELECT kind, id, {text(name)} AS token_class, unnest(regexp_extract_all(text, {text(pattern)})) AS value "
        "FROM texts"
        for name, pattern in classes.items()
    )


PATTERN_TEXTS = """
SELECT 'document' AS kind, doc_id AS id, text FROM documents
UNION ALL SELECT 'page', page_id, html FROM pages
UNION ALL SELECT 'order', o_orderkey,
  strftime(o_orderdate, '%B %-d, %Y') || ' ; ' || strftime(o_orderdate, '%-d %b %Y') || ' ; '
  || strftime(o_orderdate, '%d/%m/%Y') || ' ; ' || strftime(make_timestamp(o_orderkey * 61000000), '%H:%M:%S')
FROM orders"""


def oracle_sql() -> dict[str, str]:
    body = index("body", BODIES, MIN_DF_BODY)
    body_all = index("body", BODIES)
    title = index("title", FIRST_LINES)
    page = index("page", TITLE_TEXTS)
    q = asked()
    scores = "SELECT query_id, doc_id, round(score, 5) AS score FROM "
    both = f"""WITH {title}, {body}, {q}, {bm25("title")}, {bm25("body")},
{best("title_best", "title_bm25", 100)}, {best("body_best", "body_bm25", 100)}"""
    both10 = f"""{title}, {body}, {q}, {bm25("title")}, {bm25("body")},
{best("title_best", "title_bm25", 10)}, {best("body_best", "body_bm25", 10)}"""

    def search(ctes: str) -> str:
        return f"""WITH {ctes}, {merged("m", 10)}, {part_ranks()},
priors AS (
  SELECT m.query_id, m.rank AS prev_rank, m.doc_id, m.score AS text_score,
         coalesce(p.pagerank, 0) AS pagerank, coalesce(v.views, 0) AS views
  FROM m LEFT JOIN part_rank p ON p.id = m.doc_id LEFT JOIN ({VIEWS}) v ON v.id = m.doc_id),
{scaled("s1", "(SELECT query_id, doc_id, text_score AS score FROM priors)")},
{scaled("s2", "(SELECT query_id, doc_id, pagerank AS score FROM priors)")},
{scaled("s3", "(SELECT query_id, doc_id, views AS score FROM priors)")},
blended AS (
  SELECT query_id, doc_id, prev_rank, s1.score * 0.6 + s2.score * 0.2 + s3.score * 0.2 AS score
  FROM priors JOIN s1 USING (query_id, doc_id) JOIN s2 USING (query_id, doc_id) JOIN s3 USING (query_id, doc_id))
SELECT r.query_id, r.rank, r.doc_id, round(r.score, 5) AS score, t.text AS title
FROM ({ranked("blended", "score DESC, prev_rank, doc_id")}) r LEFT JOIN ({FIRST_LINES}) t USING (doc_id)"""

    def matches(docs: str, queries: str, titles: str) -> str:
        return f"""WITH {index("m", docs)}, {asked(queries)}, {counts("m")}
SELECT r.query_id, r.rank, r.doc_id, r.score, t.title
FROM ({ranked("m_count", "score DESC, first_term, doc_id")}) r LEFT JOIN ({titles}) t USING (doc_id)"""

    search_body = f"""WITH {body}, {q}, {cosine("body")}, {best("b", "body_cos", 40)}
SELECT b.query_id, b.rank, b.doc_id, b.score, t.text AS title
FROM b LEFT JOIN ({FIRST_LINES}) t USING (doc_id)"""
    hard = ["number", "percent", "abbreviation", "word"]
    every_class = ", ".join(
        rich_sql.matches(f"c_{c}", "SELECT kind, id, text FROM texts", "kind, id", [c], lower=False) for c in hard
    )
    every_row = " ".join(f"UNION ALL SELECT kind, id, {text(c)}, tok FROM c_{c}" for c in hard)
    simple_words = " UNION ".join(
        f"SELECT DISTINCT unnest(toks) AS term FROM ({tokens(s, key)})"
        for s, key in ((BODIES, "doc_id"), (QUERIES, "query_id"))
    )
    rich_titles = f"""RECURSIVE {rich_words("tw", FIRST_LINES)}, {rich_words("qw", QUERIES, "query_id")},
{porter_sql.stem_ctes(f"{simple_words} UNION SELECT DISTINCT term FROM tw UNION SELECT DISTINCT term FROM qw")},
{index("title", FIRST_LINES, stemmed=True, rich="tw")}, {index("body", BODIES, MIN_DF_BODY, stemmed=True)},
{asked(stemmed=True)}, qr AS (SELECT DISTINCT query_id, stem AS term FROM qw JOIN stem_of USING (term)),
{bm25("title", q="qr")}, {bm25("body")},
{best("title_best", "title_bm25", 10)}, {best("body_best", "body_bm25", 10)}"""
    half = "SELECT query_id, CASE WHEN query_id % 2 = 0 THEN text END AS text"
    return {
        "tokenize_simple": f"""
SELECT doc_id, unnest(toks) AS term, unnest(range(len(toks))) AS pos FROM ({tokens(BODIES)})""",
        "tokenize_simple_stem": f"""WITH {stems((BODIES, "doc_id"))}
SELECT doc_id, stem AS term, pos
FROM (SELECT doc_id, unnest(toks) AS term, unnest(range(len(toks))) AS pos FROM ({tokens(BODIES)}))
JOIN stem_of USING (term)""",
        "stem_terms": f"WITH {stems((BODIES, 'doc_id'))} SELECT term, stem FROM stem_of",
        "pattern_classes": f"""WITH texts AS ({PATTERN_TEXTS})
SELECT kind, id, token_class, value, count(*) AS n FROM ({patterns()}) GROUP BY ALL""",
        "tokenize_rich_stem": f"""WITH RECURSIVE {rich_words("rw", BODIES)},
{porter_sql.stem_ctes("SELECT DISTINCT term FROM rw")}
SELECT doc_id, stem AS term, row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS pos
FROM rw JOIN stem_of USING (term)""",
        "pattern_classes_all": f"""WITH RECURSIVE texts AS ({PATTERN_TEXTS}), {every_class}
SELECT kind, id, token_class, value, count(*) AS n FROM ({patterns()} {every_row}) GROUP BY ALL""",
        "search_rich_titles": search(rich_titles),
        "term_freq": f"WITH {body_all} SELECT doc_id, term, tf FROM body_tf",
        "doc_freq": f"WITH {body_all} SELECT term, df FROM body_terms",
        "term_total": f"WITH {body_all} SELECT term, term_total FROM body_terms",
        "min_df_vocab": f"WITH {body} SELECT term, df, term_total FROM body_terms",
        "doc_len": f"WITH {body_all} SELECT doc_id, doc_len FROM body_len",
        "combined_doc_len": f"""WITH {body_all}, {title}
SELECT doc_id, CAST(sum(doc_len) AS BIGINT) AS doc_len
FROM (SELECT * FROM body_len UNION ALL SELECT * FROM title_len) GROUP BY doc_id""",
        "index_stats": f"WITH {body_all} SELECT n_docs, round(avg_len, 5) AS avg_len FROM body_meta",
        "doc_norm": f"WITH {body} SELECT doc_id, doc_len, round(norm, 5) AS norm FROM body_norm",
        "posting_lists": f"""WITH {body}
SELECT term, doc_id // 65536 AS block, count(*) AS n,
       string_agg(doc_id || ':' || tf, ',' ORDER BY doc_id) AS postings
FROM body_tf JOIN body_terms USING (term) GROUP BY ALL""",
        "posting_lookup": f"""WITH {body_all}
SELECT term, doc_id, tf FROM body_tf WHERE term IN ({", ".join(text(t) for t in SAMPLE_TERMS)})""",
        "index_append": f"""WITH {body}
SELECT t.term, t.doc_id, t.tf, n.doc_len, w.df, w.term_total, round(n.norm, 5) AS norm
FROM body_tf t JOIN body_terms w USING (term) JOIN body_norm n USING (doc_id)""",
        "index_rebuild": f"""WITH {body}
SELECT t.term, t.doc_id, t.tf, n.doc_len, w.df, w.term_total, round(n.norm, 5) AS norm
FROM body_tf t JOIN body_terms w USING (term) JOIN body_norm n USING (doc_id)""",
        "anchor_append": f"""WITH {index("a", BY_TARGET)}
SELECT term, doc_id, tf, doc_len FROM a_tf JOIN a_len USING (doc_id)""",
        "index_compact": f"""WITH {index("a", BY_TARGET)}
SELECT term, doc_id, tf, doc_len FROM a_tf JOIN a_len USING (doc_id)""",
        "anchor_fragments": BY_TARGET,
        "anchor_docs": f"SELECT doc_id, string_agg(text, ' ' ORDER BY text) AS text FROM ({BY_SOURCE}) GROUP BY doc_id",
        "field_docs": f"""
SELECT 'body' AS field, CAST(page_id AS VARCHAR) AS doc_id, html AS text FROM pages
UNION ALL SELECT 'title', CAST(doc_id AS VARCHAR), title FROM ({PAGE_TITLES})
UNION ALL SELECT 'anchor', doc_id, text FROM ({BY_TARGET})""",
        "titles": CORPUS_TITLES,
        "anchor_terms": f"""WITH {index("a", BY_TARGET)}
SELECT term, doc_id, tf, doc_len FROM a_tf JOIN a_len USING (doc_id)""",
        "query_terms": f"WITH {q} SELECT query_id, term, q_tf, q_len FROM q",
        "bm25_idf": f"""WITH {body}
SELECT term, round(ln(1 + (n_docs - df + 0.5) / (df + 0.5)), 5) AS idf FROM body_terms, body_meta""",
        "bm25_body": f"WITH {body}, {q}, {bm25('body')} {scores} body_bm25",
        "bm25_title": f"WITH {title}, {q}, {bm25('title')} {scores} title_bm25",
        "bm25_salted": f"WITH {body}, {q}, {bm25('body')} {scores} body_bm25",
        "bm25_blockmax": f"""WITH {body}, {q}, {bm25("body")}, {best("b", "body_bm25", 10)}
SELECT query_id, rank, doc_id, score FROM b""",
        "bm25_zero_length": f"WITH {body}, {q}, {bm25('body', doc_len='0')} {scores} body_bm25",
        "bm25_combined_length": f"""WITH {body}, {title}, {q},
both_len AS (
  SELECT doc_id, sum(doc_len) AS doc_len FROM (SELECT * FROM body_len UNION ALL SELECT * FROM title_len)
  GROUP BY doc_id),
{bm25("title", "both_len")} {scores} title_bm25""",
        "bm25_stemmed": f"""WITH {stems((BODIES, "doc_id"), (QUERIES, "query_id"))},
{index("body", BODIES, MIN_DF_BODY, stemmed=True)}, {asked(stemmed=True)}, {bm25("body")} {scores} body_bm25""",
        "tfidf_query_vector": f"""WITH {body}, {q}, {vector("body")}
SELECT query_id, term, df, round(q_weight, 5) AS q_weight FROM body_vec""",
        "tfidf_cosine": f"WITH {body}, {q}, {cosine('body')} {scores} body_cos",
        "search_body": search_body,
        "search_body_stored": search_body,
        "search_title_stored": matches(TITLE_TEXTS, QUERIES, PAGE_TITLES),
        "search_anchor_stored": matches(BY_TARGET, LINK_QUERIES, CORPUS_TITLES),
        "search_stored": search(both10),
        "search_empty_queries": matches(TITLE_TEXTS, f"{half} FROM ({QUERIES})", PAGE_TITLES),
        "search_title": matches(TITLE_TEXTS, QUERIES, PAGE_TITLES),
        "search_title_normalized": f"""WITH {page}, {q}, {counts("page")},
n_known AS (SELECT query_id, sqrt(count(*)) AS q_norm FROM q JOIN page_terms USING (term) GROUP BY query_id),
scored AS (
  SELECT query_id, doc_id, first_term, round(coalesce(score / nullif(q_norm * norm, 0), 0), 5) AS score
  FROM page_count JOIN n_known USING (query_id) JOIN page_norm USING (doc_id))
SELECT r.query_id, r.rank, r.doc_id, r.score, t.title
FROM ({ranked("scored", "score DESC, first_term, doc_id")}) r LEFT JOIN ({PAGE_TITLES}) t USING (doc_id)""",
        "search_anchor": matches(BY_TARGET, LINK_QUERIES, CORPUS_TITLES),
        "search_anchor_source": matches(BY_SOURCE, LINK_QUERIES, CORPUS_TITLES),
        "merge_results": f"""{both}, {merged("m", 100)}
SELECT query_id, rank, doc_id, round(score, 7) AS score FROM m""",
        "min_max": f"""WITH {body}, {q}, {bm25("body")},
s AS ({scores} body_bm25), {scaled("scaled", "s")}
SELECT query_id, doc_id, s.score, round(scaled.score, 5) AS scaled FROM s JOIN scaled USING (query_id, doc_id)""",
        "blend": f"""{both},
views AS (
  SELECT b.query_id, b.doc_id, v.views AS score FROM body_best b JOIN ({VIEWS}) v ON v.id = b.doc_id),
{scaled("body_s", "body_best")}, {scaled("title_s", "title_best")}, {scaled("views_s", "views")}
SELECT query_id, doc_id, round(sum(score), 5) AS score
FROM (SELECT query_id, doc_id, score * 0.6 AS score FROM body_s
      UNION ALL SELECT query_id, doc_id, score * 0.2 FROM title_s
      UNION ALL SELECT query_id, doc_id, score * 0.2 FROM views_s)
GROUP BY query_id, doc_id""",
        "search": search(both10),
        "search_stemmed": search(
            f"""{stems((BODIES, "doc_id"), (QUERIES, "query_id"))}, {index("title", FIRST_LINES, stemmed=True)},
{index("body", BODIES, MIN_DF_BODY, stemmed=True)}, {asked(stemmed=True)}, {bm25("title")}, {bm25("body")},
{best("title_best", "title_bm25", 10)}, {best("body_best", "body_bm25", 10)}"""
        ),
        "link_edges": f"SELECT DISTINCT id AS src, target AS dst FROM ({LINKS})",
        "link_vertices": f"SELECT CAST(page_id AS VARCHAR) AS id FROM pages UNION SELECT target FROM ({LINKS})",
        "pagerank": f"WITH {part_ranks()} SELECT id, pagerank FROM part_rank",
        "page_views": VIEWS,
        "lookup_pagerank": f"""WITH {part_ranks()},
asked AS (
  SELECT p_partkey AS request_id, unnest([p_partkey, -p_partkey, p_partkey % 100, p_partkey]) AS id,
         unnest(range(4)) AS pos
  FROM part)
SELECT request_id, pos, id, coalesce(pagerank, 0) AS pagerank FROM asked LEFT JOIN part_rank USING (id)""",
        "lookup_pageview": f"""WITH asked AS (
  SELECT doc_id AS request_id, unnest([doc_id, doc_id % 200, doc_id + 1, doc_id]) AS id, unnest(range(4)) AS pos
  FROM documents)
SELECT request_id, pos, id, coalesce(views, 0) AS views FROM asked LEFT JOIN ({VIEWS}) USING (id)""",
        "lookup_empty_lists": f"""WITH asked AS (
  SELECT doc_id AS request_id, unnest([doc_id, doc_id + 1]) AS id, unnest(range(2)) AS pos
  FROM documents WHERE doc_id % 2 = 0)
SELECT request_id, pos, id, coalesce(views, 0) AS views FROM asked LEFT JOIN ({VIEWS}) USING (id)""",
        "corpus_scan": f"""
SELECT page_id AS id, title, length(html) AS n_chars, len(regexp_extract_all(html, {text(LINK)}, 1)) AS n_links
FROM pages JOIN ({PAGE_TITLES}) ON doc_id = page_id WHERE page_id % 10 NOT IN (3, 4)""",
        "corpus_rejects": """
SELECT CASE page_id % 10 WHEN 3 THEN 'no id' ELSE 'no content' END AS reason, count(*) AS n
FROM pages WHERE page_id % 10 IN (3, 4) GROUP BY ALL""",
        "page_views_bz2": VIEWS,
        "page_view_rejects": """
SELECT 'no id' AS reason, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click') HAVING count(*) > 0""",
        "side_tables": f"""WITH {part_ranks()}
SELECT coalesce(t.doc_id, p.id) AS doc_id, t.text AS title, p.pagerank
FROM ({FIRST_LINES}) t FULL JOIN part_rank p ON p.id = t.doc_id""",
    }
