"""Times index building, ranking, PageRank and the endpoints; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all cores) choose data and parallelism.
Indexes are built once, into a scratch folder, and then queried from there, as they would be in use. Every
timing includes computing all result rows; ``value`` is their sum.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks import fixtures as fx
from checks import queries as registered
from lodestone.operators import blockmax, rank, termstats
from lodestone.operators.graph import pagerank
from lodestone.plans import search as plans
from lodestone.session import scratch_dir, spark_session, stage
from lodestone.sources import corpus
from lodestone.sources.index_store import append_docs, compact_index, lookup_postings, write_index


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = spark_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, work, compute=True):
        start = time.time()
        out = work()
        if compute:
            out.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name:24}{times[name]:8.2f} s", file=sys.stderr, flush=True)
        return out

    root = f"{scratch_dir(spark)}/bench-{os.getpid()}-{int(time.time())}"
    docs, lines = fx.bodies(spark, sf_dir), fx.first_lines(spark, sf_dir)
    pages = stage(fx.page_corpus(spark, sf_dir), "bench-pages")
    questions = fx.benchmark_queries(spark, sf_dir)
    titles = stage(fx.first_line_titles(spark, sf_dir), "bench-titles")
    page_titles = corpus.titles(pages)
    docs.limit(100).count()  # start the session's executors and Python workers before the clock runs

    timed("term_counts", lambda: termstats.doc_terms(docs, "simple"))
    timed("term_counts_stemmed", lambda: termstats.doc_terms(docs, "simple_stem"))
    timed("term_counts_rich", lambda: termstats.doc_terms(docs, "rich_stem"))

    def build(name, source, analyzer, **options):
        return timed(f"index_{name}", lambda: write_index(source, f"{root}/{name}", analyzer, **options), False)

    body = build("body", docs, "simple", min_df=fx.MIN_DF_BODY, norms=True)
    stemmed = build("body_stemmed", docs, "simple_stem", min_df=fx.MIN_DF_BODY)
    title = build("title", lines, "simple", norms=True)
    title_rich = build("title_stemmed", lines, "rich_stem")
    anchors = build("anchor", corpus.anchor_fragments(pages), "simple", fragments=True)
    write_index(docs.where("doc_id % 10 > 0"), f"{root}/grown", "simple", fx.MIN_DF_BODY)
    timed("index_append", lambda: append_docs(docs.where("doc_id % 10 = 0"), f"{root}/grown"), False)

    timed("index_compact", lambda: compact_index(spark, f"{root}/grown"), False)

    timed("posting_lookup", lambda: lookup_postings(body, fx.SAMPLE_TERMS))
    timed("bm25_body", lambda: rank.bm25(body, questions))
    timed("bm25_body_top100", lambda: rank.top_k(rank.bm25(body, questions), 100, 5))
    timed("bm25_blockmax_top10", lambda: blockmax.bm25_top_k(body, questions, 10, 5))
    timed("search_body", lambda: plans.search_body(body, questions, titles))
    timed("search_title", lambda: plans.search_title(title, questions, titles))
    timed("search_anchor", lambda: plans.search_anchor(anchors, registered._link_queries(spark, sf_dir), page_titles))

    views = timed("page_views", lambda: stage(fx.article_views(spark, sf_dir), "bench-views"), False)
    vertices, edges = fx.part_graph(spark, sf_dir)
    ranks = timed("pagerank", lambda: stage(pagerank(vertices, edges), "bench-ranks"), False)
    timed(
        "search",
        lambda: plans.search({"body": stemmed, "title": title_rich}, questions, ranks, views, titles, k=100),
    )
    timed("get_pagerank", lambda: plans.get_pagerank(_ids(spark, sf_dir), ranks))
    timed("get_pageview", lambda: plans.get_pageview(_ids(spark, sf_dir), views))

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


def _ids(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part")
    return part.selectExpr("p_partkey AS request_id", "array(p_partkey, -p_partkey, p_partkey) AS ids")


if __name__ == "__main__":
    main()
