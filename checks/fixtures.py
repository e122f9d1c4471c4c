"""Maps the test tables onto the inputs of a search engine.

body      documents.text
title     first line of documents.text, or <title> of pages
anchors   <a href="target">text</a> of pages; a page's id is its page_id as a string, a target's its href
queries   benchmark
views     'view' events, written as page-view dump lines; the article id is user_id
links     part -> next part in the same order, for PageRank
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.operators.graph import pagerank
from lodestone.session import stage
from lodestone.sources.corpus import spread
from lodestone.sources.pageviews import page_views

LINK = '<a href="([^"]*)">([^<]*)</a>'
TITLE = "<title>([^<]*)</title>"
MIN_DF_BODY = 50
SAMPLE_TERMS = ["ention", "thble", "eronon", "leaux", "pation", "nosuchword"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spread(docs.select("doc_id", F.substring_index("text", "\n", 1).alias("text")), "doc_id")


def first_line_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_lines(spark, sf_dir).withColumnRenamed("text", "title")


def page_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages as ``(id, title, text, anchor_text)``."""
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    parts = [F.regexp_extract_all("html", F.lit(LINK), F.lit(i)) for i in (1, 2)]
    return pages.select(
        F.col("page_id").cast("string").alias("id"),
        F.regexp_extract("html", TITLE, 1).alias("title"),
        F.col("html").alias("text"),
        F.arrays_zip(parts[0].alias("id"), parts[1].alias("text")).alias("anchor_text"),
    )


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("doc_id"), F.regexp_extract("html", TITLE, 1).alias("title")
    )


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def part_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    in_order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    steps = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("src"), F.lead("l_partkey").over(in_order).alias("dst")
    )
    edges = stage(steps.where(F.col("dst").isNotNull()).distinct(), "part-edges")
    vertices = edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id"))).distinct()
    return vertices, edges


def part_pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagerank(*part_graph(spark, sf_dir))


def view_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of the project, views of another project (clicks) and lines without an id (the rest)."""
    kind = F.col("event_type")
    project = F.when(kind == "click", "de.wikipedia").otherwise("en.wikipedia")
    article = F.when(kind.isin("view", "click"), F.col("user_id").cast("string")).otherwise("null")
    views = (F.pmod("event_id", F.lit(7)) + 1).cast("string")
    line = F.concat_ws(" ", project, F.concat(F.lit("Article_"), "user_id"), article, F.lit("desktop"), views)
    return table(spark, sf_dir, "events").select(line.alias("value"))


def article_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_views(view_lines(spark, sf_dir))


def pattern_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw texts with the shapes the token classes look for: documents, pages, and order dates, prices and
    ship times spelled out. ``(kind, id, text)``."""
    docs = bodies(spark, sf_dir).select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    pages = spread(table(spark, sf_dir, "pages"), "page_id").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text")
    )
    day = F.col("o_orderdate")
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey").select(
        F.lit("order").alias("kind"),
        F.col("o_orderkey").alias("id"),
        F.concat_ws(
            " ; ",
            F.date_format(day, "MMMM d, yyyy"),
            F.date_format(day, "d MMM yyyy"),
            F.date_format(day, "dd/MM/yyyy"),
            F.date_format(F.timestamp_seconds(F.col("o_orderkey") * 61), "HH:mm:ss"),
        ).alias("text"),
    )
    return docs.unionByName(pages).unionByName(orders)
