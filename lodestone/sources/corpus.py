"""The article corpus and its field documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORPUS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField(
            "anchor_text",
            T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])),
        ),
    ]
)


def read_corpus(spark: SparkSession, *paths: str, schema: T.StructType | None = CORPUS_SCHEMA) -> DataFrame:
    """Parquet files and folders; in a folder, files with ``.parquet`` in their name. The schema is declared,
    so no file is opened to infer it; None infers it and checks the columns."""
    reader = spark.read.option("pathGlobFilter", "*.parquet*")
    corpus = (reader.schema(schema) if schema else reader).parquet(*paths)
    missing = {"id", "title", "text", "anchor_text"} - set(corpus.columns)
    if missing:
        raise ValueError(f"corpus lacks columns: {sorted(missing)}")
    return corpus


def split_rejects(corpus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The usable rows, and the others with a ``reason``: rows without an id, and rows with neither title nor text."""
    empty = F.col("title").isNull() & F.col("text").isNull()
    reason = F.when(F.col("id").isNull(), "no id").when(empty, "no content")
    return corpus.where(reason.isNull()), corpus.withColumn("reason", reason).where(F.col("reason").isNotNull())


def spread(docs: DataFrame, key: str) -> DataFrame:
    """Hash the rows of a scan over the cores when its files have fewer splits than there are cores (a few large
    row groups); a scan with enough splits is left as it is and not shuffled."""
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(cores, key) if docs.rdd.getNumPartitions() < cores else docs


def titles(corpus: DataFrame) -> DataFrame:
    return corpus.select(F.col("id").alias("doc_id"), "title")


def body_docs(corpus: DataFrame) -> DataFrame:
    return corpus.select(F.col("id").alias("doc_id"), "text")


def title_docs(corpus: DataFrame) -> DataFrame:
    return corpus.select(F.col("id").alias("doc_id"), F.col("title").alias("text"))


def anchor_fragments(corpus: DataFrame, by: str = "target") -> DataFrame:
    """Anchor texts as ``(doc_id, text)`` rows, one per distinct text of a page (and target).

    ``target`` gives a page the texts of links that point to it, ``source`` the texts of links it contains.
    Rows of one document are left apart: a popular target has more text than a row should hold, and an
    index built with ``fragments`` counts them where they are.
    """
    if by == "target":
        return corpus.select(F.inline(F.array_distinct("anchor_text"))).toDF("doc_id", "text")
    if by == "source":
        return corpus.select(F.col("id").alias("doc_id"), F.explode(_own_anchors()).alias("text"))
    raise ValueError("by is 'target' or 'source'")


def anchor_docs(corpus: DataFrame) -> DataFrame:
    """A page's own distinct anchor texts, sorted and joined by spaces: ``(doc_id, text)``. Pages without
    links are left out."""
    return corpus.where(F.size("anchor_text") > 0).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_sort(_own_anchors())).alias("text")
    )


def _own_anchors():
    return F.array_distinct(F.transform("anchor_text", lambda a: a["text"]))


def field_docs(corpus: DataFrame, anchors_by: str = "target") -> DataFrame:
    """All fields in one frame: ``(field, doc_id, text)``."""
    parts = {
        "body": body_docs(corpus),
        "title": title_docs(corpus),
        "anchor": anchor_fragments(corpus, anchors_by),
    }
    tagged = [docs.select(F.lit(field).alias("field"), "doc_id", "text") for field, docs in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
