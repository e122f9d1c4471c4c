"""Link graph and PageRank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import stage, stage_bucketed


def link_graph(pages: DataFrame, staged: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(id, anchor_text)`` -> edges ``(src, dst)`` and vertices ``(id)``, both without duplicates.

    Self-links stay. Pages without links and link targets without a page are vertices too. Repeats within a
    page are dropped in its row, before anything is shuffled. ``staged`` writes the edges to the scratch folder,
    as both results and :func:`pagerank` read them.
    """
    edges = stage(link_edges(pages), "edges") if staged else link_edges(pages)
    vertices = pages.select("id").unionByName(edges.select(F.col("dst").alias("id"))).distinct()
    return edges, vertices


def link_edges(pages: DataFrame) -> DataFrame:
    targets = F.array_distinct(F.transform("anchor_text", lambda a: a["id"]))
    return pages.select(F.col("id").alias("src"), F.explode(targets).alias("dst")).distinct()


def pagerank(
    vertices: DataFrame,
    edges: DataFrame,
    reset: float = 0.15,
    iterations: int = 6,
    fan_out: int = 100_000,
    cut_every: int = 3,
) -> DataFrame:
    """``(id, pagerank)`` after a fixed number of iterations.

    All ranks start at 1; a step is ``reset + (1 - reset) * sum(rank(u) / out_degree(u))`` over the in-links.
    Rank held by pages without out-links is not handed on; at the end ranks are scaled to sum to the number of
    vertices.

    Edges and nodes are laid out once, edges by source and part: a source with more than ``fan_out`` links is
    split into parts that each fit a task, and a step sends a copy of its rank to each part. Contributions are
    added up before they are shuffled, so a very popular target is no hot spot. A step shuffles the ranks and
    the contributions, never the edges. Every ``cut_every`` steps the ranks are written and read back, which
    bounds what a lost executor costs.
    """
    degrees = edges.groupBy("src").agg(F.count("*").alias("degree"))
    nodes = stage_bucketed(
        vertices.select("id")
        .join(degrees.withColumnRenamed("src", "id"), "id", "left")
        .select(
            "id",
            F.coalesce("degree", F.lit(0)).alias("degree"),
            F.coalesce(F.ceil(F.col("degree") / fan_out), F.lit(0)).alias("parts"),
        ),
        "id",
    )
    wide = nodes.where(F.col("parts") > 1).select(F.col("id").alias("src"), "parts")
    part = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("parts")), F.lit(0).cast("long"))
    links = stage_bucketed(
        edges.join(wide, "src", "left").select("src", "dst", part.alias("part")), "src", "part"
    )

    ranks = nodes.withColumn("rank", F.lit(1.0))
    for step in range(1, iterations + 1):
        shares = ranks.where(F.col("degree") > 0).select(
            F.col("id").alias("src"),
            (F.col("rank") / F.col("degree")).alias("share"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        )
        received = (
            links.join(shares, ["src", "part"]).groupBy(F.col("dst").alias("id")).agg(F.sum("share").alias("got"))
        )
        got = F.coalesce("got", F.lit(0.0))
        ranks = nodes.join(received, "id", "left").select(
            "id", "degree", "parts", (F.lit(reset) + F.lit(1 - reset) * got).alias("rank")
        )
        if step % cut_every == 0 or step == iterations:
            ranks = stage(ranks, "ranks")
    scale = ranks.agg(F.count("*") / F.sum("rank")).scalar()
    return ranks.select("id", (F.col("rank") * scale).alias("pagerank"))
