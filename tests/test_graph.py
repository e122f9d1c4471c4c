import pytest
from pyspark.sql import functions as F

from lodestone.operators.graph import link_graph, pagerank

# Ranks after 6 steps on a graph with a sink (5), a self-loop (4) and a page without in-links (6).
EDGES = [(1, 2), (1, 3), (2, 3), (3, 1), (4, 4), (4, 1), (1, 5), (6, 5)]
RANKS = {1: 1.8195048020, 2: 0.8208805257, 3: 1.5594674501, 4: 0.4785593548, 5: 1.0509352502, 6: 0.2706526172}


@pytest.mark.parametrize("options", [{}, {"fan_out": 1, "cut_every": 2}])
def test_pagerank(spark, options):
    edges = spark.createDataFrame(EDGES, "src long, dst long")
    vertices = spark.range(1, 7)
    got = {r.id: r.pagerank for r in pagerank(vertices, edges, **options).collect()}
    assert got == pytest.approx(RANKS, abs=1e-9)
    assert sum(got.values()) == pytest.approx(6)


def test_pagerank_of_a_hub(spark):
    """One page links to all others and is linked from all: a third of the links and more start or end there."""
    n = 300
    out = spark.range(1, n).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    back = out.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    rank, spoke = 1.0, 1.0
    for _ in range(6):
        rank, spoke = 0.15 + 0.85 * spoke * (n - 1), 0.15 + 0.85 * rank / (n - 1)
    scale = n / (rank + spoke * (n - 1))
    got = {r.id: r.pagerank for r in pagerank(spark.range(n), out.union(back), fan_out=50).collect()}
    assert got[0] == pytest.approx(rank * scale) and got[7] == pytest.approx(spoke * scale)


def test_link_graph(corpus_rows):
    edges, vertices = link_graph(corpus_rows)
    assert sorted(tuple(r) for r in edges.collect()) == [(1, 2), (1, 3), (2, 2), (2, 3), (4, 9)]
    assert sorted(r.id for r in vertices.collect()) == [1, 2, 3, 4, 9]
