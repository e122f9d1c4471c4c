import pytest
from pyspark.sql import functions as F

from lodestone.operators.fuse import blend, merge_results, min_max

SCHEMA = "query_id long, doc_id long, score double"


def test_merge(spark):
    a = spark.createDataFrame([(1, 1, 10.0), (1, 2, 4.0), (2, 1, 1.0)], SCHEMA)
    b = spark.createDataFrame([(1, 2, 9.0), (1, 3, 2.0)], SCHEMA)
    out = merge_results([a, b], [0.5, 1.0], k=2).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in out] == [(1, 1, 2, 11.0), (1, 2, 1, 5.0), (2, 1, 1, 0.5)]
    with pytest.raises(ValueError):
        merge_results([a, b], [1.0])


@pytest.mark.parametrize("cut", [True, False])
def test_min_max(spark, cut):
    rows = [(1, 1, 2.0), (1, 2, 4.0), (1, 3, 3.0), (2, 1, 5.0), (2, 2, 5.0), (3, 1, 7.0)]
    out = min_max(spark.createDataFrame(rows, SCHEMA), cut=cut)
    got = {(r.query_id, r.doc_id): r.score for r in out.collect()}
    assert got == {(1, 1): 0, (1, 2): 1, (1, 3): 0.5, (2, 1): 0, (2, 2): 0, (3, 1): 0}


def test_blend_keeps_all_rows_in_order(spark):
    a = spark.range(100).select(F.lit(1).alias("query_id"), F.col("id").alias("doc_id"), (F.col("id") % 10).alias("score"))
    b = a.where("doc_id < 10").withColumn("score", F.lit(100))
    out = blend([a, b], [1.0, 2.0]).collect()
    assert len(out) == 100 and out[0].doc_id == 9 and [r.score for r in out] == sorted((r.score for r in out), reverse=True)
    assert blend([a, b], [1.0, 2.0], k=3).count() == 3
