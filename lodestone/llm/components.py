"""Connected components by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import stage

#: So many edges at most, 16 MB, are joined within one task instead of in further rounds.
ONE_TASK_EDGES = 1_000_000


def components(edges: DataFrame, one_task: int = ONE_TASK_EDGES) -> DataFrame:
    """(node, label): each node of ``edges`` (a, b: longs) with the smallest node of its component, itself included.

    Each round hangs every node's larger neighbours, and then every node's smaller ones, below the smallest it knows.
    Every round writes the edges, so lineage stays short; what meets in one place is a minimum, never a list. At most
    ``one_task`` edges are finished by one task, with the same result.
    """
    current = stage(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    state = None
    while True:
        if current.limit(one_task + 1).count() <= one_task:
            return stage(current.repartition(1).mapInArrow(_labels, "node long, label long"), "labels")
        both = current.unionByName(current.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").selectExpr("b AS a", "m AS b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").selectExpr("b AS a", "m AS b")
        current = stage(small.unionByName(least.selectExpr("a", "m AS b")).distinct(), "edges")
        new = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if new == state:
            break
        state = new
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.selectExpr("a AS node", "b AS label").unionByName(roots.selectExpr("node", "node AS label"))


def _labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of all edges of a task."""
    parts = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
    if not parts:
        return
    nodes, place = np.unique(np.concatenate([x for part in parts for x in part]), return_inverse=True)
    sides, at = ([], []), 0
    for part in parts:
        for side, x in zip(sides, part):
            side.append(place[at : at + len(x)])
            at += len(x)
    a, b = (np.concatenate(x) for x in sides)
    label = np.arange(len(nodes))
    while (label[a] != label[b]).any():
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], ["node", "label"])
