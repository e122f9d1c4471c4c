"""Hard negatives by lists that the anchors of a cluster share, walked until nothing better can follow.

Anchors are clustered by direction. For a cluster with centroid c and the largest angle t between c and a member, no
member u scores an item x above |u| |x| cos(max(0, angle(x, c) - t)). A task sorts its items by that bound (over |u|)
once for a cluster, and every anchor of the cluster walks the list, in growing strides of one matrix product each. An
anchor stops where the bound of all that follows is below what it still needs: its last place, or the least score that
counts. So its places are certain, not approximate.

Items are dealt into groups of bounded size, and all anchors, a stated share of the rows, in blocks of their clusters
pass by each group, one block in memory at a time. What a group returns are an anchor's best rows in it; the best of all
groups are ranked by anchor. Nothing depends on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.session import stage

SCALE = 256
#: Components of larger magnitude, after scaling, can't be sure of scores of 64 bits; rows that have one take no part.
LARGEST = 1 << 27
POSITIVES = 5
NEGATIVES = 10
#: Percent of the positive's score that a negative's may have.
LOW, HIGH = 30, 90
CLUSTERS = 32
#: The centroids are fitted on so many anchors, those whose ids hash lowest; they only decide how soon walks end.
FIT_ANCHORS = 4096
FIT_STEPS = 8
BLOCK_ANCHORS = 512
GROUP_ITEMS = 200_000
#: Items of a walk's first stride; strides double up to the last.
FIRST_STRIDE, LAST_STRIDE = 64, 2048

_FOUND = "anchor_id long, place int, item_id long, score long"


def scaled_rows(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v: array<long>) of (vec_id, embedding, label): components times ``scale``, rounded down.

    Rows with a null id, label, vector or component, with a component that isn't finite, or with one of LARGEST or more
    after scaling take no part. Of rows that repeat an id only the one of the least label, then vector, counts.
    """
    x = F.transform("embedding", lambda e: e.cast("double"))
    fine = F.forall(x, lambda e: F.coalesce(F.abs(e) * scale < LARGEST, F.lit(False)))  # NaN is above every number
    rows = embeddings.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(fine)
    v = F.transform(x, lambda e: F.floor(e * scale).cast("long"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
    least = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
    return least.select("vec_id", "r.label", "r.v")


def _matrix(lists: list[np.ndarray], width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros, which changes no score."""
    out = np.zeros((len(lists), width), np.int64)
    n = np.array([len(x) for x in lists])
    out[np.arange(width) < n[:, None]] = np.concatenate([np.zeros(0, np.int64), *lists])
    return out


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = x.astype(float)
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norm > 0, norm, 1)[:, None], norm


def fit_centroids(vectors: np.ndarray, clusters: int = CLUSTERS, steps: int = FIT_STEPS) -> np.ndarray:
    """Spherical k-means from evenly spaced vectors: centroids of length one."""
    points = _unit(vectors)[0]
    if not len(points):
        return np.zeros((1, vectors.shape[1]))
    centroids = points[np.linspace(0, len(points) - 1, min(clusters, len(points))).astype(int)]
    for _ in range(steps):
        nearest = (points @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        centroids = np.where(sums.any(axis=1)[:, None], _unit(sums)[0], centroids)
    return centroids


def _clustered(anchors: DataFrame) -> DataFrame:
    """``anchors`` with ``cluster`` and ``part``: blocks of BLOCK_ANCHORS on average."""
    sample = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ANCHORS).select("v").collect()
    lists = [np.array(r.v, np.int64) for r in sample]
    width = max((len(x) for x in lists), default=1)
    centroids = fit_centroids(_matrix(lists, width))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.asarray(x, np.int64)[:width] for x in batch.column(1).to_pylist()]
            near = (_matrix(vectors, width) @ centroids.T).argmax(axis=1) if vectors else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(near.astype(np.int32))], ["vec_id", "cluster"])

    found = stage(anchors.select("vec_id", "v").mapInArrow(nearest, "vec_id long, cluster int"), "anchor-clusters")
    parts = found.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK_ANCHORS).alias("parts"))  # CLUSTERS rows at most
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part")
    return anchors.join(found.join(F.broadcast(parts), "cluster").select("vec_id", "cluster", part), "vec_id")


class Items:
    """The items of a group, sorted by id, and the list of the cluster that was asked for last."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.unit, self.norm = _unit(self.vectors)
        self.largest = int(np.abs(self.vectors).max(initial=0))
        self.listed = None

    def walk_list(self, key: object, centre: np.ndarray, angle: float) -> tuple[np.ndarray, np.ndarray]:
        """Items by falling bound, and the bounds, for anchors of length one within ``angle`` of ``centre``."""
        if self.listed != key:
            apart = np.arccos(np.clip(self.unit @ centre, -1, 1))
            bound = self.norm * (np.cos(np.maximum(0, apart - angle)) + 1e-9)
            self.order = np.argsort(-bound, kind="stable")
            self.bound, self.listed = bound[self.order], key
        return self.order, self.bound

    def scores(self, anchors: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Exact inner products: as doubles while those hold all integers that can occur, else as 64-bit integers."""
        if int(np.abs(anchors).max(initial=0)) * self.largest * anchors.shape[1] < 1 << 53:
            return np.rint(anchors.astype(float) @ self.vectors[items].astype(float).T).astype(np.int64)
        return anchors @ self.vectors[items].T


def _best(anchor: np.ndarray, item: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Which rows are among the first ``k`` of their anchor, by falling score, then item."""
    order = np.lexsort((item, -score, anchor))
    begin = np.searchsorted(anchor[order], anchor[order])
    return order[np.arange(len(order)) - begin < k]


def walk(items: Items, order, bound, anchors, labels, ids, low, high, same: bool, k: int):
    """The first ``k`` items of each anchor whose label is the ``same`` or another and whose score lies within ``low``
    and ``high``: (anchor, item, score), items by number. ``bound`` is that of the items in ``order``, for anchors of
    length one. An anchor is no item of its own."""
    norm = _unit(anchors)[1]
    active = np.arange(len(anchors))
    need = low.astype(float)
    have = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    at, stride = 0, FIRST_STRIDE
    while at < len(order):
        active = active[norm[active] * bound[at] + 1e-6 * (1 + norm[active]) >= need[active]]
        if not len(active):
            break
        step = order[at : at + stride]
        scores = items.scores(anchors[active], step)
        fits = (scores >= need[active][:, None]) & (scores <= high[active][:, None])
        fits &= (items.labels[step] == labels[active][:, None]) == same
        fits &= items.ids[step] != ids[active][:, None]
        a, i = np.nonzero(fits)
        if len(a):
            have = tuple(np.concatenate(x) for x in zip(have, (active[a], step[i], scores[a, i])))
            kept = _best(*have, k)
            have = tuple(x[kept] for x in have)
            full = np.flatnonzero(np.bincount(have[0], minlength=len(anchors)) >= k)
            last = np.searchsorted(have[0], full, "right") - 1
            need[full] = have[2][last]
        at += stride
        stride = min(2 * stride, LAST_STRIDE)
    return have


def _mined(rows: DataFrame, anchors: DataFrame, same: bool, k: int, group_items: int) -> DataFrame:
    """_FOUND of the ``k`` best of each group of ``rows`` for the ``anchors`` (vec_id, label, v, cluster, part, low, high:
    arrays of the least and largest score of each place; null if there is none)."""
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(tasks, -(-rows.count() // group_items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, block, name = None, [], [], None
        items = None

        def mine():
            ids, labels = (np.array([r[x] for r in block], np.int64) for x in ("vec_id", "label"))
            width = max(items.vectors.shape[1], max(len(r["v"]) for r in block))
            if width > items.vectors.shape[1]:
                items.vectors = np.pad(items.vectors, ((0, 0), (0, width - items.vectors.shape[1])))
                items.unit = _unit(items.vectors)[0]
            vectors = _matrix([np.array(r["v"], np.int64) for r in block], width)
            unit, norm = _unit(vectors)
            centre = _unit(unit.sum(axis=0, keepdims=True))[0][0]
            angle = float(np.arccos(np.clip((unit @ centre)[norm > 0], -1, 1)).max(initial=0)) + 1e-6
            order, bound = items.walk_list((name, width), centre, angle)
            for place in range(max(len(r["low"]) for r in block)):
                some = np.array([j for j, r in enumerate(block) if place < len(r["low"])])
                low, high = (np.array([block[j][x][place] for j in some], np.int64) for x in ("low", "high"))
                a, i, score = walk(items, order, bound, vectors[some], labels[some], ids[some], low, high, same, k)
                found = [ids[some][a], np.full(len(a), place, np.int32), items.ids[i], score]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], [x.split()[0] for x in _FOUND.split(", ")])

        for batch in batches:
            for row in _runs(batch):
                kind = row["kind"]
                if block and (row["g"], row["cluster"], row["part"]) != (group, *name):
                    yield from mine()
                    block = []
                if row["g"] != group:
                    group, held, items = row["g"], [], None
                if kind == 0:
                    held.append(row["run"])
                    continue
                if items is None:
                    items = _items(held)
                    held = []
                if len(items.ids):
                    block.append(row)
                    name = (row["cluster"], row["part"])
        if block:
            yield from mine()

    none = F.lit(None)
    g = F.pmod(F.xxhash64(F.lit(7), "vec_id"), F.lit(groups)).cast("int")
    own = rows.select(
        g.alias("g"), F.lit(0).alias("kind"), F.lit(-1).alias("cluster"), F.lit(-1).alias("part"), "vec_id", "label", "v",
        none.cast("array<long>").alias("low"), none.cast("array<long>").alias("high"),
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    guests = anchors.select(every.alias("g"), F.lit(1).alias("kind"), "cluster", "part", "vec_id", "label", "v", "low", "high")
    dealt = own.unionByName(guests).repartition(groups, "g").sortWithinPartitions("g", "kind", "cluster", "part", "vec_id")
    return dealt.mapInArrow(run, _FOUND)


def _runs(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch; neighbouring items of a group come as one run (ids, labels, lengths, components)."""
    g, kind = (batch.column(k).to_numpy() for k in (0, 1))
    cuts = np.flatnonzero((np.diff(g) != 0) | (np.diff(kind) != 0)) + 1
    for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(g)]):
        part = batch.slice(first, last - first)
        if not len(part):
            continue
        if kind[first]:
            yield from part.to_pylist()
            continue
        lists = part.column(6)
        run = (
            part.column(4).to_numpy(), part.column(5).to_numpy(),
            lists.value_lengths().to_numpy(), lists.flatten().to_numpy(),
        )
        yield {"g": int(g[first]), "kind": 0, "cluster": -1, "part": -1, "run": run}


def _items(runs: list[tuple]) -> Items:
    ids, labels, lengths, flat = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (list(zip(*runs)) or [()] * 4))
    width = int(lengths.max(initial=0))
    vectors = np.zeros((len(ids), width), np.int64)
    vectors[np.arange(width) < lengths[:, None]] = flat
    return Items(ids, labels, vectors)


def _first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "item_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
    high: int = HIGH, group_items: int = GROUP_ITEMS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for ``anchors``, which are some of
    ``rows`` (vec_id: unique; label; v: array<long>), a written table, as it is read several times.

    A row's score is its inner product with the anchor; equal scores are ordered by id. An anchor's positives are its
    first other rows of the same label, its negatives for each positive the first rows of other labels whose score is
    ``low`` to ``high`` percent of the positive's, numbered from 1. Vectors may differ in length (the shorter one goes on
    in zeros), be zero or equal. Positives without a negative give no row; without anchors there is none.
    """
    anchors = stage(_clustered(stage(anchors, "anchors")), "anchors")
    least, most = (F.array(F.lit(x).cast("long")) for x in (-(1 << 62), 1 << 62))
    found = _mined(rows, anchors.withColumns({"low": least, "high": most}), True, positives, group_items)
    found = stage(_first(found, positives, "anchor_id"), "positives")
    place = F.sort_array(F.collect_list(F.struct("rank", "item_id", "score"))).alias("p")
    wanted = found.groupBy("anchor_id").agg(place).withColumnRenamed("anchor_id", "vec_id")

    def percent(p, share, up):
        """The least integer from ``share`` percent of the score on, or the largest up to it."""
        scaled = p["score"].cast("decimal(20,0)") * share
        return (-F.floor(-scaled / 100) if up else F.floor(scaled / 100)).cast("long")

    lows = F.transform("p", lambda p: percent(p, low, True))
    highs = F.transform("p", lambda p: percent(p, high, False))
    asking = anchors.join(wanted, "vec_id").withColumns({"low": lows, "high": highs}).drop("p")
    got = stage(_first(_mined(rows, asking, False, negatives, group_items), negatives, "anchor_id", "place"), "negatives")
    pairs = found.select("anchor_id", (F.col("rank") - 1).alias("place"), F.col("item_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return got.join(pairs, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("item_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
