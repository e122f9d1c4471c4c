"""Links between sets that share a bucket, by stars and then, where those leave more than one component, by scanning.

Each bucket first has its member of the largest weight as hub, which is compared with the other members on the full sets;
links join sets to components. Copies and near copies of a text are joined by that, and never meet in pairs. A bucket
whose members are all in one component is done.

The sets of the others, in groups that share buckets, are scanned: a task indexes the shingles of a block of a group, and
the inverted lists of one set at a time give its overlap with all others there. Only sets outside the group's largest
component are scanned, against all of it, and only links of a spanning forest leave a task. A group of more than a block
is dealt over tasks, shares of the scanned sets with each block. So no link is lost.

Where buckets overlap widely without links, as lists of common shingles do, groups get large: ``star_links`` stays within
the buckets instead. Those outside a bucket's largest component become hubs of it in turn, more of them each round,
until every two members that aren't in one component have been compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.bitmaps import Bitmaps, groups
from lodestone.llm.chunks import gather
from lodestone.llm.components import components
from lodestone.session import stage, stage_bucketed

#: Shingles in a block of a group's sets.
BLOCK_ELEMENTS = 1_000_000
#: Each round of star_links takes so many times as many hubs of a bucket as the one before.
GROWTH = 8
#: Pairs of hubs and members that star_links compares by bitmaps in one task.
TASK_PAIRS = 20_000_000

_U = np.uint64


def once(sets: DataFrame) -> DataFrame:
    """``sets`` (set_no, hashes), a table in buckets by set_no, with one row of each set; rows are repeated only where
    documents are. Without repetitions nothing is written again."""
    numbers = sets.groupBy("set_no").agg(F.count("*").alias("n"))
    return sets if numbers.where("n > 1").isEmpty() else stage_bucketed(sets.dropDuplicates(["set_no"]), "set_no")


def _stars(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the hub of each bucket and its other members, of ``rows`` (key, set_no, n, weight), whose sizes allow a
    link."""
    heaviest = F.max_by(F.struct(F.col("set_no").alias("hub"), F.col("n").alias("hub_n")), F.struct("weight", -F.col("set_no")))
    met = rows.join(rows.groupBy("key").agg(heaviest.alias("h")).select("key", "h.*"), "key").where("hub <> set_no")
    met = met.where(100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n"))
    return met.select(F.least("hub", "set_no").alias("a"), F.greatest("hub", "set_no").alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs whose full sets are similar enough."""
    one = sets.select(F.col("set_no").alias("a"), F.col("hashes").alias("x"))
    other = sets.select(F.col("set_no").alias("b"), F.col("hashes").alias("y"))
    both = pairs.join(one, "a").join(other, "b").withColumn("common", F.size(F.array_intersect("x", "y")))
    return both.where(100 * F.col("common") >= percent * (F.size("x") + F.size("y") - F.col("common"))).select("a", "b")


def _forest(table: pa.Table, percent: int) -> pa.Table:
    """Links that join the components ``label`` of the sets in ``table`` (set_no, hashes, label, scan) as all links of
    those to scan do."""
    numbers, at = np.unique(table.column("set_no").to_numpy(), return_index=True)
    table = table.take(pa.array(at))
    lists = table.column("hashes").combine_chunks()
    flat = lists.flatten().to_numpy().view(_U)
    n = np.asarray(lists.value_lengths()).astype(np.int64)
    group = np.unique(table.column("label").to_numpy(), return_inverse=True)[1]
    ends = np.cumsum(n)
    order = np.argsort(flat, kind="stable")
    keys, owner = flat[order], np.repeat(np.arange(len(n)), n)[order]
    links: list[tuple[int, int]] = []
    for i in np.flatnonzero(table.column("scan").to_numpy(zero_copy_only=False)).tolist():
        own = flat[ends[i] - n[i] : ends[i]]
        low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
        both = np.bincount(owner[gather(np.arange(len(keys)), low, high - low)], minlength=len(n))
        near = np.flatnonzero((100 * both >= percent * (n[i] + n - both)) & (group != group[i]))
        for j in near.tolist():
            if group[j] != group[i]:
                group[group == group[j]] = group[i]
                links.append((int(numbers[i]), int(numbers[j])))
    a, b = ([x[k] for x in links] for k in (0, 1))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _scanned(rows: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links within the groups of sets that share buckets, of the members ``rows`` (key, set_no, n, label)."""
    first = rows.groupBy("key").agg(F.min("set_no").alias("b"))
    groups = components(rows.join(first, "key").select(F.col("set_no").alias("a"), "b"))
    members = rows.select("set_no", "n", "label").distinct().join(groups.selectExpr("node AS set_no", "label AS w"), "set_no")
    members = stage(members, "group-members")
    counts = members.groupBy("w", "label").agg(F.count("*").alias("sets"), F.sum("n").alias("elements"))
    sizes = counts.groupBy("w").agg(
        F.max(F.struct("sets", "label", "elements")).alias("main"), F.sum("elements").alias("elements")
    )
    tasks = lambda elements: F.greatest(F.ceil(elements / block), F.lit(1)).cast("int")
    sizes = sizes.select(
        "w", F.col("main.label").alias("main"), tasks(F.col("elements")).alias("blocks"),
        tasks(F.col("elements") - F.col("main.elements")).alias("shares"),
    )
    placed = members.join(sizes, "w")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def own(n: str):
        return F.pmod(F.xxhash64("set_no"), F.col(n)).cast("int")

    scanned = placed.where("label <> main").select("w", own("shares").alias("i"), every("blocks").alias("j"), "set_no", "label", F.lit(True).alias("scan"))
    others = placed.select("w", every("shares").alias("i"), own("blocks").alias("j"), "set_no", "label", F.lit(False).alias("scan"))
    both = scanned.unionByName(others).groupBy("w", "i", "j", "set_no", "label").agg(F.max("scan").alias("scan"))
    dealt = both.join(sets, "set_no").select("w", "i", "j", "set_no", "hashes", "label", "scan")
    return dealt.groupBy("w", "i", "j").applyInArrow(lambda t: _forest(t, percent), "a long, b long")


def bucket_links(buckets: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK_ELEMENTS) -> DataFrame:
    """Links (a, b) that join the same components as all links between members of one bucket, of ``buckets`` (key,
    set_no, n: size of the set, weight) and ``sets`` (set_no, hashes), both written tables, the latter in buckets by
    set_no, so that pairs are shuffled to the sets and not the sets to the pairs."""
    links = stage(_confirmed(_stars(buckets, percent), sets, percent), "links")
    labels = components(links).withColumnRenamed("node", "set_no")
    rows = buckets.join(labels, "set_no", "left").withColumn("label", F.coalesce("label", "set_no"))
    least, most = F.min("label").alias("least"), F.max("label").alias("most")
    undecided = rows.groupBy("key").agg(least, most).where("least <> most").select("key")
    rows = stage(rows.join(undecided, "key").select("key", "set_no", "n", "label"), "open-buckets")
    return links.unionByName(stage(_scanned(rows, sets, percent, block), "links"))


def _met(rows: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the hubs of each bucket with its members that have another label, unless their ``bitmaps`` (set_no, bits)
    tell that they aren't linked; of ``rows`` (key, set_no, n, label, hub). Pairs are told apart in the task of their
    bucket; where it has many, its hubs are dealt over several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in groups(batches, ["key", "share"]):
            set_no, n, label = (table.column(c).to_numpy() for c in ("set_no", "n", "label"))
            hub, bits = table.column("hub").to_numpy(), table.column("bits").to_pylist()
            a, b = [], []
            for first, last in zip(cuts, cuts[1:]):
                own = Bitmaps(n[first:last], bits[first:last], percent)
                for x in np.flatnonzero(hub[first:last]).tolist():
                    near = own.near(x, label[first:last] != label[first + x])
                    a += [set_no[first + x]] * len(near)
                    b.append(set_no[first:last][near])
            b = np.concatenate([np.zeros(0, np.int64), *b])
            a = np.array(a, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    numbers = rows.groupBy("key").agg(F.count("*").alias("members"), F.count_if("hub").alias("hubs")).where("hubs > 0")
    shares = F.ceil(F.col("members") * F.col("hubs") / TASK_PAIRS)
    shares = F.greatest(F.least(shares, F.col("hubs")), F.lit(1)).cast("int").alias("shares")
    dealt = rows.join(numbers.select("key", shares), "key")
    dealt = dealt.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    mine = F.pmod(F.xxhash64("set_no"), F.col("shares")) == F.col("share")
    dealt = dealt.select("key", "share", "set_no", "n", "label", (F.col("hub") & mine).alias("hub")).join(bitmaps, "set_no")
    dealt = dealt.repartition("key", "share").sortWithinPartitions("key", "share", "n")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def star_links(buckets: DataFrame, sets: DataFrame, percent: int, bitmaps: DataFrame) -> DataFrame:
    """The same by stars alone, of pairs that ``bitmaps`` (set_no, bits) leave."""
    first = Window.partitionBy("key").orderBy(F.desc("weight"), "set_no")
    heaviest = buckets.groupBy("key").agg(F.max_by("set_no", F.struct("weight", -F.col("set_no"))).alias("set_no"))
    done, share = stage(heaviest.select("key", "set_no"), "hubs"), 1
    rows = buckets.withColumn("label", F.col("set_no"))
    links = None
    while True:
        hubs = done.withColumn("hub", F.lit(True))
        marked = rows.join(hubs, ["key", "set_no"], "left").withColumn("hub", F.coalesce("hub", F.lit(False)))
        found = stage(_confirmed(_met(marked, bitmaps, percent), sets, percent), "links")
        links = links.unionByName(found) if links else found
        labels = components(links).withColumnRenamed("node", "set_no")
        rows = rows.select("key", "set_no", "n", "weight").join(done, ["key", "set_no"], "left_anti")
        rows = rows.join(labels, "set_no", "left").withColumn("label", F.coalesce("label", "set_no"))
        numbers = rows.groupBy("key", "label").agg(F.count("*").alias("members"))
        largest = numbers.groupBy("key").agg(F.max(F.struct("members", "label")).alias("most"), F.count("*").alias("labels"))
        undecided = largest.where("labels > 1").select("key", F.col("most.label").alias("main"))
        rows = stage(rows.join(undecided, "key"), "open-buckets")
        share *= GROWTH
        hubs = rows.where("label <> main").withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= share)
        done = stage(hubs.select("key", "set_no"), "hubs")
        if done.isEmpty():
            return links
