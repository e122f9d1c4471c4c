"""Sharding by extendible hashing: documents go to buckets by the first bits of their hash, and only buckets with more
bytes than a shard may have are split on another bit.

The directory comes from sums: bytes are added up for hash prefixes of some more bits than an even spread would need,
then for all shorter prefixes, and each prefix takes the fewest bits at which it fits. Rows of prefixes that don't fit
yet, only those, go on with the next bits. The hash has three parts: of the id, of the text, and of the row, so that
documents that share an id, or all else, are split as well. A row by itself is never split: one above the limit has a
shard of its own.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import small
from lodestone.session import stage

LIMIT = 1 << 20
#: Bits beyond an even spread that one pass looks at, and bits of each part of the hash.
MORE_BITS = 4
WORD = 60


def hash_bits(value: Column) -> Column:
    """60 bits of a string's MD5, as a string of 0 and 1."""
    return F.lpad(F.conv(F.substring(F.md5(value), 1, 15), 16, 2), WORD, "0")


def _directory(rows: DataFrame, limit: int, depth: int, bits: int) -> DataFrame:
    """(cell, shard): for the prefixes of ``bits`` bits, the shard's prefix, at least ``depth`` bits; null if even the
    cell is too large."""
    cells = rows.groupBy(F.substring("bits", 1, bits).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
    cells = stage(cells, "shard-cells")
    levels = cells.select("cell", "bytes", "n", F.explode(F.sequence(F.lit(depth), F.lit(bits))).alias("d"))
    levels = levels.withColumn("prefix", F.substr("cell", F.lit(1), F.col("d")))
    sums = levels.groupBy("d", "prefix").agg(F.sum("bytes").alias("total"), F.sum("n").alias("rows"))
    fits = sums.where((F.col("total") <= limit) | (F.col("rows") == 1)).select("d", "prefix")
    fewest = levels.join(fits, ["d", "prefix"]).groupBy("cell").agg(F.min("d").alias("d"))
    shard = F.substr("cell", F.lit(1), F.col("d"))
    return cells.select("cell").join(fewest, "cell", "left").select("cell", shard.alias("shard"))


def assign_shards(docs: DataFrame, limit: int = LIMIT, row_no: str | None = None) -> DataFrame:
    """(row_no, doc_id, bytes, shard): the shard of each row of ``docs`` (doc_id, text), as the bits of its prefix.

    ``bytes`` are those of the text in UTF-8, 0 for null. A null id has the hash of the empty string. Shards have
    ``limit`` bytes at most, or one row. ``row_no`` is the column of that name, of numbers that differ, or arbitrary. No documents, no shards; if all fit together, the one
    shard's prefix is empty.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        (F.col(row_no) if row_no else F.monotonically_increasing_id()).alias("row_no"), "doc_id", F.octet_length(text).cast("long").alias("bytes"),
        hash_bits(key).alias("bits"), F.substring(F.md5(text), 1, 15).alias("more"),
    )
    rows = stage(rows, "shard-rows")
    done, depth, part = [], 0, 1
    while True:
        total, n = rows.agg(F.sum("bytes"), F.count("*")).first()
        if not n:
            break
        spread = ceil(log2(max(1, total / limit))) + MORE_BITS if depth == 0 else MORE_BITS + 4
        if depth == part * WORD:
            more = {1: F.lpad(F.conv("more", 16, 2), WORD, "0"), 2: hash_bits(F.col("row_no").cast("string"))}
            if part not in more:
                raise ValueError("two rows have the same 180 bits")
            rows = rows.withColumn("bits", F.concat("bits", more[part]))
            part += 1
        bits = min(part * WORD, depth + spread)
        cells = stage(_directory(rows, limit, depth, bits), "shard-directory")
        met = rows.withColumn("cell", F.substring("bits", 1, bits)).join(small(cells), "cell").drop("cell")
        done.append(met.where("shard IS NOT NULL").select("row_no", "doc_id", "bytes", "shard"))
        rows = stage(met.where("shard IS NULL").drop("shard"), "shard-rows")
        depth = bits
    empty = rows.select("row_no", "doc_id", "bytes", F.lit("").alias("shard")).limit(0)
    return reduce(DataFrame.unionByName, done) if done else empty


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> str:
    """Writes all columns of ``docs`` in folders ``shard=b<bits>``, each by one task, which holds a shard's rows. If
    ``docs`` has a column shard, whatever its case, the folders are called shard_1, and so on; returns the name."""
    taken = {c.lower() for c in docs.columns}
    name = next(x for x in ("shard", *(f"shard_{i}" for i in range(1, len(taken) + 2))) if x not in taken)
    # the numbers are written: numbers given in two readings differ if the files are split otherwise
    rows = stage(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("no")), "shard-docs")
    shards = assign_shards(rows.select("doc.doc_id", "doc.text", "no"), limit, "no")
    shards = shards.select(F.col("row_no").alias("no"), F.concat(F.lit("b"), "shard").alias("in"))
    joined = rows.join(shards, "no").select("doc.*", F.col("in").alias(name))
    joined.repartition(name).write.partitionBy(name).parquet(path)
    return name
