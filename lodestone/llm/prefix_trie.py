"""The trie of conversation prefixes, from vertical bitmaps per shard.

A conversation is a sequence of turns, each a 128-bit digest of role and text with the size of its text. Conversations
are ordered by id over the tasks, and a task takes them in shards of neighbouring ids. A shard's index holds a bitset of
conversations for each (position, turn); going depth first from the root, the bitset of a node is intersected with the
postings of the next position, which gives its children, their sizes (population counts) and the list of conversations
that end there. What is below a conversation's last common node is a chain of its own and needs no bitset.

A node is named by the sum of its turns' digests, each mixed with its position; so shards agree on names without meeting.
Shards send one row per node with counts already added up; nodes that all conversations share arrive once a shard.
Sums over subtrees are made in Spark by doubling distances, over those nodes only that two conversations share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.chunks import gather, slices
from lodestone.llm.common import tail
from lodestone.llm.shingles import mix
from lodestone.session import stage

#: Turns in a shard: its bitsets have a bit per conversation, for each turn that at least two of them have.
SHARD_TURNS = 20_000
#: Turns besides its own that each conversation adds to a shard, so that turnless ones are bounded, too.
OVERHEAD = 4
NO_ENDS = hashlib.sha256(b"").hexdigest()

_U = np.uint64
_LOCAL = "k1 long, k2 long, q1 long, q2 long, depth long, conv_id long, n long, size long, end_id long, ends string"


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns: array<struct<h1, h2, size>>) of rows (conv_id, turn, role, text), by turn.

    A null turn comes first, rows of one turn number come in the order of their digests (equal rows stay as many), a
    null role or text is empty, and rows without a conv_id take no part. A conversation's digests, 24 bytes a turn, are
    one row.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        F.col("turn"),
        F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit(1), role, text).alias("h2"),
        F.octet_length(text).cast("long").alias("size"),
    )
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["h1"], t["h2"], t["size"])).alias("turns"))


def with_shared_heads(sequences: DataFrame, group: int = 5, most: int = 8) -> DataFrame:
    """``sequences`` with the first h turns of each conversation c replaced by the first h of conversation
    c - c % ``group`` (all of them if there are fewer, none if there is no such conversation); h is crc32(c) modulo
    ``most`` + 1. Each head is joined by ``group`` conversations at most."""
    heads = sequences.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    joined = sequences.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(heads, "base", "left")
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    head = F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0))
    return joined.select("conv_id", F.concat(head, tail(F.col("turns"), h)).alias("turns"))


def _bits(rows: np.ndarray, n: int) -> int:
    """The set of ``rows`` out of ``n``."""
    flags = np.zeros(n, np.uint8)
    flags[rows] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _members(bits: int) -> np.ndarray:
    raw = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little"))


def _codes(position: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """A number for each different (position, turn)."""
    order = np.lexsort((h2, h1, position))
    new = np.ones(len(order), bool)
    for x in (position[order], h1[order], h2[order]):
        new[1:] &= x[1:] == x[:-1]
    new = ~new
    new[:1] = False
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def shard_nodes(lengths: np.ndarray, codes: np.ndarray) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """The trie of one shard: conversations have ``lengths`` turns, numbered by ``codes`` one after another.

    Returns nodes with two or more members as (a member: the first, depth, number of members, bitset of those that end
    there), and for each conversation the depth from which on it is alone, as (conversation, depth).
    """
    n = len(lengths)
    starts = (np.cumsum(lengths) - lengths).tolist()
    owner = np.repeat(np.arange(n), lengths)
    order = np.argsort(codes, kind="stable")
    groups = np.split(owner[order], np.flatnonzero(np.diff(codes[order])) + 1) if len(codes) else []
    postings = [_bits(rows, n) if len(rows) > 1 else 0 for rows in groups]
    ending = {int(d): _bits(np.flatnonzero(lengths == d), n) for d in np.unique(lengths)}
    codes = codes.tolist()
    shared, alone = [], []
    stack = [((1 << n) - 1, 0)] if n else []
    while stack:
        bits, depth = stack.pop()
        first = (bits & -bits).bit_length() - 1
        if bits == 1 << first:
            alone.append((first, depth))
            continue
        ends = bits & ending.get(depth, 0)
        shared.append((first, depth, bits.bit_count(), ends))
        rest = bits ^ ends
        while rest:
            low = rest & -rest
            child = rest & postings[codes[starts[low.bit_length() - 1] + depth]] or low
            rest ^= child
            stack.append((child, depth + 1))
    return shared, alone


def _names(h: np.ndarray, position: np.ndarray, lengths: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the prefixes of all conversations, the empty one first, and the step that led to each."""
    step = mix(h ^ mix(position.astype(_U), salt))
    at = np.cumsum(lengths + 1) - lengths - 1
    steps = np.zeros(int((lengths + 1).sum()), _U)
    inner = np.ones(len(steps), bool)
    inner[at] = False
    steps[inner] = step
    total = np.cumsum(steps, dtype=_U)
    return total - np.repeat(total[at], lengths + 1), steps


def _shard(ids: np.ndarray, lengths: np.ndarray, h1: np.ndarray, h2: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    """The nodes of one shard, as rows of _LOCAL."""
    position = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    shared, alone = shard_nodes(lengths, _codes(position, h1, h2))
    first, depth, count, ends = ([x[k] for x in shared] for k in range(4))
    single, since = ([x[k] for x in alone] for k in range(2))
    single, since = np.array(single, np.int64), np.array(since, np.int64)
    chain = lengths[single] - since + 1
    lone = np.repeat(single, chain)
    lone_depth = gather(np.arange(int(lengths.max()) + 1), since, chain)
    member = np.concatenate([np.array(first, np.int64), lone])
    depth = np.concatenate([np.array(depth, np.int64), lone_depth])
    begin = np.cumsum(lengths + 1) - lengths - 1
    place = begin[member] + depth
    columns = []
    for h, salt in ((h1, 101), (h2, 102)):
        names, steps = _names(h, position, lengths, salt)
        columns.append((names[place].view(np.int64), (names[place] - steps[place]).view(np.int64)))
    (k1, q1), (k2, q2) = columns
    size = np.zeros(int((lengths + 1).sum()), np.int64)
    inner = np.ones(len(size), bool)
    inner[begin] = False
    size[inner] = sizes
    lists = [_members(x) if x else None for x in ends]
    last = lone_depth == lengths[lone]
    end_id = [None if x is None else int(ids[x[0]]) for x in lists] + [int(i) if x else None for i, x in zip(ids[lone], last)]
    texts = [None if x is None else ",".join(map(str, ids[x].tolist())) for x in lists]
    texts += [None if i is None else str(i) for i in end_id[len(lists) :]]
    root = depth == 0
    return pa.RecordBatch.from_arrays(
        [
            pa.array(k1), pa.array(k2), pa.array(q1, mask=root), pa.array(q2, mask=root), pa.array(depth),
            pa.array(ids[member]), pa.array(np.concatenate([np.array(count, np.int64), np.ones(len(lone), np.int64)])),
            pa.array(size[place]), pa.array(end_id, pa.int64()), pa.array(texts, pa.string()),
        ],
        names=[x.split()[0] for x in _LOCAL.split(", ")],
    )


def _local_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of a batch, in shards. Rows come sorted by conv_id."""
    for batch in batches:
        lists = batch.column(1)
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        for first, last in slices((lengths + OVERHEAD).tolist(), SHARD_TURNS):
            flat = [batch.column(k).slice(first, last - first).flatten().to_numpy() for k in (1, 2, 3)]
            ids = batch.column(0).slice(first, last - first).to_numpy()
            yield _shard(ids, lengths[first:last], flat[0].view(_U), flat[1].view(_U), flat[2])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined lists of each node, whose rows follow each other in the order of their ids."""
    node, digest = None, hashlib.sha256()
    for batch in batches:
        done = []
        for k1, k2, ends in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if (k1, k2) == node:
                digest.update(b",")
            else:
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = (k1, k2), hashlib.sha256()
            digest.update(ends.encode())
        yield _digest_rows(done)
    if node:
        yield _digest_rows([(*node, digest.hexdigest())])


def _digest_rows(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    kinds = [("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)], names=[n for n, _ in kinds])


def _subtree_sums(shared: DataFrame) -> DataFrame:
    """(k1, k2, n_leaves, saved_tokens) over the whole subtrees of the nodes ``shared`` (k1, k2, q1, q2, depth, n_leaves,
    saved_tokens: what each adds itself).

    Round r knows sums down to 2^r levels below a node, and the node 2^r levels above it; those above add what the lower
    ones know. As many rounds as the depth has binary digits; each writes its rows, and what meets at a node are sums.
    """
    current = stage(shared, "trie-sums")
    deepest = current.agg(F.max("depth")).first()[0] or 0
    reach = 1
    while reach <= deepest:
        low = current.where(F.col("depth") >= reach)
        gained = low.groupBy("q1", "q2").agg(F.sum("n_leaves").alias("more"), F.sum("saved_tokens").alias("more_saved"))
        gained = gained.withColumnsRenamed({"q1": "k1", "q2": "k2"})
        far = current.where(F.col("depth") >= 2 * reach)
        above = low.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("q1").alias("u1"), F.col("q2").alias("u2"))
        far = far.join(above, ["q1", "q2"]).drop("q1", "q2").withColumnsRenamed({"u1": "q1", "u2": "q2"})
        near = current.where(F.col("depth") < 2 * reach).withColumns({c: F.lit(None).cast("long") for c in ("q1", "q2")})
        current = stage(
            near.unionByName(far).join(gained, ["k1", "k2"], "left").select(
                "k1", "k2", "q1", "q2", "depth",
                (F.col("n_leaves") + F.coalesce("more", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
            ),
            "trie-sums",
        )
        reach *= 2
    return current.select("k1", "k2", "n_leaves", "saved_tokens")


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie of ``sequences`` (conv_id: unique; turns), which has a node for each different
    sequence of first turns, the empty one included: ``conv_id`` its smallest member, ``depth``, ``parent_conv_id`` the
    parent's conv_id (null at the root), ``n_convs`` members, ``n_children``, ``n_leaves`` childless nodes in its
    subtree, ``saved_tokens`` the sum over its subtree of (members - 1) times the size of each node's last text,
    ``ends_sha256`` the digest of the ascending, comma-joined ids of those that end there. Subtrees include their top.

    Without conversations there is no node. Conversations without a turn are members of the root and end there.
    """
    rows = sequences.select("conv_id", *[F.col("turns")[c].alias(c) for c in ("h1", "h2", "size")])
    rows = rows.repartitionByRange("conv_id").sortWithinPartitions("conv_id")
    local = stage(rows.mapInArrow(_local_nodes, _LOCAL), "trie-local")
    ends = local.where("ends IS NOT NULL").select("k1", "k2", "end_id", "ends")
    ends = ends.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "end_id").select("k1", "k2", "ends")
    digests = ends.mapInArrow(_digests, "k1 long, k2 long, ends_sha256 string")
    nodes = local.groupBy("k1", "k2").agg(
        F.first("q1").alias("q1"), F.first("q2").alias("q2"), F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.first("size").alias("size"),
    ).join(digests, ["k1", "k2"], "left")
    nodes = stage(nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))), "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2"))
    children = children.agg(F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("n_lone"))
    shared = nodes.where("n_convs > 1").join(children, ["k1", "k2"], "left").select(
        "k1", "k2", "q1", "q2", "depth", "conv_id",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("n_lone")).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
    )
    shared = stage(shared, "trie-shared")
    sums = _subtree_sums(shared.drop("conv_id", "n_children")).join(shared.select("k1", "k2", "n_children"), ["k1", "k2"])
    above = shared.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("above"))
    # a node of one member is childless where the member ends; its parent's smallest member is its own if not shared
    lone_children = (F.col("ends_sha256") == NO_ENDS).cast("long")
    return nodes.join(sums, ["k1", "k2"], "left").join(above, ["q1", "q2"], "left").select(
        "conv_id", "depth",
        F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", lone_children).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
        "ends_sha256",
    )
