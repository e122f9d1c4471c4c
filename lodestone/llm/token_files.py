"""Token-id files: ids of all documents in ascending doc_id order, as grammar-compressed shards with random access.

A shard's ids are compressed by Re-Pair in rounds: each round counts the pairs of neighbouring symbols, makes those that
occur MIN_COUNT times nonterminals and replaces them from left to right, where pairs overlap the first; pairs of
nonterminals are found by later rounds, until no pair is frequent. A shard stores its rules, how many ids each nonterminal expands to, and the remaining symbols, so that any range of its
ids is found by adding up lengths and decoded by expanding only what is in it.

A file is a Parquet file of shards, written and read by Spark on any store: (part, seq) order the shards, ``doc_ids``
and ``doc_tokens`` are the documents and their numbers of ids, ``payload`` holds (little-endian) the magic RPR1, the
number of terminals, rules and symbols as 32-bit integers, then the rules' pairs and the symbols with 16 bits each
(32, where the symbols need more: magic RPR2), between them the rules' lengths with 32 bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from lodestone.llm.chunks import Encoded, gather, plain, slices

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
STEP_CHARS = 2_000_000
#: Ids in a shard, unless one document has more.
SHARD_IDS = 4_000_000
#: How often a pair has to occur in a shard to become a nonterminal.
MIN_COUNT = 64
#: Characters and ids of chunks that a worker keeps.
KEEP = 10_000_000


@lru_cache(maxsize=2)
def _encoded(path: str) -> Encoded:
    """The plain calls of the library, on chunks that are new. Plain chunks are encoded in one text, a newline between
    them: pre-tokenization makes that newline a token of its own, which no chunk of the kind has."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    added = tuple(x.content for x in tokenizer.get_added_tokens_decoder().values())

    def ids_of(texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    between = ids_of(["a\nb"])[0][1:-1]

    def encode(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = len(between) == 1
        easy = [joined and plain(x) for x in new]
        named = "\n".join(new)
        for content in (a for a in added if a in named):
            easy = [is_easy and content not in x for x, is_easy in zip(new, easy)]
        some = [x for x, is_easy in zip(new, easy) if is_easy]
        flat = ids_of(["\n".join(some)])[0] if some else np.zeros(0, np.uint32)
        cuts = np.flatnonzero(flat == between[0]) if some else np.zeros(0, np.int64)
        if some and len(cuts) != len(some) - 1:
            raise ValueError("a chunk has a token of a newline")
        lengths = np.zeros(len(new), np.int64)
        at = np.flatnonzero(easy)
        lengths[at] = np.diff(cuts, prepend=-1, append=len(flat))[: len(at)] - 1
        rest = ids_of([x for x, is_easy in zip(new, easy) if not is_easy])
        others = np.flatnonzero(~np.array(easy, bool))
        lengths[others] = [len(x) for x in rest]
        out = np.empty(int(lengths.sum()), np.uint32)
        ends = np.cumsum(lengths)
        for i, ids in zip(others.tolist(), rest):
            out[ends[i] - len(ids) : ends[i]] = ids
        out[gather(np.arange(len(out)), ends[at] - lengths[at], lengths[at])] = np.delete(flat, cuts)
        return out, lengths

    return Encoded(encode, KEEP, added)


# --- Re-Pair ---------------------------------------------------------------------------------------


def _frequent(code: np.ndarray, min_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The codes that occur ``min_count`` times, the places that have one, and which. A hash table of counts leaves most
    rare ones out before the rest is sorted and looked up."""
    bucket = (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).view(np.int64)
    often = np.flatnonzero((np.bincount(bucket, minlength=1 << 20) >= min_count)[bucket])
    some = code[often]
    codes, counts = np.unique(some, return_counts=True)
    chosen = codes[counts >= min_count]
    if not len(chosen):
        return chosen, often[:0], often[:0]
    at = np.searchsorted(chosen, some)
    at[at == len(chosen)] = 0
    hit = chosen[at] == some
    return chosen, often[hit], at[hit]


def compress(ids: np.ndarray, min_count: int = MIN_COUNT) -> bytes:
    """The payload of a shard. Rounds go on until no pair occurs ``min_count`` times."""
    symbols = ids.astype(np.uint32)
    terminals = int(symbols.max()) + 1 if len(symbols) else 0
    rules = np.zeros((0, 2), np.uint32)
    while len(symbols) > 1:
        code = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:]
        chosen, here, at = _frequent(code, min_count)
        if not len(chosen):
            break
        # of pairs that overlap in a row, every other one counts
        new_run = np.diff(here, prepend=-2) != 1
        run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(here)), 0))
        taken = (np.arange(len(here)) - run_start) % 2 == 0
        here = here[taken]
        symbols[here] = terminals + len(rules) + at[taken]
        symbols = np.delete(symbols, here + 1)
        new = np.stack([(chosen >> np.uint64(32)).astype(np.uint32), chosen.astype(np.uint32)], axis=1)
        rules = np.concatenate([rules, new])
    lengths = _lengths(rules, terminals)
    small = terminals + len(rules) <= 1 << 16
    kind = "<u2" if small else "<u4"
    head = np.array([terminals, len(rules), len(symbols)], "<u4")
    return b"".join(
        [b"RPR1" if small else b"RPR2", head.tobytes(), rules.astype(kind).tobytes(), lengths.astype("<u4").tobytes(), symbols.astype(kind).tobytes()]
    )


def _lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """How many ids each rule stands for."""
    lengths = np.zeros(len(rules), np.int64)
    while len(rules) and not lengths.all():
        known = np.concatenate([np.ones(terminals, np.int64), lengths])
        parts = known[rules]
        lengths = np.where(parts.all(axis=1), parts.sum(axis=1), 0)
    return lengths


def _parse(payload: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    kind = {b"RPR1": "<u2", b"RPR2": "<u4"}.get(payload[:4])
    if kind is None:
        raise ValueError("not a shard")
    terminals, n_rules, n = np.frombuffer(payload, "<u4", 3, 4).tolist()
    at, width = 16, int(kind[-1])
    rules = np.frombuffer(payload, kind, 2 * n_rules, at).reshape(-1, 2).astype(np.uint32)
    at += 2 * n_rules * width
    lengths = np.frombuffer(payload, "<u4", n_rules, at).astype(np.int64)
    symbols = np.frombuffer(payload, kind, n, at + 4 * n_rules).astype(np.uint32)
    return terminals, rules, lengths, symbols


def _expand(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    while True:
        pair = symbols >= terminals
        if not pair.any():
            return symbols
        width = pair + 1
        out = np.repeat(symbols, width)
        first = (np.cumsum(width) - width)[pair]
        both = rules[symbols[pair] - terminals]
        out[first], out[first + 1] = both[:, 0], both[:, 1]
        symbols = out


def decompress(payload: bytes) -> np.ndarray:
    """All ids of a shard."""
    terminals, rules, _, symbols = _parse(payload)
    return _expand(symbols, rules, terminals)


def read_range(payload: bytes, start: int, stop: int) -> np.ndarray:
    """The ids of a shard from ``start`` up to ``stop``; only the symbols that cover them are expanded."""
    terminals, rules, lengths, symbols = _parse(payload)
    known = np.concatenate([np.ones(terminals, np.int64), lengths])
    ends = np.cumsum(known[symbols])
    stop = min(stop, int(ends[-1]) if len(ends) else 0)
    if start >= stop:
        return np.zeros(0, np.uint32)
    first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left")
    begin = int(ends[first] - known[symbols[first]])
    return _expand(symbols[first : last + 1], rules, terminals)[start - begin : stop - begin]


# --- files -----------------------------------------------------------------------------------------


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Writes the ids of ``docs`` (doc_id, text), each document with ``end_id`` after its own, into a new folder.

    Documents are in ascending doc_id order, those without an id first, rows that share an id by a hash of their text,
    by which very many of them are dealt over tasks, too. A null text is empty: the end id alone. Other columns are not
    written; no document, no shard. One range shuffle of the texts orders them; a task holds the ids of one shard.
    Texts with the content of an added token have its id, as in the library's plain call.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"part int, seq int, n_tokens long, doc_ids array<{kind}>, doc_tokens array<long>, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded, part, seq = _encoded(tokenizer), TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        held_ids = 0

        def shard() -> pa.RecordBatch:
            ids = np.concatenate([x[1] for x in held])
            doc_ids = pa.concat_arrays([x[0] for x in held])
            tokens = pa.array(np.concatenate([x[2] for x in held]))
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            row = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()), one(doc_ids), one(tokens), pa.array([compress(ids)], pa.binary())]
            return pa.RecordBatch.from_arrays(row, ["part", "seq", "n_tokens", "doc_ids", "doc_tokens", "payload"])

        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for first, last in slices(lengths, STEP_CHARS):
                ids, ends = encoded.texts(batch.column(1).slice(first, last - first).to_pylist())
                out = np.full(len(ids) + len(ends), end_id, np.uint32)
                own = np.ones(len(out), bool)
                own[ends + np.arange(len(ends))] = False
                out[own] = ids
                held.append((batch.column(0).slice(first, last - first), out, np.diff(ends, prepend=0) + 1))
                held_ids += len(out)
                if held_ids >= shard_ids:
                    yield shard()
                    held, held_ids, seq = [], 0, seq + 1
        if held:
            yield shard()

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(tasks, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    ordered.select("doc_id", "text").mapInArrow(run, schema).write.parquet(path)


def read_token_files(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files: the ids of all documents before it, its own
    with the end id, and the unsigned CRC-32 of them as little-endian 32-bit integers. Shards' first places are summed
    over all shards in one task, a row of three numbers per SHARD_IDS ids."""
    shards = spark.read.parquet(path)
    sums = shards.select("part", "seq", "n_tokens")
    before = F.sum("n_tokens").over(Window.orderBy("part", "seq")) - F.col("n_tokens")
    starts = sums.select("part", "seq", before.alias("first"))
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                first, doc_ids, tokens = batch.column(0)[i].as_py(), batch.column(1)[i].values, batch.column(2)[i].values
                tokens = tokens.to_numpy()
                data = memoryview(decompress(batch.column(3)[i].as_py()).astype("<u4").tobytes())
                ends = np.cumsum(tokens)
                cuts = (4 * np.concatenate([[0], ends])).tolist()
                crc = np.fromiter((zlib.crc32(data[a:b]) for a, b in zip(cuts, cuts[1:])), np.int64, len(tokens))
                columns = [doc_ids, pa.array(first + ends - tokens), pa.array(tokens), pa.array(crc)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = shards.join(starts, ["part", "seq"]).select("first", "doc_ids", "doc_tokens", "payload")
    return rows.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
