"""Documents in blocks, and questions that blocks put to the whole corpus.

A block is some megabytes of documents that one Python call sees together. What a block has to know about the rest of
the corpus (is this n-gram elsewhere too, how often does this word occur) it asks in packed form: one payload for each
of many buckets, in which a key stands once however often the block holds it. The bucket sees the payloads of all blocks
and answers each block. So a key that a third of all rows hold reaches its bucket once for each block, not once for each row,
buckets are even because keys are hashes, and neither side ever holds more than one block or one bucket.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a block. There are as many buckets as blocks: both sides of a pass over blocks and their answers are then
#: dealt out alike.
BLOCK_BYTES = 4 << 20

_SHORT = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: one narrow aggregate, by which blocks and buckets are numbered."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def parts(total: int, each: int) -> int:
    return max(1, math.ceil(total / each))


_CHUNK = "block bigint, ids array<bigint>, sizes array<int>, data binary"


def in_blocks(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id`` and ``text`` dealt out by ``n`` blocks once, as compressed chunks; :func:`per_block` opens them.

    The block follows from the row's id and text alone, so a task that is run again rebuilds the same blocks, and every pass over the
    blocks reads the same exchange. Rows without an id, or with one id, are dealt out by their texts; only equal rows share a block.
    """

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            blocks, ids, texts = batch.column("block").to_numpy(), batch.column("doc_id"), pc.cast(batch.column("text"), pa.large_binary())
            order = np.argsort(blocks, kind="stable")
            cuts = np.flatnonzero(np.diff(blocks[order], prepend=-1, append=n))
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                rows = pa.array(order[start:end])
                own = pc.fill_null(texts.take(rows), b"")
                ends = np.frombuffer(own.buffers()[1], np.int64)[own.offset : own.offset + len(own) + 1]
                data = compressor.compress(own.buffers()[2].slice(ends[0], ends[-1] - ends[0])) if ends[-1] > ends[0] else compressor.compress(b"")
                columns = [
                    pa.array([blocks[order[start]]], pa.int64()),
                    pa.array([ids.take(rows).to_pylist()], pa.list_(pa.int64())),
                    pa.array([np.diff(ends).astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([data], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "sizes", "data"])
            pa.default_memory_pool().release_unused()

    placed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).alias("block"))
    return placed.mapInArrow(chunks, _CHUNK).repartition(n, "block")


def opened_chunks(chunks: pa.Table) -> pa.Table:
    """A block's documents: ``block``, ``doc_id``, ``text`` (bytes)."""
    ids, texts, decompressor = [], [], zstandard.ZstdDecompressor()
    for own, sizes, data in zip(*(chunks.column(c).to_pylist() for c in ("ids", "sizes", "data")), strict=True):
        whole, at = decompressor.decompress(data), 0
        for size in sizes:
            texts.append(whole[at : at + size])
            at += size
        ids += own
    block = chunks.column("block")[0].as_py() if chunks.num_rows else None
    pa.default_memory_pool().release_unused()
    return pa.table([pa.array([block] * len(ids), pa.int64()), pa.array(ids, pa.int64()), pa.array(texts, pa.large_binary())], names=["block", "doc_id", "text"])


ANSWER = "block bigint, tag string, bucket int, payload binary"
_ANSWER_NAMES = ["block", "tag", "bucket", "payload"]

#: What a block asks: its documents and the answers it has so far, by tag and bucket.
Request = Callable[[pa.Table, dict[str, dict[int, bytes]]], Iterable[tuple[int, bytes]]]
#: What a bucket answers: its number and the payloads of the blocks, to answers for blocks.
Reduce = Callable[[int, list[tuple[int, bytes]]], Iterable[tuple[int, bytes]]]


def _table(blocks: list[int], tag: str, buckets: list[int], payloads: list[bytes]) -> pa.Table:
    columns = [pa.array(blocks, pa.int64()), pa.array([tag] * len(blocks), pa.string()), pa.array(buckets, pa.int32()), pa.array(payloads, pa.binary())]
    return pa.table(columns, names=_ANSWER_NAMES)


def answers_of(table: pa.Table) -> dict[str, dict[int, bytes]]:
    found: dict[str, dict[int, bytes]] = {}
    for tag, bucket, payload in zip(*(table.column(c).to_pylist() for c in ("tag", "bucket", "payload")), strict=True):
        found.setdefault(tag, {})[bucket] = payload
    return found


def per_block(blocks: DataFrame, answers: DataFrame | None, function, schema: str, opened: Callable = opened_chunks) -> DataFrame:
    """``function(docs, answers)`` for each block, returning an Arrow table; ``opened`` makes ``docs`` of the block's rows."""
    if answers is None:
        return blocks.groupBy("block").applyInArrow(lambda rows: function(opened(rows), {}), schema)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda rows, own: function(opened(rows), answers_of(own)), schema)


def ask(blocks: DataFrame, answers: DataFrame | None, tag: str, request: Request, reduce: Reduce, n_buckets: int, opened: Callable = opened_chunks) -> DataFrame:
    """Put each block's requests to the buckets; the answers, together with the earlier ones.

    New answers are dealt out by block at once, so that all later passes read one exchange instead of reducing again.
    """

    def asked(rows: pa.Table) -> Callable[[dict], pa.Table]:
        block = rows.column("block")[0].as_py() if rows.num_rows else None

        def with_answers(so_far: dict) -> pa.Table:
            sent = [(bucket, payload) for bucket, payload in request(opened(rows), so_far) if payload] if rows.num_rows else []
            return _table([block] * len(sent), tag, [b for b, _ in sent], [p for _, p in sent])

        return with_answers

    def answered(payloads: pa.Table) -> pa.Table:
        bucket = payloads.column("bucket")[0].as_py()
        given = sorted(zip(payloads.column("block").to_pylist(), payloads.column("payload").to_pylist(), strict=True))
        sent = list(reduce(bucket, given))
        return _table([b for b, _ in sent], tag, [bucket] * len(sent), [p for _, p in sent])

    if answers is None:
        requests = blocks.groupBy("block").applyInArrow(lambda rows: asked(rows)({}), ANSWER)
    else:
        requests = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda rows, own: asked(rows)(answers_of(own)), ANSWER)
    new = requests.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(answered, ANSWER).repartition(n_buckets, "block")
    return new if answers is None else answers.unionByName(new)


# Words, as bytes: bytes.split() cuts at just the white space of ASCII, and bytes.lower() changes A-Z only.


def texts_of(table: pa.Table, column: str = "text") -> list[bytes]:
    """UTF-8 of every text, an empty one for null."""
    return [t or b"" for t in pc.cast(table.column(column), pa.large_binary()).to_pylist()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """An even spread over 64 bits (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_STEP = 0x9E3779B97F4A7C15 | 1


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash for the ``n`` words that start at each position."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        total = total * np.uint64(_STEP) + h[k : len(h) - n + 1 + k]
    return mixed(total + np.uint64(n))


# Packed tables of numbers, ordered by key. A bucket is a range of hash values, so it is a slice of sorted keys.


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    return (((keys >> _HALF) * np.uint64(n_buckets)) >> _HALF).astype(np.int64)


def short_keys(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Keys of which 32 bits are sent: bucket and lower half. Buckets grow in number with the corpus, so the odds that two
    keys meet stay the same; fit only for finding candidates."""
    return (bucket_of(keys, n_buckets).astype(np.uint64) << _HALF) | (keys & _SHORT)


def pack(columns: list[np.ndarray]) -> bytes:
    return b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def unpack(payload: bytes, kinds: list) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, at, columns = len(payload) // sum(sizes), 0, []
    for kind, size in zip(kinds, sizes, strict=True):
        columns.append(np.frombuffer(payload, kind, n, at))
        at += n * size
    return columns


def packed_by_bucket(keys: np.ndarray, columns: list[np.ndarray], n_buckets: int, buckets: np.ndarray) -> Iterable[tuple[int, bytes]]:
    """Payloads for sorted keys; ``buckets`` are the keys' buckets, ``columns`` what is sent (the key included)."""
    if len(keys):
        cuts = np.flatnonzero(np.diff(buckets, prepend=-1, append=n_buckets))
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(buckets[start]), pack([c[start:end] for c in columns])


def gathered(given: list[tuple[int, bytes]], kinds: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """The payloads of a bucket end to end: the place of each entry's block in ``given``, and the columns."""
    unpacked = [unpack(p, kinds) for _, p in given]
    place = np.repeat(np.arange(len(given)), [len(u[0]) for u in unpacked])
    return place, [np.concatenate(c) for c in zip(*unpacked, strict=True)]


def returned(given: list[tuple[int, bytes]], place: np.ndarray, keep: np.ndarray, columns: list[np.ndarray]) -> Iterable[tuple[int, bytes]]:
    """One payload for each block with entries to keep, in their order."""
    ends = np.cumsum(np.bincount(place, minlength=len(given)))
    start = 0
    for (block, _), end in zip(given, ends, strict=True):
        mask = keep[start:end]
        if mask.any():
            yield block, pack([c[start:end][mask] for c in columns])
        start = end


def merged(own: dict[int, bytes] | None, kinds: list, short: bool = False) -> list[np.ndarray]:
    """A block's answers end to end, by ascending key (the first column)."""
    if not own:
        return [np.empty(0, np.uint64 if i == 0 else k) for i, k in enumerate(kinds)]
    columns = []
    for bucket in sorted(own):
        unpacked = unpack(own[bucket], kinds)
        if short:
            unpacked[0] = (np.uint64(bucket) << _HALF) | unpacked[0].astype(np.uint64)
        columns.append(unpacked)
    return [np.concatenate(c) for c in zip(*columns, strict=True)]


def found_in(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is among sorted ones, and where."""
    if not len(among):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return among[at] == keys, at
