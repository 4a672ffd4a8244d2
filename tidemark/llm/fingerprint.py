"""Document fingerprints: homomorphic multiset hashes of paragraphs.

A fingerprint is the sum of vectors, one for each paragraph (line), so it does not depend on their order, and paragraphs are
inserted or deleted by adding or subtracting their vectors. It has two parts:

- ``LANES`` sums modulo 2^64 of evenly distributed values, one vector for each paragraph: equality of the multisets;
- ``SIGNS`` sums modulo 2^32 of +1 or -1, one vector for each piece of a paragraph: for two fingerprints the mean square of their
  difference estimates how many pieces they do not share (standard error about 1/sqrt(SIGNS / 2)). A paragraph is cut by its content,
  where a hash of the last ``LOOK`` bytes says so, into pieces of ``PIECE`` bytes on average, so a letter put in changes the pieces around it only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import blocks as B

LANES = 16
SIGNS = 128
PIECE = 32
LOOK = 6
#: Most ranges of ids to deal documents out by. Beyond it ranges grow; tasks stream them in order and hold two documents at a time.
MOST_RANGES = 10_000

RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

_LANE = B.mixed(np.arange(1, LANES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

Vectors = tuple[np.ndarray, np.ndarray]


def pieces(line: bytes) -> list[bytes]:
    """A paragraph cut by its content; where to cut depends on the ``LOOK`` bytes before, fewer at the start."""
    values = np.frombuffer(line, np.uint8).astype(np.uint32) + np.uint32(1)
    seen = np.zeros(len(values), np.uint32)
    for k in range(min(LOOK, len(values))):
        seen[k:] = seen[k:] + values[: len(values) - k] * np.uint32((0x9E3779B1 * (2 * k + 1) ** 5) & 0xFFFFFFFF)
    seen = (seen ^ (seen >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    cuts = [0, *(np.flatnonzero((seen >> np.uint32(16)) % PIECE == 0) + 1).tolist()]
    return [line[a:b] for a, b in zip(cuts, [*cuts[1:], len(line)], strict=True) if a < b]


def vectors(text: bytes) -> Vectors:
    """Both sums for a text; zero for an empty one."""
    even, signed = np.zeros(LANES, np.uint64), np.zeros(SIGNS, np.int64)
    if not text:
        return even, signed.astype(np.uint32)
    lines = text.split(b"\n")
    for start in range(0, len(lines), 4096):
        ids = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines[start : start + 4096])), np.uint64).reshape(-1, 2)
        even += B.mixed((ids[:, :1] ^ _LANE) + B.mixed(ids[:, 1:] + _LANE)).sum(axis=0, dtype=np.uint64)
    cut = [piece for line in lines for piece in pieces(line)]
    for start in range(0, len(cut), 4096):
        bits = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, cut[start : start + 4096])), np.uint8).reshape(-1, SIGNS // 8)
        signed += 2 * np.unpackbits(bits, axis=1).sum(axis=0, dtype=np.int64) - len(bits)
    return even, signed.astype(np.uint32)


def added(one: Vectors, other: Vectors) -> Vectors:
    """The fingerprint of both texts' paragraphs together."""
    return one[0] + other[0], one[1] + other[1]


def removed(one: Vectors, other: Vectors) -> Vectors:
    """The fingerprint of one text's paragraphs without the other's."""
    return one[0] - other[0], one[1] - other[1]


def text_form(of: Vectors) -> str:
    return of[0].astype("<u8").tobytes().hex() + of[1].astype("<u4").tobytes().hex()


def likeness(one: Vectors, other: Vectors) -> float:
    """Estimated share of pieces in common, 0 to 1; 1 for equal fingerprints only."""
    if all(np.array_equal(a, b) for a, b in zip(one, other, strict=True)):
        return 1.0
    a, b, apart = ((x.astype(np.int32).astype(float) ** 2).sum() for x in (one[1], other[1], one[1] - other[1]))
    return float(min(max(1 - apart / (a + b), 0.0), 0.999999)) if a + b else 0.0


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in order, each followed by the next one; the last of a range by a copy of the next range's first (``guest``)."""
    names = [field.split(" ")[0] for field in RESULT.split(", ")]
    before = None
    for batch in batches:
        rows = []
        for span, guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("span", "guest", "doc_id", "text")), strict=True):
            text = text or ""
            current = (span, guest, doc_id, text, vectors(text.encode()))
            if before is not None and before[0] == span and not before[1]:
                _, _, own_id, own, own_vectors = before
                half = len(own) // 2
                edited = (own[: len(own) - half] + text[:half]).encode()
                edited_vectors = vectors(edited)
                rows.append((own_id, len(own), hashlib.sha256(edited).hexdigest(), text_form(own_vectors), text_form(edited_vectors), likeness(own_vectors, edited_vectors), likeness(own_vectors, current[4])))
            before = current
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) if i else pa.array(c, pa.int64()) for i, c in enumerate(zip(*rows, strict=True))], names=names)


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next document.

    The edited text has its last floor(n_chars / 2) code points replaced by as many of the first (or all) of the next document by
    ascending ``doc_id``; the last document is followed by the first, a single one by itself. Null texts count as empty. Rows
    with an equal ``doc_id`` are ordered by text, null ids come first. Only ``doc_id`` and ``text`` are read; an empty table
    gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = min(B.parts(B.text_bytes(docs), B.BLOCK_BYTES), MOST_RANGES)
    bounds = docs.select(F.col("doc_id").cast("double").alias("at")).approxQuantile("at", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    dealt = Bucketizer(splits=splits if len(splits) > 2 else [float("-inf"), 0.0, float("inf")], inputCol="at", outputCol="span").transform(docs.withColumn("at", place))
    dealt = dealt.select(F.col("span").cast("int").alias("span"), F.lit(False).alias("guest"), "doc_id", "text")
    heads = dealt.groupBy("span").agg(F.min(F.struct("doc_id", "text")).alias("head"))
    in_order = Window.partitionBy().orderBy("span")  # one row for each range
    previous = F.coalesce(F.lag("span").over(in_order), F.max("span").over(Window.partitionBy()))
    guests = heads.select(previous.alias("span"), F.lit(True).alias("guest"), "head.doc_id", "head.text")
    rows = dealt.unionByName(guests).repartition(n, "span").sortWithinPartitions("span", "guest", "doc_id", "text")
    return rows.mapInArrow(_compared, RESULT)
