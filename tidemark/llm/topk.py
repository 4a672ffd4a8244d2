"""Exact top-k by inner product over norm-sorted vectors.

Vectors are dealt into blocks by descending length. Queries first meet the longest vectors, which gives each a score to beat.
Then every block of queries meets every block of vectors that can still matter: a query passes over a block if its length times
the block's largest falls short of its score (Cauchy-Schwarz), and over a vector if the inner product of the leading
coordinates plus the lengths of the rest falls short. Coordinates are rotated by the singular vectors of all vectors, so a
few of them hold most of each length. What is left is scored exactly on the integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import blocks as B
from tidemark.llm.components import stored

VECTORS = 2048
QUERIES = 256
#: Most vector blocks that share a copy of the queries; fewer while there are cores without a group.
GROUP = 64
#: Queries whose best scores a task remembers from one block to the next.
REMEMBERED = 100_000
SCALE = 256

_PACKED = "n bigint, longest double, ids binary, rows binary, values binary"


def integers(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``row`` (a number of its own), ``v`` (floor(256 * x) of each component), ``norm``.

    Vectors that are null or hold null or non-finite components take no part, nor do rows without an id, or with components of 2^54
    and more, whose integers 64 bits do not hold. Rows with an equal id are vectors of their own.
    """
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float(2**54)))
    rows = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(fine).select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled.alias("v"))
    return rows.withColumn("row", F.monotonically_increasing_id()).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))))


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Singular vectors, from the sum of outer products: ``dims`` squared numbers, whatever the number of vectors."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column("v").to_pylist(), dims).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], names=["cell", "value"])

    cells = vectors.mapInArrow(products, "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    gram = np.zeros(dims * dims)
    for cell in cells:
        gram[cell["cell"]] = cell["value"]
    return np.linalg.eigh(gram.reshape(dims, dims))[1][:, ::-1].copy()


def _matrix(rows: list, dims: int) -> np.ndarray:
    """Vectors as rows, short ones filled up with zeros."""
    out = np.zeros((len(rows), dims), np.int64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


def _packer(size: int, dims: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                ids, values = part.column("vec_id").to_numpy(), _matrix(part.column("v").to_pylist(), dims)
                longest = float(np.max(part.column("norm").to_numpy()))
                packed = [pa.array([x.astype("<i8").tobytes()], pa.binary()) for x in (ids, part.column("row").to_numpy(), values)]
                yield pa.RecordBatch.from_arrays([pa.array([len(ids)]), pa.array([longest]), *packed], names=["n", "longest", "ids", "rows", "values"])

    return pack


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: in floating point where all sums are exact there, else in 64 bits or, beyond those, in Python's integers
    (held within the range of 64 bits)."""
    most = np.sqrt((q.astype(float) ** 2).sum(axis=1).max(initial=0)) * np.sqrt((x.astype(float) ** 2).sum(axis=1).max(initial=0))
    if most < 2.0**50:
        return np.rint(q.astype(float) @ x.T.astype(float)).astype(np.int64)
    if most < 2.0**62:
        return q @ x.T
    limits = np.iinfo(np.int64)
    return np.clip(q.astype(object) @ x.T.astype(object), limits.min, limits.max).astype(np.int64)


def top_of_block(query_rows, q, ids, rows, x, rotated, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each query its ``k`` best of a block (place of the query, ``ids``, ``rows``, score) that reach its floor.

    ``rotated`` turns the coordinates; ``floors`` are scores that ``k`` other vectors reach already (or -inf).
    """
    order = np.lexsort((rows, ids))
    ids, rows, x = ids[order], rows[order], x[order]
    lengths, own = np.sqrt((x.astype(float) ** 2).sum(axis=1)), np.sqrt((q.astype(float) ** 2).sum(axis=1))
    slack = 1e-6 * (own[:, None] * lengths[None, :] + 1)
    alive = own[:, None] * lengths[None, :] + slack >= floors[:, None]
    alive &= query_rows[:, None] != rows[None, :]
    if alive.any() and np.isfinite(floors).any():
        turned_q, turned_x, done = q @ rotated, x @ rotated, 0
        rest_q, rest_x = own**2, lengths**2
        partial = np.zeros(alive.shape)
        for upto in (max(1, x.shape[1] // 8), max(1, x.shape[1] // 3)):
            head_q, head_x = turned_q[:, done:upto], turned_x[:, done:upto]
            partial += head_q @ head_x.T
            rest_q, rest_x, done = rest_q - (head_q**2).sum(axis=1), rest_x - (head_x**2).sum(axis=1), upto
            bound = partial + np.sqrt(np.maximum(rest_q, 0))[:, None] * np.sqrt(np.maximum(rest_x, 0))[None, :]
            alive &= bound + slack >= floors[:, None]
    columns, asking = np.flatnonzero(alive.any(axis=0)), np.flatnonzero(alive.any(axis=1))
    if not len(asking):
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty
    alive = alive[np.ix_(asking, columns)]
    scores = exact_scores(q[asking], x[columns])
    alive &= scores >= floors[asking][:, None]
    found = []
    for i in range(len(asking)):
        at = np.flatnonzero(alive[i])
        best = at[np.lexsort((at, -scores[i, at]))[:k]]
        found.append((np.full(len(best), asking[i]), ids[columns[best]], rows[columns[best]], scores[i, best]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _read(row: dict, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["rows"], "<i8"), np.frombuffer(row["values"], "<i8").reshape(-1, dims)


def top_k(vectors: DataFrame, query_filter: str, k: int = 5) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` largest integer inner products of each query.

    Queries are the vectors that ``query_filter`` selects; candidates are all rows but the query's own. Rows that share an id are
    candidates, and queries, each for itself. Ties go to the smaller ``vec_id``; with fewer than ``k`` candidates all are returned. Vectors of different lengths are compared as
    if the shorter one went on with zeros. Which vectors take part: see :func:`integers`. An empty table gives an empty result.
    """
    found = stored(integers(vectors.select("vec_id", "embedding")), "vectors")
    n, dims = found.agg(F.count("*"), F.max(F.size("v"))).first()
    dims = max(1, dims or 0)
    turned = rotation(found, dims)
    longest = found.orderBy(F.desc("norm"), "vec_id", "row").limit(VECTORS).mapInArrow(_packer(VECTORS, dims), _PACKED).collect()
    head = [_read(row.asDict(), dims) for row in longest]

    def with_floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, query_rows, q = _read(row, dims)
                floors = np.full(len(q), -np.inf)
                scores = [np.where(query_rows[:, None] == rows[None, :], -np.inf, exact_scores(q, x)) for _, rows, x in head]
                if scores and (scores := np.concatenate(scores, axis=1)).shape[1] >= k:
                    floors = np.sort(scores, axis=1)[:, -k]
                packed = [pa.array([b], pa.binary()) for b in (row["ids"], row["rows"], row["values"], floors.tobytes())]
                yield pa.RecordBatch.from_arrays(packed, names=["query_ids", "query_rows", "q", "floors"])

    n_blocks = B.parts(n, VECTORS)
    groups = max(B.parts(n_blocks, GROUP), min(n_blocks, 2 * vectors.sparkSession.sparkContext.defaultParallelism))
    blocks = found.repartitionByRange(n_blocks, F.desc("norm"), "vec_id", "row").sortWithinPartitions(F.desc("norm"), "vec_id", "row").mapInArrow(_packer(VECTORS, dims), _PACKED)
    blocks = blocks.withColumn("group", F.pmod(F.xxhash64("rows"), F.lit(groups)))
    queries = found.where(query_filter).repartition(B.parts(n, 50 * QUERIES), "row").mapInArrow(_packer(QUERIES, dims), _PACKED).mapInArrow(with_floors, "query_ids binary, query_rows binary, q binary, floors binary")
    queries = queries.withColumn("group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))
    pairs = queries.join(blocks, "group").select("query_ids", "query_rows", "q", "floors", "ids", "rows", "values")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                query_ids, query_rows = (np.frombuffer(row[c], "<i8") for c in ("query_ids", "query_rows"))
                q = np.frombuffer(row["q"], "<i8").reshape(-1, dims)
                ids, rows, x = _read(row, dims)
                floors = np.frombuffer(row["floors"], float).copy()
                for i, one in enumerate(query_rows.tolist()):
                    if len(known := best.get(one, ())) == k:
                        floors[i] = max(floors[i], known[0])
                which, vec_ids, vec_rows, scores = top_of_block(query_rows, q, ids, rows, x, turned, floors, k)
                if len(best) > REMEMBERED:
                    best = {}
                for i in np.unique(which).tolist():
                    one = int(query_rows[i])
                    best[one] = np.sort(np.concatenate((best.get(one, np.empty(0)), scores[which == i])))[-k:]
                columns = [query_ids[which], query_rows[which], vec_ids, vec_rows, scores]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "query_row", "vec_id", "vec_row", "score"])

    scored = pairs.mapInArrow(search, "query_id bigint, query_row bigint, vec_id bigint, vec_row bigint, score bigint")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
