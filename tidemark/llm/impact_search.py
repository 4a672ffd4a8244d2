"""Ranked lexical search by sequential reads of impact-sorted lists without random access (NRA).

Documents are indexed in shards of some megabytes. A shard stores the postings of the queries' terms in columns of falling impact: the first
column holds its part of the highest impacts of the whole corpus, the next one some times as many, and so on. A round reads one more
column of every shard. A document's score then lies between the sum of what was read of it and that sum with, for each list in which it
was not met yet, the highest impact that is still unread there. A query is done when no document with an open interval reaches the
score of its last place, so that membership, order among equals and scores are all settled; the others read on, to the end of the lists if need be.

Nothing is shuffled but the best few documents of each shard and query. A round is a function of the shards alone: it reads the earlier
columns again, which together are a fraction of the new one, instead of keeping intervals of all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.blocks import texts_of
from tidemark.llm.components import stored

# Fixed values of the score: its scale, saturation, and how much a document's length counts.
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 8, 75

#: Bytes of text in a shard; a longer document has one of its own.
SHARD_BYTES = 8 << 20
#: Bytes of query texts that are searched for together; what a worker is sent of the queries is a small multiple.
QUERY_BYTES = 4 << 20
#: Postings in the first column for each query and place, and how many times as many each further column holds.
FIRST_READ, GROWTH = 25, 8
#: Steps in which impacts are counted for each doubling.
STEPS = 16

# Letters and digits of ASCII, capitals made small, and all other bytes of UTF-8; the rest separates.
_TERMS = bytes((c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERMS).split()


@dataclass
class Queries:
    """A block of queries: for each the numbers and repeats of its terms, by number."""

    ids: list
    terms: dict[bytes, int]
    wanted: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(rows: list[tuple]) -> Queries:
        counts = [Counter(terms((text or "").encode())) for _, text in rows]
        numbers = {t: k for k, t in enumerate(sorted(set().union(*counts)))}
        wanted = [(np.array([numbers[t] for t in sorted(c)], np.int64), np.array([c[t] for t in sorted(c)], np.int64)) for c in counts]
        return Queries([i for i, _ in rows], numbers, wanted)


def _packed(*columns: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns), 1)


def _opened(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, at, columns = len(raw) // sum(sizes), 0, []
    for kind, size in zip(kinds, sizes, strict=True):
        columns.append(np.frombuffer(raw, kind, n, at))
        at += n * size
    return columns


_COUNTED = "ids array<bigint>, lengths binary, postings binary, n_docs bigint, n_terms bigint, terms array<int>, df array<bigint>"


def _counted(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Shards with the lengths of their documents and the postings (document, term, times) of the queries' terms."""

    def shard(ids: list, lengths: list[int], found: list[tuple[int, int, int]]) -> pa.RecordBatch:
        postings = np.array(found, np.int32).reshape(-1, 3)
        own, df = np.unique(postings[:, 1], return_counts=True)
        columns = [
            pa.array([ids], pa.list_(pa.int64())), pa.array([_packed(np.array(lengths, np.int64))], pa.binary()), pa.array([_packed(*postings.T)], pa.binary()),
            pa.array([sum(n > 0 for n in lengths)], pa.int64()), pa.array([sum(lengths)], pa.int64()),
            pa.array([own.tolist()], pa.list_(pa.int32())), pa.array([df.tolist()], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["ids", "lengths", "postings", "n_docs", "n_terms", "terms", "df"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, found, size = [], [], [], 0
        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), texts_of(pa.Table.from_batches([batch])), strict=True):
                if ids and size + len(text) > SHARD_BYTES:
                    yield shard(ids, lengths, found)
                    ids, lengths, found, size = [], [], [], 0
                words = terms(text)
                counts = Counter(words)
                found += [(len(ids), numbers[t], counts[t]) for t in counts.keys() & numbers.keys()]
                ids.append(i)
                lengths.append(len(words))
                size += len(text)
        if ids:
            yield shard(ids, lengths, found)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(count, _COUNTED)


@dataclass
class Corpus:
    """Totals that a posting's share of a score follows from."""

    n_docs: int
    n_terms: int
    weights: np.ndarray

    def scores(self, lengths: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray) -> np.ndarray:
        norm = 100 - LENGTH_SHARE + LENGTH_SHARE * lengths * self.n_docs // self.n_terms
        tf = times.astype(np.int64)
        return self.weights[term] * (SCALE * tf // (1000 * tf + SATURATION * norm[doc]))


def _level(scores: np.ndarray) -> np.ndarray:
    return np.floor(STEPS * np.log2(np.maximum(scores, 1))).astype(np.int64)


def _levels(shards: DataFrame, corpus: Corpus) -> list[tuple[int, int]]:
    """How many postings of the corpus have each level of impact; there are a few hundred levels at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lengths, postings in zip(batch.column("lengths").to_pylist(), batch.column("postings").to_pylist(), strict=True):
                scores = corpus.scores(_opened(lengths, "i8")[0], *_opened(postings, "i4", "i4", "i4"))
                level, n = np.unique(_level(scores[scores > 0]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(level, pa.int64()), pa.array(n, pa.int64())], names=["level", "n"])

    counts = shards.select("lengths", "postings").mapInArrow(count, "level bigint, n bigint").groupBy("level").agg(F.sum("n").alias("n"))
    return [tuple(r) for r in counts.orderBy(F.desc("level")).collect()]


def _columns(levels: list[tuple[int, int]], first: int) -> list[int]:
    """The lowest level of each column: whole levels from the highest on, until a column has its fill."""
    bounds, held, room = [], 0, first
    for level, n in levels:
        held += n
        if held >= room:
            bounds.append(level)
            held, room = 0, room * GROWTH
    if held or not bounds:
        bounds.append(0)
    bounds[-1] = 0
    return bounds


def _sorted_shards(shards: DataFrame, corpus: Corpus, bounds: list[int]) -> DataFrame:
    """Each shard's postings (document, term, share of the score) in columns ``c0``, ``c1``, ... of falling impact, in a column by falling
    impact, and the highest impact of each term in each column."""
    names = [f"c{k}" for k in range(len(bounds))]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, lengths, postings in zip(*(batch.column(c).to_pylist() for c in ("ids", "lengths", "postings")), strict=True):
                doc, term, times = _opened(postings, "i4", "i4", "i4")
                scores = corpus.scores(_opened(lengths, "i8")[0], doc, term, times)
                order = np.argsort(-scores, kind="stable")
                order = order[scores[order] > 0]
                doc, term, scores = doc[order], term[order], scores[order]
                column = np.searchsorted(-np.array(bounds), -_level(scores))
                cuts = np.searchsorted(column, np.arange(len(bounds) + 1))
                parts = [_packed(doc[u:v], term[u:v], scores[u:v]) for u, v in zip(cuts[:-1], cuts[1:], strict=True)]
                _, heads = np.unique(column * (len(corpus.weights) + 1) + term, return_index=True)
                head = [{"term": int(term[h]), "part": int(column[h]), "score": int(scores[h])} for h in heads]
                columns = [pa.array([ids], pa.list_(pa.int64())), *(pa.array([p], pa.binary()) for p in parts), pa.array([head], _HEADS)]
                yield pa.RecordBatch.from_arrays(columns, names=["ids", *names, "heads"])

    schema = f"ids array<bigint>, {', '.join(f'{n} binary' for n in names)}, heads array<struct<term:int,part:int,score:bigint>>"
    return shards.select("ids", "lengths", "postings").mapInArrow(place, schema)


_HEADS = pa.list_(pa.struct([("term", pa.int32()), ("part", pa.int32()), ("score", pa.int64())]))


def _unread(index: DataFrame, n_terms: int, n_columns: int) -> np.ndarray:
    """For each column and term the highest impact beyond that column, 0 where the list ends."""
    heads = index.select(F.inline("heads")).groupBy("term", "part").agg(F.max("score").alias("score"))
    highest = np.zeros((n_columns + 1, n_terms), np.int64)
    for r in heads.collect():  # at most one for each term and column of a bounded block of queries
        highest[r["part"], r["term"]] = r["score"]
    return np.maximum.accumulate(highest[::-1], axis=0)[::-1][1:]


def intervals(wanted: tuple[np.ndarray, np.ndarray], lists: dict, unread: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of a query's score for all documents of a shard, from what was read."""
    low, met = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
    for term, times in zip(*wanted, strict=True):
        if term in lists:
            doc, scores = lists[term]
            low[doc] += times * scores
            met[doc] += times * unread[term]
    return low, low + ((wanted[1] * unread[wanted[0]]).sum() - met)


_FOUND = "item int, doc_id bigint, low bigint, high bigint, open bigint"


def _read(index: DataFrame, queries: Queries, left: dict[int, int], unread: np.ndarray, last: int, k: int) -> DataFrame:
    """One round: per shard and query of ``left`` (with the score that counts so far) the ``k`` best documents by lower bound, and in a row of its own the highest
    upper bound of a document whose interval is open."""
    names = [f"c{c}" for c in range(last + 1)]
    need = np.unique(np.concatenate([queries.wanted[item][0] for item in left]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, *parts in zip(*(batch.column(c).to_pylist() for c in ("ids", *names)), strict=True):
                doc, term, scores = (np.concatenate(c) for c in zip(*(_opened(p, "i4", "i4", "i8") for p in parts), strict=True))
                order = np.argsort(term, kind="stable")
                doc, scores, cuts = doc[order], scores[order], np.searchsorted(term[order], np.stack((need, need + 1)))
                lists = {int(t): (doc[u:v], scores[u:v]) for t, u, v in zip(need, *cuts, strict=True) if v > u}
                rank = np.array([(i is None, i or 0) for i in ids], dtype=[("null", bool), ("id", "i8")]).argsort(kind="stable").argsort(kind="stable")
                rows = []
                for item, least in left.items():
                    low, high = intervals(queries.wanted[item], lists, unread[last], len(ids))
                    unsettled = high[(high > low) & (high >= least)]
                    if len(unsettled):
                        rows.append((item, None, None, None, int(unsettled.max())))
                    best = np.flatnonzero((low > 0) & (high >= least))
                    if len(best) > k:
                        best = best[low[best] >= np.partition(low[best], len(best) - k)[len(best) - k]]
                    best = best[np.lexsort((rank[best], -low[best]))][:k]
                    rows += [(item, ids[d], int(low[d]), int(high[d]), None) for d in best]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = [pa.int32(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["item", "doc_id", "low", "high", "open"])

    return index.select("ids", *names).mapInArrow(scan, _FOUND)


def _block(docs: DataFrame, queries: Queries, k: int) -> tuple[list[DataFrame], list[int]]:
    """The results of a bounded block of queries, and how many queries each round settled."""
    spark, results, settled = docs.sparkSession, [], []
    shards = stored(_counted(docs, queries.terms), "search-counted")
    n_docs, n_terms = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    df = np.zeros(len(queries.terms), np.int64)
    for r in shards.select(F.inline(F.arrays_zip("terms", "df"))).groupBy("terms").agg(F.sum("df").alias("df")).collect():
        df[r["terms"]] = r["df"]
    if not df.any():
        return [], []
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    corpus = Corpus(n_docs, n_terms, weights)
    bounds = _columns(_levels(shards, corpus), FIRST_READ * k * len(queries.ids))
    index = stored(_sorted_shards(shards, corpus, bounds), "search-index")
    unread = _unread(index, len(weights), len(bounds))
    ids = spark.createDataFrame(list(enumerate(queries.ids)), "item int, item_id bigint")
    left = {item: 1 for item, (own, _) in enumerate(queries.wanted) if len(own)}
    for last in range(len(bounds)):
        if not left:
            break
        found = stored(_read(index, queries, left, unread, last, k), "search-round")
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("low"), F.asc_nulls_last("doc_id"), F.desc("high"))).alias("rank")
        best = found.filter("low IS NOT NULL").select("item", "doc_id", "low", place).filter(F.col("rank") <= k)
        standing = best.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("low").alias("least"))
        states = standing.join(found.groupBy("item").agg(F.max("open").alias("open")), "item", "full").collect()  # one row for each query of the block
        least = {r["item"]: r["least"] if r["n"] == k else 1 for r in states}
        open_now = {r["item"] for r in states if r["open"] is not None and r["open"] >= least[r["item"]]}
        done = [item for item in left if item not in open_now]
        settled.append(len(done))
        if done:
            chosen = spark.createDataFrame([(i,) for i in done], "item int")
            results.append(best.join(F.broadcast(chosen), "item", "left_semi").join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", F.col("low").alias("score")))
        left = {item: max(left[item], least[item]) for item in left if item in open_now}
    return results, settled


def blocks_of(items: DataFrame, query_bytes: int) -> list[DataFrame]:
    """Queries in parts by a hash of their rows, as many as it takes until none is above ``query_bytes`` or holds more than one query."""
    size, part = F.coalesce(F.octet_length("text"), F.lit(0)) + 64, F.xxhash64("item_id", "text")
    n = 1
    while True:
        sizes = items.groupBy(F.pmod(part, F.lit(n)).alias("part")).agg(F.sum(size).alias("size"), F.min(part).alias("u"), F.max(part).alias("v"))
        if sizes.filter((F.col("size") > query_bytes) & (F.col("u") < F.col("v"))).isEmpty():
            return [items.filter(F.pmod(part, F.lit(n)) == b) for b in range(n)]
        n *= 2


def search(docs: DataFrame, items: DataFrame, k: int = 10, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score`` of the ``k`` best documents of each row of ``items``, with a score above 0.

    Equal scores go by ascending ``doc_id``, a null id last. Each row of ``docs`` is a document and each row of ``items`` a query, repeated or not: copies
    take places of their own. Null, empty and blank texts have no terms; a query without terms and an empty table give no rows. Only
    ``doc_id``, ``item_id`` and ``text`` are read. Queries are searched for in blocks of ``query_bytes``, each against all documents.
    """
    given = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    results = []
    for block in blocks_of(given, query_bytes):
        rows = sorted((tuple(r) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        results += _block(docs, Queries.of(rows), k)[0] if rows else []
    whole = docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for part in results:
        whole = whole.unionByName(part)
    return whole
