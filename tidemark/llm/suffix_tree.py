"""Scoring texts with a probabilistic suffix tree.

States are contexts, the last 0 to ``DEPTH`` words. The root's distribution is the smoothed frequency of words; a longer context's is

    p(w | s) = (count(s w) + STRENGTH * p(w | s without its first word)) / (count(s) + STRENGTH).

A context is tried if it occurs ``MIN_COUNT`` times, and retained if its next words diverge enough from what its parent state
says: the counts times the logarithm of the ratio of both have to exceed what it costs to name each distinct next word once under the
parent. Words that follow a context by chance, once each, so never retain it, and a frequent context whose followers are just
the frequent words is no state either. A token is scored by its longest retained context.

Counts cover all learning documents. Documents are coded in blocks, and blocks ask buckets for counts, level by level (see
:mod:`tidemark.llm.blocks`); keys are 64-bit hashes of word sequences, so no bucket is larger than others however frequent a word is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame

from tidemark.llm import blocks as B

DEPTH = 2
MIN_COUNT = 8
STRENGTH = 4.0
#: Bytes of text in a block.
EACH = 6 << 20

_CODED = "block bigint, ids array<bigint>, learn array<boolean>, sizes array<int>, words binary, codes binary"
RESULT = "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
_END = B.word_hashes([b""])


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents as codes: ``words`` are the hashes of the block's words, the most frequent first, ``codes`` places
    among them, their lowest bytes first and then the next, which compresses well."""
    compressor, number, held = zstandard.ZstdCompressor(level=3), 0, []

    def block() -> pa.RecordBatch:
        ids, learn, hashes = zip(*held, strict=True)
        words, codes, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        words, codes = words[order], rank[codes]
        key = (TaskContext.get().partitionId() << 24) + number
        packed = [compressor.compress(words.tobytes()), compressor.compress(codes.view(np.uint8).reshape(-1, 4).T.tobytes())]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        values = [key, list(ids), list(learn), [len(h) for h in hashes], *packed]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=[c.split(" ")[0] for c in _CODED.split(", ")])

    size = 0
    for batch in batches:
        for doc_id, learn, text in zip(batch.column("doc_id").to_pylist(), batch.column("learn").to_pylist(), B.texts_of(pa.Table.from_batches([batch])), strict=True):
            held.append((doc_id, bool(learn), np.concatenate((B.word_hashes(text.lower().split()), _END))))
            size += len(text) + 1
            if size >= EACH:
                yield block()
                number, held, size = number + 1, [], 0
    if held:
        yield block()


class Block:
    """A coded block, token by token; the end of a text is a token."""

    def __init__(self, rows: pa.Table):
        row, unzip = rows.slice(0, 1).to_pylist()[0], zstandard.ZstdDecompressor().decompress
        self.ids, self.sizes = row["ids"], np.array(row["sizes"], np.int64)
        words = np.frombuffer(unzip(row["words"]), np.uint64)
        order = np.argsort(words)
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order))
        self.words = words[order]
        self.codes = place[np.frombuffer(unzip(row["codes"]), np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()]
        self.learn = np.repeat(np.array(row["learn"], bool), self.sizes)
        starts = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(self.codes)) - np.repeat(starts, self.sizes)
        self.starts = starts


# Payloads whose columns are cut into their bytes, the lowest of all values first, and compressed where that helps: small counts take some
# bits. Sorted keys are sent as the steps of their high bits and their low bits. Answers are aligned with requests, so they hold no keys.

#: Bits of a pair's key that are sent besides its bucket, and low bits of pairs' and of whole keys that are sent as they are.
PAIR_BITS = 40
LOW_BITS = {True: 24, False: 40}


def narrow(columns: list[np.ndarray]) -> bytes:
    n, compressor, out = len(columns[0]), zstandard.ZstdCompressor(level=1), []
    for c in columns:
        width = (int(c.max(initial=0)).bit_length() + 7) // 8 if c.dtype.kind == "u" else c.dtype.itemsize
        c = c.astype(np.uint64) if c.dtype.kind == "u" else c
        data = c.view(np.uint8).reshape(n, c.dtype.itemsize).T[:width].tobytes()
        small = compressor.compress(data)
        packed = len(small) < len(data)
        data = small if packed else data
        out.append(np.array([ord(c.dtype.char), width, packed, len(data)], np.uint32).tobytes() + data)
    return np.uint32(n).tobytes() + b"".join(out)


def widened(payload: bytes, n_columns: int) -> list[np.ndarray]:
    n, at, columns = int(np.frombuffer(payload, np.uint32, 1)[0]), 4, []
    for _ in range(n_columns):
        kind, width, packed, size = (int(x) for x in np.frombuffer(payload, np.uint32, 4, at))
        kind, data = np.dtype(chr(kind)), payload[at + 16 : at + 16 + size]
        data = zstandard.ZstdDecompressor().decompress(data) if packed else data
        own = np.zeros((n, kind.itemsize), np.uint8)
        own[:, :width] = np.frombuffer(data, np.uint8).reshape(width, n).T
        columns.append(own.view(kind).ravel())
        at += 16 + size
    return columns


def _placed(keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of pairs, and ``PAIR_BITS`` of each pair's place in its bucket, in the order of the keys."""
    bits = n_buckets.bit_length()
    scaled, rest = (keys >> np.uint64(bits)) * np.uint64(n_buckets), 64 - bits
    place = (scaled & np.uint64((1 << rest) - 1)) >> np.uint64(max(0, rest - PAIR_BITS))
    return (scaled >> np.uint64(rest)).astype(np.int64), place


def _sent(keys: np.ndarray, columns: list[np.ndarray], n_buckets: int, short: bool) -> Iterator[tuple[int, bytes]]:
    """Requests for sorted keys: whole, or, for pairs, ``PAIR_BITS`` besides the bucket."""
    buckets, keys = _placed(keys, n_buckets) if short else (B.bucket_of(keys, n_buckets), keys)
    cuts, low = np.flatnonzero(np.diff(buckets, prepend=-1, append=n_buckets)), np.uint64(LOW_BITS[short])
    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        own = keys[start:end]
        yield int(buckets[start]), narrow([np.diff(own >> low, prepend=np.uint64(0)), own & ((np.uint64(1) << low) - np.uint64(1)), *(c[start:end] for c in columns)])


def _received(given: list[tuple[int, bytes]], n_columns: int, short: bool) -> tuple[np.ndarray, list[np.ndarray]]:
    """The requests of a bucket end to end: number of entries of each block, and columns, the keys first."""
    tables = []
    for _, payload in given:
        steps, low, *rest = widened(payload, n_columns + 2)
        tables.append([(np.cumsum(steps, dtype=np.uint64) << np.uint64(LOW_BITS[short])) | low, *rest])
    return np.array([len(t[0]) for t in tables]), [np.concatenate(c) for c in zip(*tables, strict=True)]


def _back(given: list[tuple[int, bytes]], sizes: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    ends = np.cumsum(sizes)
    for (block, _), start, end in zip(given, ends - sizes, ends, strict=True):
        yield block, narrow([c[start:end] for c in columns])


def _aligned(own: dict[int, bytes] | None, n_columns: int) -> list[np.ndarray]:
    """Answers in the order of the requests."""
    tables = [widened(own[b], n_columns) for b in sorted(own or {})]
    return [np.concatenate(c) for c in zip(*tables, strict=True)] if tables else [np.empty(0, np.uint64) for _ in range(n_columns)]


class Level:
    """The tokens of a block whose context of ``depth`` words is frequent enough, and their distinct (context, token) pairs."""

    def __init__(self, block: Block, depth: int, context_counts: np.ndarray, n_buckets: int):
        hashes = block.words[block.codes]
        self.at = np.flatnonzero((block.place >= depth) & (context_counts >= MIN_COUNT))
        grams, contexts = B.ngram_hashes(hashes, depth + 1), B.ngram_hashes(hashes, depth)
        keys = grams[self.at - depth]
        order = np.argsort(keys)
        ranked = keys[order]
        new = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(ranked) else np.empty(0, np.int64)
        self.keys, self.first = ranked[new], self.at[order[new]]  # the pairs, and a token of each
        self.pair = np.empty(len(keys), np.int64)
        self.pair[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(ranked))))
        self.counts = np.bincount(self.pair, block.learn[self.at], len(new)).astype(np.uint64)
        self.contexts, self.context = np.unique(contexts[self.first - depth], return_inverse=True)


class State:
    """What a block knows after some levels: each token's probability, and the count of the context that ends with it."""

    def __init__(self, block: Block, answers: dict):
        own = answers["0"]
        counts = _aligned({bucket: payload[16:] for bucket, payload in own.items()}, 1)[0]
        tokens, words = (int(n) for n in sum(np.frombuffer(payload, np.uint64, 2) for payload in own.values()))
        self.tokens = tokens
        self.known = counts[block.codes] if len(counts) else np.zeros(len(block.codes), np.uint64)
        self.base = (self.known.astype(float) + 1) / (tokens + words + 1)
        self.p, self.ending = self.base.copy(), self.known.astype(float)

    def context_counts(self) -> np.ndarray:
        """For each token the count of the context in front of it, one word longer than the last level's."""
        return np.concatenate(([0.0], self.ending[:-1]))

    def climb(self, level: Level, answers: dict, depth: int) -> None:
        counts = _aligned(answers.get(f"pairs {depth}"), 2)[0].astype(float)
        retained = _aligned(answers.get(f"contexts {depth}"), 1)[0] > 0
        in_front = self.context_counts()[level.at]
        own = counts[level.pair] if len(counts) else np.zeros(len(level.at))
        p = (own + STRENGTH * self.p[level.at]) / (in_front + STRENGTH)
        state = retained[level.context][level.pair] if len(retained) else np.zeros(len(level.at), bool)
        self.p[level.at[state]] = p[state]
        self.ending = np.zeros(len(self.p))
        self.ending[level.at] = own


def score(docs: DataFrame, learn: Column) -> DataFrame:
    """Per document: ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``, base-10 logarithms of probabilities.

    Texts are lower-cased (A-Z) and cut at ASCII white space; one end token follows, so null, empty and blank texts have a single
    token. ``learn`` says of a row whether the tree learns from it (null: no). ``base_score`` is that of the root alone. Only ``doc_id``,
    ``text`` and what ``learn`` names are read; rows with equal or null ids are documents of their own. If nothing is learnt from, all
    probabilities are 1. An empty table gives an empty result.
    """
    n_buckets = B.parts(B.text_bytes(docs), EACH)
    blocks = docs.select("doc_id", "text", learn.alias("learn")).mapInArrow(_coded, _CODED).repartition(n_buckets, "block")

    def ask_words(block: Block, _) -> Iterator[tuple[int, bytes]]:
        asked = dict(_sent(block.words, [np.bincount(block.codes, block.learn, len(block.words)).astype(np.uint64)], n_buckets, False))
        nothing = narrow([np.empty(0, np.uint64)] * 3)
        return ((bucket, asked.get(bucket, nothing)) for bucket in range(n_buckets))  # each answers with its totals

    def count_words(bucket: int, given: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        sizes, (keys, counts) = _received(given, 1, False)
        distinct, where = np.unique(keys, return_inverse=True)
        sums = np.bincount(where, counts, len(distinct)).astype(np.uint64)
        totals = np.array([sums.sum(), (sums > 0).sum()], np.uint64).tobytes()
        for block, counted in _back(given, sizes, [sums[where]]):
            yield block, totals + counted

    answers = B.ask(blocks, None, "0", ask_words, count_words, n_buckets, Block)
    def climbed(block: Block, so_far: dict, upto: int) -> tuple[State, Level | None]:
        """The block's state below level ``upto``, and that level."""
        state = State(block, so_far)
        for depth in range(1, upto + 1):
            level = Level(block, depth, state.context_counts(), n_buckets)
            if depth == upto:
                return state, level
            state.climb(level, so_far, depth)
        return state, None

    def asking_pairs(depth: int):
        def ask_pairs(block: Block, so_far: dict) -> Iterator[tuple[int, bytes]]:
            _, level = climbed(block, so_far, depth)
            return _sent(level.keys, [level.counts], n_buckets, True)

        return ask_pairs

    def count_pairs(_, given: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        sizes, (keys, counts) = _received(given, 1, True)
        order = np.argsort(keys, kind="stable")  # the blocks' keys are sorted
        ranked, of = keys[order], counts[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        group, sums = np.cumsum(new) - 1, np.empty(len(keys), np.uint64)
        sums[order] = np.add.reduceat(of, np.flatnonzero(new))[group]
        learnt = np.flatnonzero(of > 0)
        owner = np.zeros(len(keys), np.uint64)  # one block for each pair reports it to its context
        owner[order[learnt[np.diff(group[learnt], prepend=-1) > 0]]] = 1
        yield from _back(given, sizes, [sums, owner])

    def asking_contexts(depth: int):
        def ask_contexts(block: Block, so_far: dict) -> Iterator[tuple[int, bytes]]:
            state, level = climbed(block, so_far, depth)
            counts, owner = _aligned(so_far.get(f"pairs {depth}"), 2)
            if not len(counts):
                return iter(())
            c, told = counts.astype(float), (owner > 0) & (counts > 1)
            gain = np.where(told, c * np.log(np.maximum(c, 1)) - (c - 1) * np.log(state.p[level.first]), 0.0)
            gains = np.bincount(level.context, gain, len(level.contexts)).astype(np.float32)
            sizes = np.zeros(len(level.contexts), np.uint64)
            sizes[level.context] = state.context_counts()[level.first].astype(np.uint64)
            sizes[gains == 0] = 0  # whoever reports a gain tells the size too
            return _sent(level.contexts, [sizes, gains], n_buckets, False)

        return ask_contexts

    def test_contexts(_, given: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        sizes, (keys, counts, gains) = _received(given, 2, False)
        distinct, where = np.unique(keys, return_inverse=True)
        n, told = np.ones(len(distinct)), counts > 0
        n[where[told]] = counts[told]
        retained = np.bincount(where, gains.astype(float), len(distinct)) > n * np.log(n)
        yield from _back(given, sizes, [retained[where].astype(np.uint64)])

    for depth in range(1, DEPTH + 1):
        answers = B.ask(blocks, answers, f"pairs {depth}", asking_pairs(depth), count_pairs, n_buckets, Block)
        answers = B.ask(blocks, answers, f"contexts {depth}", asking_contexts(depth), test_contexts, n_buckets, Block)

    def scored(block: Block, so_far: dict) -> pa.Table:
        state, level = climbed(block, so_far, DEPTH)
        state.climb(level, so_far, DEPTH)
        sums = [np.add.reduceat(x, block.starts) for x in ((state.known > 0).astype(np.int64), np.log10(state.base), np.log10(state.p))]
        columns = [pa.array(block.ids, pa.int64()), pa.array(block.sizes), pa.array(sums[0]), pa.array(np.full(len(block.ids), state.tokens, np.int64)), pa.array(sums[1]), pa.array(sums[2])]
        return pa.table(columns, names=[c.split(" ")[0] for c in RESULT.split(", ")])

    return B.per_block(blocks, answers, scored, RESULT, Block)
