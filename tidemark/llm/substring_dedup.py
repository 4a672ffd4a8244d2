"""Substring dedup by difference-cover anchors.

A run of ``window`` words that stands in two documents is found without comparing all windows. Positions whose remainder
modulo a period lies in a difference cover are anchors: for any two positions there is a shift below the period that takes
both to anchor positions. With a period of 7, the cover {0, 1, 3} and anchors of 7 words, any two equal windows of 13
words hold an equal anchor at anchor positions of both. So only 3 of 7 positions are hashed and sent; windows
around anchors that other documents share are then extended to their full length and settled by 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import blocks as B

#: Difference covers by period: every remainder is a difference of two members.
COVERS = {1: (0,), 2: (0, 1), 3: (0, 1), 4: (0, 1, 2), 5: (0, 1, 2), 6: (0, 1, 3), 7: (0, 1, 3)}
WINDOW = 13

RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string, text_sha256 string"


def period_of(window: int) -> int:
    """Largest period up to 7 that leaves anchors at least as long as the period (a window has period - 1 + anchor words)."""
    return max(p for p in COVERS if window - p + 1 >= min(p, window))


def _hashes(docs: pa.Table) -> list[np.ndarray]:
    return [B.word_hashes(t.split()) for t in B.texts_of(docs)]


def _anchors(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of a document's anchors; none if it is shorter than a window."""
    period = period_of(window)
    if len(h) < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = B.ngram_hashes(h, window - period + 1)
    at = np.flatnonzero(np.isin(np.arange(len(grams)) % period, COVERS[period]))
    return at, grams[at]


def _firsts(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, each with its smallest and largest id."""
    if not len(keys):
        return keys, ids, ids
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[start], ids[start], ids[np.concatenate((start[1:], [len(keys)])) - 1]


def _ids(docs: pa.Table) -> np.ndarray:
    """Ids to compare; a document without an id comes after all others and so loses what it shares."""
    return np.array([np.iinfo(np.int64).max if i is None else i for i in docs.column("doc_id").to_pylist()], np.int64)


def _candidate_windows(h: np.ndarray, shared: np.ndarray, window: int, n_buckets: int) -> np.ndarray:
    """Starts of the windows that hold an anchor which another document shares."""
    at, anchors = _anchors(h, window)
    hit, _ = B.found_in(B.short_keys(anchors, n_buckets), shared)
    span = np.zeros(len(h) + 1, np.int64)
    np.add.at(span, np.maximum(at[hit] - period_of(window) + 1, 0), 1)
    np.add.at(span, at[hit] + 1, -1)
    starts = np.flatnonzero(np.cumsum(span[:-1]) > 0)
    return starts[starts <= len(h) - window]


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: ``n_words``, ``n_removed``, ``kept`` (the words left, joined by a space), its SHA-256 and that of the text.

    A word goes if a window of ``window`` words around it also starts in a document with a smaller ``doc_id``; windows are
    judged on the input. Words are cut at ASCII white space and compared as they are. Only ``doc_id`` and ``text`` are read. Null
    and empty texts have no words (kept is empty); a document shorter than a window keeps everything; rows with an equal
    ``doc_id`` count as one document among themselves (neither is smaller) and each returns a row; a null id comes after all
    others. An empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    n_buckets = B.parts(B.text_bytes(docs), B.BLOCK_BYTES)
    blocks = B.in_blocks(docs, n_buckets)

    def ask_anchors(table: pa.Table, _) -> list[tuple[int, bytes]]:
        found = [(_anchors(h, window)[1], i) for h, i in zip(_hashes(table), _ids(table), strict=True)]
        keys = B.short_keys(np.concatenate([k for k, _ in found]), n_buckets)
        ids = np.repeat(np.array([i for _, i in found], np.int64), [len(k) for k, _ in found])
        keys, low, high = _firsts(keys, ids)
        return B.packed_by_bucket(keys, [keys.astype(np.uint32), (low != high).astype(np.uint8)], n_buckets, (keys >> np.uint64(32)).astype(np.int64))

    def shared_anchors(_, given: list[tuple[int, bytes]]):
        place, (keys, several) = B.gathered(given, [np.uint32, np.uint8])
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        again = np.zeros(len(keys), bool)
        again[1:] = ranked[1:] == ranked[:-1]
        again[:-1] |= again[1:]
        shared = np.zeros(len(keys), bool)
        shared[order] = again
        return B.returned(given, place, shared | (several > 0), [keys])

    def ask_windows(table: pa.Table, answers: dict) -> list[tuple[int, bytes]]:
        (shared,) = B.merged(answers.get("anchors"), [np.uint32], short=True)
        keys, ids = [], []
        for h, i in zip(_hashes(table), _ids(table), strict=True):
            starts = _candidate_windows(h, shared, window, n_buckets)
            if len(starts):
                keys.append(B.ngram_hashes(h, window)[starts])
                ids.append(np.full(len(starts), i, np.int64))
        if not keys:
            return []
        keys, low, _ = _firsts(np.concatenate(keys), np.concatenate(ids))
        return B.packed_by_bucket(keys, [keys, low], n_buckets, B.bucket_of(keys, n_buckets))

    def first_documents(_, given: list[tuple[int, bytes]]):
        place, (keys, low) = B.gathered(given, [np.uint64, np.int64])
        distinct, first, _ = _firsts(keys, low)
        first = first[np.searchsorted(distinct, keys)]
        return B.returned(given, place, first < low, [keys, first])

    def cut(table: pa.Table, answers: dict) -> pa.Table:
        (shared,) = B.merged(answers.get("anchors"), [np.uint32], short=True)
        elsewhere, elsewhere_first = B.merged(answers.get("windows"), [np.uint64, np.int64])
        texts, ids = B.texts_of(table), _ids(table)
        candidates = []
        for text, i in zip(texts, ids, strict=True):
            h = B.word_hashes(text.split())
            starts = _candidate_windows(h, shared, window, n_buckets)
            candidates.append((starts, B.ngram_hashes(h, window)[starts] if len(starts) else np.empty(0, np.uint64), i))
        keys, low, _ = _firsts(np.concatenate([k for _, k, _ in candidates] or [np.empty(0, np.uint64)]), np.concatenate([np.full(len(k), i, np.int64) for _, k, i in candidates] or [np.empty(0, np.int64)]))
        rows = []
        for text, (starts, own, i) in zip(texts, candidates, strict=True):
            words = text.split()
            gone = np.zeros(len(words) + 1, np.int64)
            if len(own):
                first = low[np.searchsorted(keys, own)]
                hit, at = B.found_in(own, elsewhere)
                first = np.where(hit, np.minimum(first, elsewhere_first[at] if len(elsewhere) else first), first)
                repeats = starts[first < i]
                np.add.at(gone, repeats, 1)
                np.add.at(gone, repeats + window, -1)
            gone = np.cumsum(gone[:-1]) > 0
            kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if gone.any() else b" ".join(words)
            rows.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept, hashlib.sha256(text).hexdigest()))
        n, removed, digests, kept, originals = zip(*rows, strict=True) if rows else ((), (), (), (), ())
        return pa.table(
            [table.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(originals, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "text_sha256"],
        )

    answers = B.ask(blocks, None, "anchors", ask_anchors, shared_anchors, n_buckets)
    answers = B.ask(blocks, answers, "windows", ask_windows, first_documents, n_buckets)
    return B.per_block(blocks, answers, cut, RESULT)
