"""Runs: stretches of words that repeat with a period, found by recompression.

A run with period ``p`` has a multiple of ``p`` in its first ``p`` places, so it is enough to try the pairs ``(kp, kp + p)`` of every period's grid,
which is harmonic in number. How far both places agree forwards and backwards, which gives the run's exact ends, is asked of a run-length
grammar of the texts and of one of the texts read backwards (``recompression``). Many documents share a grammar: they are joined by
symbols that occur once, so that nothing extends past a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import recompression
from tidemark.llm.blocks import texts_of

#: Fixed value: the fewest words of a run.
SHORTEST = 12
#: Bytes of text that share a grammar; a longer text has one of its own.
GROUP_BYTES = 1 << 20
#: Pairs of places that are asked about at once.
ASKED = 1 << 18
#: Periods below are tried one after the other, larger ones many at a time.
LOOPED = 64


def _grid(words: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places ``i`` and periods ``p`` of the grids of all periods up to ``longest`` whose words, or those before them, agree ``p`` apart."""
    n = len(words)
    for p in range(1, min(longest, LOOPED - 1) + 1):
        m = (n - 1) // p - 1
        if m > 0:
            agree = (words[p : n - p : p][:m] == words[2 * p :: p][:m]) | (words[p - 1 : n - p : p][:m] == words[2 * p - 1 :: p][:m])
            k = np.flatnonzero(agree) + 1
            yield k * p, np.full(len(k), p)
    low = LOOPED
    while low <= longest:
        high = low + max(1, ASKED * low // n)
        periods = np.arange(low, min(high, longest + 1))
        counts = np.maximum((n - 1) // periods - 1, 0)
        p = np.repeat(periods, counts)
        i = p * (np.arange(len(p)) - np.repeat(np.cumsum(counts) - counts, counts) + 1)
        agree = np.flatnonzero((words[i] == words[i + p]) | (words[i - 1] == words[i + p - 1]))
        yield i[agree], p[agree]
        low = high


def _gathered(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    waiting, n = [], 0
    for part in parts:
        waiting.append(part)
        n += len(part[0])
        if n >= ASKED:
            yield tuple(np.concatenate(c) for c in zip(*waiting, strict=True))
            waiting, n = [], 0
    if n:
        yield tuple(np.concatenate(c) for c in zip(*waiting, strict=True))


def runs_of(documents: list[np.ndarray], shortest: int = SHORTEST) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each sequence of word numbers the starts, lengths and smallest periods of its runs, by start and then period."""
    sizes = np.array([len(d) for d in documents], np.int64)
    starts = np.cumsum(sizes + 1) - sizes  # one symbol before each document and one at the end
    n = int(sizes.sum()) + len(sizes) + 1
    words = np.empty(n, np.int32)
    largest = max((int(d.max()) for d in documents if len(d)), default=-1)
    separators = np.append(starts - 1, n - 1)
    words[separators] = largest + 1 + np.arange(len(separators))
    for start, d in zip(starts, documents, strict=True):
        words[start : start + len(d)] = d
    found = [np.empty((0, 3), np.int64)]
    longest = int(sizes.max()) // 2 if len(sizes) else 0
    if longest and int(sizes.max()) >= shortest:
        ahead, back = recompression.grammar(words), recompression.grammar(words[::-1])
        for i, p in _gathered(_grid(words, longest)):
            before = recompression.agreement(back, n - i, n - i - p)
            own = np.flatnonzero(before < p)  # else an earlier place of the grid finds it too
            i, p, before = i[own], p[own], before[own]
            after = recompression.agreement(ahead, i, i + p)
            whole = np.flatnonzero((before + after >= p) & (before + after + p >= shortest))
            found.append(np.stack(((i - before)[whole], (before + after + p)[whole], p[whole]), axis=1).astype(np.int64))
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    fresh = np.ones(len(rows), bool)  # multiples of the smallest period find the same stretch
    fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[fresh]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    cuts = np.searchsorted(rows[:, 0], np.append(starts, n))
    return [(rows[u:v, 0] - s, rows[u:v, 1], rows[u:v, 2]) for s, u, v in zip(starts, cuts[:-1], cuts[1:], strict=True)]


def kept_places(n: int, starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """Whether each of ``n`` words is in no run after that run's first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts + periods, 1)
    np.add.at(depth, starts + lengths, -1)
    return np.cumsum(depth[:-1]) == 0


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _groups(texts: list[bytes]) -> Iterator[list[int]]:
    """Rows in groups of some bytes, texts of like length together."""
    group, size = [], 0
    for k in sorted(range(len(texts)), key=lambda k: len(texts[k])):
        if group and size + len(texts[k]) > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(k)
        size += len(texts[k])
    if group:
        yield group


def _described(ids: pa.Array, texts: list[bytes], shortest: int) -> pa.RecordBatch:
    words = [t.split() for t in texts]
    counts = [len(w) for w in words]
    numbers = pa.array([w for d in words for w in d], pa.binary()).dictionary_encode().indices.to_numpy()
    found = runs_of(np.split(numbers, np.cumsum(counts)[:-1]), shortest)
    kept = []
    for own, runs in zip(words, found, strict=True):
        kept.append(b" ".join(own) if not len(runs[0]) else b" ".join([own[k] for k in np.flatnonzero(kept_places(len(own), *runs))]))
    columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found, strict=True)]
    offsets = pa.array(np.concatenate(([0], np.cumsum([len(r[0]) for r in found]))), pa.int32())
    runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, fields=list(_RUN)))
    return pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), runs, pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "kept"])


def find_runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length and smallest period, by start and then period) and ``kept`` of every row of ``docs``.

    A run is a stretch of words of at least ``shortest`` words and two periods that no neighbouring word extends; ``kept`` is the text without the words
    that some run contains after its first period, joined by spaces. Every row is looked at alone: repeated and null ids stay as they are, null,
    empty and blank texts have no words, an empty table gives none. Only ``doc_id`` and ``text`` are read. A text is held whole in one
    task, at some hundred bytes a word.
    """

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(pa.Table.from_batches([batch]))
            for rows in _groups(texts):
                yield _described(batch.column("doc_id").take(pa.array(rows, pa.int64())), [texts[k] for k in rows], shortest)
            pa.default_memory_pool().release_unused()

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(described, f"doc_id bigint, n_words bigint, runs {RUNS}, kept string")


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, in which every tenth document, by the checksum of its id, repeats itself from some word on.

    With h the CRC-32 of the id and g = h div 10, the words from a = g mod n on repeat with period 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("_g"), F.when(h % 10 == 0, words).alias("_words"))
    n, g = F.size("_words"), F.col("_g")
    placed = chosen.withColumn("_a", F.when(n > 0, g % F.greatest(n, F.lit(1)))).withColumn("_p", 1 + F.floor((n - F.col("_a")) / (3 + g % 8)))

    def source(word: Column, i: Column) -> Column:
        return F.when(i < F.col("_a"), word).otherwise(F.get("_words", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")))

    return placed.select("doc_id", F.when(F.col("_a").isNotNull(), F.array_join(F.transform("_words", source), " ")).otherwise(F.col("text")).alias("text"))


def summarised(found: DataFrame) -> DataFrame:
    """Per row of :func:`find_runs` the number of runs, the longest one (ties: smallest start, then period) and digests of runs and kept words."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))).alias("best")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.select("*", best)
    length, period = F.col("best.length"), -F.col("best.period")
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"),
    )
