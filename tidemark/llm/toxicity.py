"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows of toxic and one on windows of ordinary text. A window is as many bytes
shorter with one dictionary as it has in common with that text; a document is scored by how many of its windows pass thresholds
of this difference, calibrated on labelled documents.

A window is one word. Toxic documents are mostly ordinary prose, in which the difference of a longer window drowns, so the toxic
windows to train on are picked by the labels: words that hold a run of characters which toxic documents have significantly
more often. A compressor gives up on windows of a few bytes and finds little in them, so each is led by a run of zeros, which costs
the same with either dictionary, and framed by marks: a word that a dictionary holds is then one match with its marks, while
another word parts the marks and costs its letters.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import blocks as B
from tidemark.llm.components import stored
from tidemark.llm.labelled import training_sample

#: Most labelled documents of each class to learn from.
PER_CLASS = 4000
#: Lengths of the runs of characters, and how many standard errors they have to be more frequent by.
RUNS = (5, 6)
SIGNIFICANT = 7.0
#: Most windows that a dictionary is trained on, and windows that an ordinary document gives.
MOST_WINDOWS = 60_000
WINDOWS_PER_DOCUMENT = 20
TOXIC_BYTES, ORDINARY_BYTES = 2048, 8192
LEVEL = 9
LEAD, BEFORE, AFTER = b"\0" * 64, b"<<", b">>"
#: Differences that are counted, in bytes and in shares of the word.
STEPS = (2, 3, 4, 5, 6, 8)
SHARES = (0.2, 0.3, 0.4, 0.5, 0.6)
#: Words whose difference a task remembers.
REMEMBERED = 400_000


def windows(text: bytes) -> list[bytes]:
    return text.lower().split()


def _framed(window: bytes) -> bytes:
    return BEFORE + window + AFTER


def _runs(window: bytes) -> set[bytes]:
    window = b" " + window + b" "
    return {window[i : i + n] for n in RUNS for i in range(len(window) - n + 1)}


class Distance(dict):
    """Window to difference in bytes: length with the ordinary less length with the toxic dictionary."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        super().__init__()
        options = {"format": zstandard.FORMAT_ZSTD1_MAGICLESS, "write_content_size": False, "write_checksum": False, "write_dict_id": False, "min_match": 3}
        options = zstandard.ZstdCompressionParameters.from_level(LEVEL, **options)
        self.compressors = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), compression_params=options) for d in (ordinary, toxic)]

    def __missing__(self, window: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        ordinary, toxic = (len(c.compress(LEAD + _framed(window))) for c in self.compressors)
        self[window] = ordinary - toxic
        return ordinary - toxic

    def of(self, text: bytes) -> list[float]:
        found = windows(text)
        difference = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        shares = difference / (np.fromiter(map(len, found), np.int64, len(found)) + 2)
        counts = [int((difference >= step).sum()) for step in STEPS] + [int((shares >= share).sum()) for share in SHARES]
        return [*(math.log1p(c) for c in counts), math.log1p(len(found)), *(min(1.0, 20 * c / max(1, len(found))) for c in counts)]


class Model:
    def __init__(self, toxic: bytes, ordinary: bytes, weights: np.ndarray | None = None, mean=0.0, spread=1.0, constant: float = 0.0):
        self.toxic, self.ordinary, self.weights, self.mean, self.spread, self.constant = toxic, ordinary, weights, mean, spread, constant

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.constant)
        x = np.column_stack(((features - self.mean) / self.spread, np.ones(len(features))))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -40, 40)))


def calibrated(model: Model, features: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> Model:
    """Logistic regression of the label on the counts, by Newton's method."""
    mean, spread = features.mean(axis=0), features.std(axis=0) + 1e-6
    x, w = np.column_stack(((features - mean) / spread, np.ones(len(features)))), np.zeros(features.shape[1] + 1)
    ridge = 1e-4 * weight.sum()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + (ridge + 1e-9) * np.eye(len(w))
        w = w - np.linalg.solve(hessian, x.T @ (weight * (p - labels)) + ridge * w)
    return Model(model.toxic, model.ordinary, w, mean, spread)


def _marks(sample: DataFrame) -> set[bytes]:
    """Runs of characters significantly more frequent in toxic documents."""
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return set()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter(), Counter()]
            for text, label in zip(B.texts_of(pa.Table.from_batches([batch])), batch.column("label").to_pylist(), strict=True):
                counts[label].update({run for w in set(windows(text)) for run in _runs(w)})
            runs = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(runs, pa.binary()), *(pa.array([c[r] for r in runs], pa.int64()) for c in counts)], names=["run", "n0", "n1"])

    a, b = F.col("n1") / sizes[1], F.col("n0") / sizes[0]
    both = (F.col("n0") + F.col("n1")) / (sizes[0] + sizes[1])
    error = F.sqrt(both * (1 - both) * (1 / sizes[0] + 1 / sizes[1])) + 1e-12
    found = sample.mapInArrow(count, "run binary, n0 bigint, n1 bigint").groupBy("run").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    # Each document can hold only so many runs of this significance, so with a bounded sample there are a bounded number of them.
    return {bytes(r["run"]) for r in found.where((a - b) > SIGNIFICANT * error).where("n1 >= 5").select("run").collect()}


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary of at most ``size`` bytes, smaller where there is little to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        if size <= 512:
            raise
        return _dictionary(samples, size // 2)


def fit(docs: DataFrame, labels: DataFrame, learnt: Column, per_class: int = PER_CLASS) -> Model:
    """Learn ``labels.toxic`` from at most ``per_class`` documents of each class among the rows that ``learnt`` allows."""
    sample = stored(training_sample(docs, labels, "toxic", learnt, per_class).repartition(16, "doc_id"), "toxic-sample")
    totals = {r["y"]: r["n"] for r in labels.where(learnt).where(F.col("toxic").isin(0, 1)).groupBy(F.col("toxic").alias("y")).agg(F.count("*").alias("n")).collect()}
    marks = _marks(sample)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter(), Counter()]
            for text, label in zip(B.texts_of(pa.Table.from_batches([batch])), batch.column("label").to_pylist(), strict=True):
                found = windows(text)
                if label:
                    counts[1].update(w for w in found if not marks.isdisjoint(_runs(w)))
                else:
                    counts[0].update(found[:: max(1, -(-len(found) // WINDOWS_PER_DOCUMENT))])
            rows = [(w, y, n) for y in (0, 1) for w, n in counts[y].items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64())], names=["window", "label", "n"])

    picked = sample.mapInArrow(pick, "window binary, label int, n bigint").groupBy("window", "label").agg(F.sum("n").alias("n"))
    kinds = {}
    for y, size in ((1, TOXIC_BYTES), (0, ORDINARY_BYTES)):
        rows = picked.where(F.col("label") == y).orderBy(F.desc("n"), "window").limit(MOST_WINDOWS).collect()
        samples = [_framed(bytes(r["window"])) for r in rows for _ in range(r["n"])]
        samples = samples[:: max(1, -(-len(samples) // MOST_WINDOWS))]
        kinds[y] = [samples[i] for i in np.random.default_rng(0).permutation(len(samples))]
    try:
        toxic, ordinary = (_dictionary(kinds[y], size) for y, size in ((1, TOXIC_BYTES), (0, ORDINARY_BYTES)))
    except zstandard.ZstdError:  # too little text of a kind to train on
        share = totals.get(1, 0) / max(1, sum(totals.values()))
        return Model(b"", b"", constant=share)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(toxic, ordinary)
        for batch in batches:
            features = [distance.of(t) for t in B.texts_of(pa.Table.from_batches([batch]))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(features, pa.list_(pa.float64()))], names=["doc_id", "label", "features"])

    rows = sorted(sample.mapInArrow(describe, "doc_id bigint, label int, features array<double>").collect(), key=lambda r: r["doc_id"])
    y = np.array([r["label"] for r in rows], float)
    weight = np.where(y == 1, totals[1] / (y == 1).sum(), totals[0] / (y == 0).sum())  # classes as frequent as among the labels
    return calibrated(Model(toxic, ordinary), np.array([r["features"] for r in rows]), y, weight / weight.mean())


#: Scores from here on mean label 1.
TOXIC = 0.5


def classified(docs: DataFrame, model: Model, apart: Column) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from a score of ``TOXIC``) for every whole text.

    Null, empty and blank texts have no windows and are scored like that. Only ``doc_id`` and ``text`` are looked at, the
    former for ``held_out`` alone; every row returns a row.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(model.toxic, model.ordinary) if model.weights is not None else None
        for batch in batches:
            texts = B.texts_of(pa.Table.from_batches([batch]))
            features = np.array([distance.of(t) if distance is not None else [0.0] for t in texts]).reshape(len(texts), -1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(model.scores(features), pa.float64())], names=["doc_id", "score"])

    done = docs.select("doc_id", "text").mapInArrow(scored, "doc_id bigint, score double")
    return done.select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))
