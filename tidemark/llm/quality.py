"""A quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. A passage is described by how often kinds of characters follow each
other and by how much of it repeats; a layer encodes it; gated attention, learnt from labels of documents only, weighs the
passages; and the weighted sum of their codes is scored. So one bad passage of a long document can decide, and nothing is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import blocks as B
from tidemark.llm.labelled import training_sample

PASSAGE_WORDS = 64
#: Most labelled documents of each class to learn from.
PER_CLASS = 2000
CODE = 24
GATE = 12
EPOCHS = 25
BATCH = 64
#: Passages that are described at once, which bounds memory for very long texts.
CHUNK = 2048

# Kinds of bytes.
_GROUPS = [b" \t\r\x0b\x0c", b"\n", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",;:", b"!?", b"|", b"#$%&*@~^", b"'\"()[]{}-", b"<>/\\_=+`"]
KINDS = len(_GROUPS) + 2
_KIND = np.full(256, KINDS - 1, np.int64)
_KIND[128:] = KINDS - 2
for _k, _bytes in enumerate(_GROUPS):
    _KIND[list(_bytes)] = _k
EXTRA = 6
FEATURES = KINDS * KINDS + EXTRA


def passages(text: bytes) -> Iterator[np.ndarray]:
    """Descriptions of all passages, ``CHUNK`` at a time; a text without words has one that is zero but for its last column."""
    raw = np.frombuffer(text, np.uint8)
    kind = _KIND[raw]
    white = kind <= 1
    first = np.flatnonzero(~white & np.concatenate(([True], white[:-1]))) if len(raw) else np.empty(0, np.int64)
    if not len(first):
        yield np.concatenate((np.zeros(FEATURES - 1), [1.0]))[None, :]
        return
    hashes = B.word_hashes(text.split())
    grams = B.ngram_hashes(hashes, 4)
    repeated, known = np.zeros(len(hashes)), np.zeros(len(hashes))
    if len(grams):
        _, where = np.unique(grams, return_index=True)
        repeated[: len(grams)] = 1
        repeated[where] = 0
    _, where = np.unique(hashes, return_index=True)
    known[:] = 1
    known[where] = 0
    n = -(-len(first) // PASSAGE_WORDS)
    starts = np.append(first[::PASSAGE_WORDS], len(raw))
    starts[0] = 0
    for low in range(0, n, CHUNK):
        high = min(low + CHUNK, n)
        part = kind[starts[low] : starts[high]]
        sizes = np.diff(starts[low : high + 1])
        owner = np.repeat(np.arange(high - low), sizes)
        codes = owner[1:] * KINDS**2 + part[:-1] * KINDS + part[1:]
        counts = np.bincount(codes, minlength=(high - low) * KINDS**2).reshape(high - low, -1)
        out = np.zeros((high - low, FEATURES))
        out[:, : KINDS**2] = np.sqrt(counts / np.maximum(sizes, 1)[:, None])
        words = np.minimum(PASSAGE_WORDS, len(first) - np.arange(low, high) * PASSAGE_WORDS)
        of = np.arange(low * PASSAGE_WORDS, min(high * PASSAGE_WORDS, len(first))) // PASSAGE_WORDS - low
        span = slice(low * PASSAGE_WORDS, high * PASSAGE_WORDS)
        out[:, KINDS**2] = np.bincount(of, repeated[span], high - low) / words
        out[:, KINDS**2 + 1] = np.bincount(of, known[span], high - low) / words
        out[:, KINDS**2 + 2] = np.log1p(sizes / words)
        out[:, KINDS**2 + 3] = np.log1p(words)
        out[:, KINDS**2 + 4] = np.log1p(len(first))
        yield out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Weights, and the score of a bag."""

    def __init__(self, weights: dict[str, np.ndarray] | None, constant: float = 0.5):
        self.weights, self.constant = weights, constant

    def codes(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh((x - w["mean"]) / w["spread"] @ w["W"] + w["b"])

    def score(self, chunks: Iterator[np.ndarray]) -> float:
        if self.weights is None:
            return self.constant
        w = self.weights
        h = np.concatenate([self.codes(x) for x in chunks])
        at = (np.tanh(h @ w["V"]) * _sigmoid(h @ w["U"])) @ w["a"]
        at = np.exp(at - at.max())
        return float(_sigmoid((at / at.sum()) @ h @ w["c"] + w["d"])[()])


def train(bags: list[np.ndarray], labels: np.ndarray) -> Model:
    """Gradient descent (Adam) on the log loss of documents; classes weigh alike. Repeats itself for the same bags in the same order."""
    if len(np.unique(labels)) < 2:
        return Model(None, float(labels[0]) if len(labels) else 0.5)
    random = np.random.default_rng(0)
    everything = np.concatenate(bags)
    mean, spread = everything.mean(axis=0), everything.std(axis=0) + 0.02
    del everything
    bags = [((x - mean) / spread).astype(np.float32) for x in bags]
    w = {
        "W": random.normal(0, FEATURES**-0.5, (FEATURES, CODE)), "b": np.zeros(CODE), "V": random.normal(0, CODE**-0.5, (CODE, GATE)),
        "U": random.normal(0, CODE**-0.5, (CODE, GATE)), "a": random.normal(0, GATE**-0.5, GATE), "c": random.normal(0, CODE**-0.5, CODE), "d": np.zeros(1),
    }
    weight = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean())
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for _ in range(EPOCHS):
        order = random.permutation(len(bags))
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            x = np.concatenate([bags[i] for i in chosen]).astype(float)
            starts = np.concatenate(([0], np.cumsum([len(bags[i]) for i in chosen])[:-1]))
            owner = np.repeat(np.arange(len(chosen)), [len(bags[i]) for i in chosen])
            h = np.tanh(x @ w["W"] + w["b"])
            t, s = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
            e = (t * s) @ w["a"]
            e = np.exp(e - np.maximum.reduceat(e, starts)[owner])
            alpha = e / np.add.reduceat(e, starts)[owner]
            z = np.add.reduceat(alpha[:, None] * h, starts)
            out = (_sigmoid(z @ w["c"] + w["d"]) - labels[chosen]) * weight[chosen] / len(chosen)
            dz = out[:, None] * w["c"]
            dalpha = (dz[owner] * h).sum(axis=1)
            de = alpha * (dalpha - np.add.reduceat(alpha * dalpha, starts)[owner])
            dt, ds = de[:, None] * w["a"] * s * (1 - t * t), de[:, None] * w["a"] * t * s * (1 - s)
            dh = (alpha[:, None] * dz[owner] + dt @ w["V"].T + ds @ w["U"].T) * (1 - h * h)
            g = {"W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "a": ((t * s) * de[:, None]).sum(axis=0), "c": z.T @ out, "d": np.array([out.sum()])}
            step += 1
            for k in w:
                grad = g[k] + 1e-4 * w[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                w[k] = w[k] - 0.005 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    w["d"] = w["d"][0]
    return Model(w | {"mean": mean, "spread": spread})


def fit(docs: DataFrame, labels: DataFrame, learnt: Column, per_class: int = PER_CLASS) -> Model:
    """Learn ``labels.quality`` from at most ``per_class`` documents of each class among the rows that ``learnt`` allows."""
    sample = training_sample(docs, labels, "quality", learnt, per_class)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [np.concatenate(list(passages(t))).astype("<f4").tobytes() for t in B.texts_of(pa.Table.from_batches([batch]))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(bags, pa.binary())], names=["doc_id", "label", "bag"])

    rows = sorted(sample.mapInArrow(describe, "doc_id bigint, label int, bag binary").collect(), key=lambda r: r["doc_id"])
    return train([np.frombuffer(r["bag"], "<f4").reshape(-1, FEATURES) for r in rows], np.array([r["label"] for r in rows], float))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``, 0 to 1: how likely the label 1 is for the whole text. Nothing but ``text`` is looked at.

    Null, empty and blank texts are alike and get the score of an empty bag. Every row gets a score, repeated rows the same.
    """
    schema = docs.drop(name).schema.add(name, "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(passages(t)) for t in B.texts_of(pa.Table.from_batches([batch]))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=schema.names)

    return docs.drop(name).mapInArrow(scored, schema)


#: Scores from here on mean label 1.
ACCEPTED = 0.7


def classified(docs: DataFrame, model: Model, apart: Column) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from a score of ``ACCEPTED``)."""
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))
