import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidemark.llm import quality, toxicity
from tidemark.llm.labelled import held_out, training_sample

SF = "/root/testdata/sf0.01"


@pytest.fixture
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_quality_on_held_out_labels(tables):
    docs, labels = tables
    apart = held_out(2, 4)
    got = quality.classified(docs, quality.fit(docs, labels, ~apart), apart).join(labels, "doc_id").where("held_out").toPandas()
    assert len(got) > 50 and (got["predicted"] == got["quality"]).mean() > 0.95


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    apart = held_out(0, 5)
    got = toxicity.classified(docs, toxicity.fit(docs, labels, ~apart), apart).join(labels, "doc_id").where("held_out").toPandas()
    one, other = got[got["toxic"] == 1]["score"].values, got[got["toxic"] == 0]["score"].values
    assert len(one) > 50 and (one[:, None] > other[None, :]).mean() > 0.95
    assert (got["predicted"] == got["toxic"]).mean() > 0.93


def test_the_remainder_is_that_of_crc32(spark):
    import zlib

    got = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", held_out(2, 4).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


def test_samples_are_bounded_and_repeatable(documents, labels):
    docs = documents([(i, f"text {i}") for i in range(40)] + [(3, "a other text")])
    given = labels([(i, i % 2, None) for i in range(40)] + [(3, 0, 1), (None, 1, 1), (5, 7, 1)])
    one, two = (sorted(tuple(r) for r in training_sample(docs, given, "quality", F.col("doc_id") < 30, 6).collect()) for _ in range(2))
    assert one == two and len(one) == 12 and {i for i, _, _ in one} <= set(range(30))
    assert dict((i, (y, t)) for i, y, t in one).get(3, (0, "a other text")) == (0, "a other text")


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
@pytest.mark.parametrize("given", [[], [(0, 1, 1)], [(0, 1, 0), (1, 1, 0)], [(0, 0, 0), (1, 1, 1)]])
def test_few_labels_and_odd_texts(documents, labels, module, label, given):
    rows = [(0, "good plain words"), (1, "bad!! $$$ words"), (2, ""), (3, None), (4, " \n"), (5, "w " * 30000), (6, "x" * 50000), (None, "good plain words"), (0, "good plain words")]
    docs = documents(rows, extra=True)
    got = module.classified(docs, module.fit(docs, labels(given), F.lit(True)), held_out(1, 2)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    scores = {r["doc_id"]: r["score"] for r in got}
    assert scores[2] == scores[3] == scores[4]
    assert module.classified(documents([]), module.fit(documents([]), labels([]), F.lit(True)), held_out(1, 2)).count() == 0


def test_passages_cover_whole_texts_in_chunks(monkeypatch):
    text = ("\n " + prose(random.Random(0), 1000)).encode()
    whole = np.concatenate(list(quality.passages(text)))
    monkeypatch.setattr(quality, "CHUNK", 3)
    parts = np.concatenate(list(quality.passages(text)))
    assert whole.shape == parts.shape == (16, quality.FEATURES) and np.allclose(whole[:, -6:], parts[:, -6:])


def test_attention_learns_one_bad_passage():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(rng.integers(1, 20), quality.FEATURES)) for _ in range(300)]
    labels = np.array([k % 2 for k in range(300)], float)
    for bag, y in zip(bags, labels, strict=True):
        bag[rng.integers(len(bag)), :5] += 4 * (y == 0)
    model = quality.train(bags[:200], labels[:200])
    found = [model.score(iter([bag])) >= 0.5 for bag in bags[200:]]
    assert np.mean(found == labels[200:]) > 0.9


def test_windows_share_more_with_their_own_dictionary():
    rng = random.Random(0)
    ordinary = [w.encode() for w in prose(rng, 5000).split()]
    toxic = [rng.choice([b"dreadful", b"horrible", b"vile"]) for _ in range(5000)]
    distance = toxicity.Distance(*(toxicity._dictionary([toxicity._framed(w) for w in words], 2048) for words in (toxic, ordinary)))
    assert min(distance[b"dreadful"], distance[b"horrible"]) > max(distance[w] for w in set(ordinary))
