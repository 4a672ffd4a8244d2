import collections

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tests.llm import test_bpe, test_minhash, test_mixing, test_substring_dedup
from tests.llm.conftest import SF
from tidemark.llm import stages
from tidemark.llm.queries import ORACLE, QUERIES
from verification.compare import connect, difference


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    actual = QUERIES[name](spark, SF).toPandas()
    assert difference(actual, connect(SF).execute(ORACLE[name]).df()) is None


def test_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())


def test_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = stages.quality(spark, docs, SF)
    assert good.columns == docs.columns and 0.7 * len(rows) < good.count() < len(rows)

    near = stages.near_dedup(spark, docs, SF)
    assert sorted(r["doc_id"] for r in near.collect()) == [i for i, _, _, kept in test_minhash.expected(list(rows.items())) if kept]

    cut = stages.substring_dedup(spark, docs, SF).collect()
    wanted = {r[0]: r for r in test_substring_dedup.expected(list(rows.items()), 13)}
    assert len(cut) == len(rows)
    for r in cut:
        _, n, removed, _ = wanted[r["doc_id"]]
        assert len(r["text"].encode().split()) == n - removed and r["n_chars"] == len(r["text"])
        assert removed or r["text"] == rows[r["doc_id"]]

    mixed = stages.mixing_stage(spark, docs, SF)
    assert mixed.columns == docs.columns
    _, targets = test_mixing.targets([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    taken = collections.Counter()
    for r in mixed.collect():
        taken[r["source"]] += len(r["text"].encode().split())
    assert all(abs(taken[s] - targets[s]) <= 1 for s in targets)

    for r in stages.encoding(spark, docs, SF).limit(20).collect():
        assert (r["ids"], r["n_tokens"], r["ids_sha256"]) == test_bpe.expected(rows[r["doc_id"]])[:3]


def test_the_whole_run(spark):
    done = corpus_pipeline.run(spark, SF)
    assert done.count() > 100 and done.where("n_tokens <> size(ids)").count() == 0


def test_stages_pass_odd_tables_on(spark, documents):
    rows = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, None), (3, ""), (None, "x y"), (4, "k " * 3000), (5, "a b c d e f g h")]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = documents(rows, extra=True)
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, documents([], extra=True), SF).count() == 0, name
    assert sorted(str(r["doc_id"]) for r in stages.near_dedup(spark, documents(rows), SF).collect()) == sorted(["1", "1", "2", "3", "None", "4"])
    assert corpus_pipeline.STAGES[-1][1](spark, documents(rows), SF).count() == len(rows)


def test_copies_that_share_or_lack_an_id_are_one_group(spark, documents):
    text = " ".join(f"w{k}" for k in range(40))
    other = " ".join(f"v{k}" for k in range(40))
    rows = [(1, text), (1, text), (None, text), (None, text + " end"), (2, text), (2, other), (None, other), (None, "alone and short"), (3, ""), (3, ""), (None, None)]
    kept = stages.near_dedup(spark, documents(rows, extra=True), SF)
    assert kept.columns == documents(rows, extra=True).columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert got == sorted([(1, text), (2, other), (None, "alone and short"), (3, ""), (3, ""), (None, None)], key=repr)
