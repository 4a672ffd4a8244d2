import math
import random
import re
from collections import Counter

import pytest

from tests.llm.conftest import prose
from tidemark.llm import impact_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def expected(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 25 + 75 * c.total() * n_docs // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            scored += [(i, score)] if score > 0 else []
        scored.sort(key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        out += [(item, rank, i, score) for rank, (i, score) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def found(docs, items, **options):
    return sorted((tuple(r) for r in impact_search.search(docs, items, **options).collect()), key=repr)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id bigint, text string, low int").drop("low") if not rows or len(rows[0]) == 3 else spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.mark.parametrize(("query_bytes", "growth"), [(1 << 22, 6), (1500, 1000)])
def test_equals_brute_force(documents, items, monkeypatch, query_bytes, growth):
    monkeypatch.setattr(impact_search, "SHARD_BYTES", 4000)
    monkeypatch.setattr(impact_search, "FIRST_READ", 1)
    monkeypatch.setattr(impact_search, "GROWTH", growth)
    rng = random.Random(3)
    docs = [(i, prose(rng, rng.randrange(1, 90), rng.choice([20, 400]))) for i in range(120)]
    docs += [(500 + i, docs[3][1]) for i in range(15)] + [(7, docs[7][1]), (7, "w1 w2"), (None, docs[3][1]), (None, "w5")]
    docs += [(600, ""), (601, None), (602, " .,-"), (603, "w1 " * 3000), (604, "Ünïcode W1\x00w2_w3-É"), (605, "w9999 rare words")]
    queries = [(k, prose(rng, 12, 60) + " " + docs[rng.randrange(120)][1][:40]) for k in range(12)]
    queries += [(20, docs[3][1]), (21, "w1 w1 w1 w2"), (21, "w1 w1 w1 w2"), (22, ""), (23, None), (24, "absent terms only"), (25, "W9999"), (None, "é ünïcode w3"), (26, "rare")]
    assert found(documents(docs, extra=True), items(queries), query_bytes=query_bytes) == expected(docs, queries)


def test_reading_stops_when_all_is_settled(documents, monkeypatch):
    """A query for rare terms ends before the lists of frequent ones are read."""
    monkeypatch.setattr(impact_search, "SHARD_BYTES", 2000)
    monkeypatch.setattr(impact_search, "FIRST_READ", 1)
    monkeypatch.setattr(impact_search, "GROWTH", 4)
    rng = random.Random(4)
    rows = [(i, prose(rng, 60, 30) + (" z1 z2 z3" if i % 40 == 0 else "")) for i in range(400)]
    queries = [(0, "z1 z2 z3"), (1, prose(rng, 30, 30))]
    parts, settled = impact_search._block(documents(rows), impact_search.Queries.of(queries), 10)
    assert settled[0] + settled[1] >= 1 and sum(settled) == 2 and len(settled) > 2
    assert sorted((tuple(r) for p in parts for r in p.collect()), key=repr) == expected(rows, queries)


def test_empty_tables(documents, items):
    assert found(documents([]), items([(1, "w1")])) == []
    assert found(documents(["w1 w2", None]), items([])) == []
    assert found(documents([None, " "]), items([(1, "w1")])) == []
