import random

import numpy as np
import pytest

from tests.llm.conftest import prose
from tidemark.llm import minhash
from tidemark.llm.components import components


def expected(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    group = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    return sorted((i, len(sets[i]), group[i], group[i] == i) for i in ids)


def run(docs):
    return sorted((tuple(r) for r in minhash.near_duplicates(docs).collect()), key=lambda r: (r[0] is None, r[0]))


@pytest.mark.parametrize("pivots", [1, 64])
def test_equals_brute_force(documents, monkeypatch, pivots):
    monkeypatch.setattr(minhash, "PIVOTS", pivots)
    rng = random.Random(3)
    base, rows = [prose(rng, 60, 5000) for _ in range(4)], []
    for text in base:
        for changes in (0, 0, 1, 1, 2, 2, 3, 3, 4):
            words = text.split()
            for _ in range(changes):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            rows.append(" ".join(words).upper() if changes == 1 else "  ".join(words))
    rows += ["", None, " ", "", "a b", "a b", "A  B", "a", "a b c d", "x " * 3000, "X " * 2000]
    assert run(documents(rows, extra=True)) == expected(list(enumerate(rows)))


def test_rows_that_share_or_lack_an_id(documents):
    one, two = prose(random.Random(1), 30), prose(random.Random(2), 30)
    got = run(documents([(3, one), (3, two), (5, one), (6, two), (None, one)]))
    assert [r[2:] for r in got] == [(3, True), (3, True), (3, False), (3, False), (None, True)]


def test_empty_table(documents):
    assert run(documents([])) == []


def test_signatures_estimate_similarity():
    a = np.unique(np.random.default_rng(0).integers(0, 2**63, 900, np.uint64))
    low, high = minhash.min_max(a[:800], 2000), minhash.min_max(a[200:], 2000)
    assert abs((low == high).mean() - 600 / 900) < 0.03


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 400), (7, 7)], "u bigint, v bigint")
    assert {tuple(r) for r in components(links).collect()} == {(i, 0) for i in range(101)} | {(400, 400), (500, 400)}
