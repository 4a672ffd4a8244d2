import math

import numpy as np
import pytest

from tidemark.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, group int, ids string"


def expected(rows, k=5):
    found = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            found.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for n, (q, own) in enumerate(found):
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(own, v, strict=False)), c) for m, (c, v) in enumerate(found) if m != n)
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in topk.top_k(df, "vec_id % 50 = 0").collect())


@pytest.mark.parametrize("spread", [0, 1])
def test_equals_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "VECTORS", 40)
    monkeypatch.setattr(topk, "QUERIES", 2)
    monkeypatch.setattr(topk, "GROUP", 2)
    rng = np.random.default_rng(spread)
    x = rng.normal(size=(300, 24)) @ np.diag(0.7 ** np.arange(24)) * np.exp(spread * rng.normal(size=(300, 1)))
    rows = [(i - 100, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    rows += [(500 + i, rows[4][1]) for i in range(9)] + [(550, rows[4][1]), (600, None), (650, [1.0, None]), (700, [float("nan")]), (750, [float("inf"), 1.0]), (800, []), (850, [0.0] * 24), (None, [1.0]), (900, [0.5] * 3), (900, [0.25] * 3)]
    assert run(spark, rows) == expected(rows)


def test_few_or_no_candidates(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (3, [-2.0]), (50, [0.1])]) == expected([(0, [1.0]), (3, [-2.0]), (50, [0.1])])


def test_repeated_ids_and_large_components(spark):
    rows = [(50, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [0.5, 1.0]), (2, [2.0**46, 0.0]), (3, [-1.0, 0.25]), (100, [0.0, 2.0**45]), (100, [1.0, 1.0]), (100, [1.0, 1.0])]
    assert run(spark, rows[:5]) == expected(rows[:5]) and len(run(spark, rows[:5])) == 4
    assert run(spark, rows) == expected(rows)


def test_scores_beyond_floating_point():
    q, x = np.array([[2**30, 3]]), np.array([[2**29 + 1, 7], [-(2**30), 1]])
    assert topk.exact_scores(q, x).tolist() == [[2**30 * (2**29 + 1) + 21, -(2**60) + 3]]
    big = np.array([[2**52]])
    assert topk.exact_scores(big, big).tolist() == [[2**63 - 1]]
