import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidemark.llm import suffix_tree as st


def expected(rows, learnt):
    docs = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    counts, n = [collections.Counter() for _ in range(st.DEPTH + 1)], 0
    for i, w in docs:
        if learnt(i):
            n += len(w)
            for k in range(st.DEPTH + 1):
                counts[k].update(tuple(w[j : j + k + 1]) for j in range(len(w) - k))
    states = set()

    def p(w, context):
        if not context:
            return (counts[0][w,] + 1) / (n + len(counts[0]) + 1)
        shorter = p(w, context[1:])
        if context not in states:
            return shorter
        return (counts[len(context)][(*context, w)] + st.STRENGTH * shorter) / (counts[len(context) - 1][context] + st.STRENGTH)

    for k in range(1, st.DEPTH + 1):
        gain = collections.Counter()
        for gram, c in counts[k].items():
            context = gram[:-1]
            if c > 1 and counts[k - 1][context] >= st.MIN_COUNT and (k == 1 or counts[k - 2][context[:-1]] >= st.MIN_COUNT):
                gain[context] += c * math.log(c) - (c - 1) * math.log(p(gram[-1], context[1:]))
        states |= {s for s, g in gain.items() if g > counts[k - 1][s] * math.log(counts[k - 1][s])}
    out = []
    for i, w in docs:
        score = sum(math.log10(p(x, tuple(w[max(0, j - st.DEPTH) : j]))) for j, x in enumerate(w))
        out.append((i, len(w), sum(counts[0][x,] > 0 for x in w), n, sum(math.log10(p(x, ())) for x in w), score))
    return out, states


@pytest.mark.parametrize("each", [800, 1 << 20])
def test_equals_brute_force(documents, monkeypatch, each):
    monkeypatch.setattr(st, "EACH", each)
    rng = random.Random(0)
    passage = [prose(rng, 12, 300) for _ in range(6)]
    rows = [(i, " ".join(x for _ in range(4) for x in (prose(rng, 10, 60), rng.choice(passage)))) for i in range(80)]
    rows += [(90, ""), (91, None), (92, " \n"), (93, "THE the The " * 900), (94, "x" * 9000), (1, rows[1][1]), (None, "no id")]
    wanted, states = expected(rows, lambda i: i is not None and i % 4 != 0)
    assert {1, 2} == {len(s) for s in states}
    got = st.score(documents(rows, extra=True), F.col("doc_id") % 4 != 0).collect()
    order = lambda r: (str(r[0]), r[1])
    for ours, theirs in zip(sorted(map(tuple, got), key=order), sorted(wanted, key=order), strict=True):
        assert ours[:4] == theirs[:4] and ours[4:] == pytest.approx(theirs[4:], rel=1e-9)


def test_nothing_to_learn_from(documents):
    got = st.score(documents([(0, "a b"), (4, "")]), F.lit(False)).collect()
    assert sorted(map(tuple, got)) == [(0, 3, 0, 0, 0.0, 0.0), (4, 1, 0, 0, 0.0, 0.0)]
    assert st.score(documents([]), F.lit(True)).count() == 0
