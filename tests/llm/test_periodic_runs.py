import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import prose
from tidemark.llm import periodic_runs, recompression


def runs(words, shortest=12):
    """Every maximal stretch for every period, the smallest period of each kept."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(shortest, 2 * p):
                found.setdefault((start, i + p), p)
            i = max(i, start + 1)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(i, text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    if i is not None and words and zlib.crc32(str(i).encode()) % 10 == 0:
        g = zlib.crc32(str(i).encode()) // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    found = sorted(runs(words), key=lambda r: (r[0], r[2]))
    dropped = {k for s, n, p in found for k in range(s + p, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    milli = 1000 * best[1] // best[2] if found else None
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    return (i, len(found), *best, milli, sha(lines), sha(" ".join(w for k, w in enumerate(words) if k not in dropped)))


@pytest.mark.parametrize("letters", [1, 2, 3, 40])
def test_runs_of_sequences(letters):
    rng = np.random.default_rng(letters)
    for shortest in (2, 12):
        docs = [rng.integers(0, letters, n) for n in (0, 1, 11, 12, 13, 70, 200)]
        docs += [np.concatenate((rng.integers(0, letters, 9), np.tile(rng.integers(0, letters, p), 9)[: 60 + p])) for p in (1, 2, 5, 20)]
        docs += [docs[-1], docs[-1]]
        for d, found in zip(docs, periodic_runs.runs_of(docs, shortest), strict=True):
            assert sorted(zip(*(c.tolist() for c in found), strict=True)) == runs(d.tolist(), shortest)


def test_agreement_of_places():
    rng = np.random.default_rng(5)
    words = np.append(np.concatenate([np.tile(rng.integers(0, 3, n), 3) for n in (1, 4, 30, 50)]), 9)
    levels = recompression.grammar(words)
    i, j = (c.ravel() for c in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    i, j = i[i != j], j[i != j]
    got = recompression.agreement(levels, i, j)
    for a, b, n in zip(i[::7], j[::7], got[::7], strict=True):
        k = 0
        while max(a, b) + k < len(words) and words[a + k] == words[b + k]:
            k += 1
        assert k == n
    assert len(np.unique(levels[-1].symbols)) == len(levels[-1].symbols) and len(levels) < 60


def test_query_equals_brute_force(documents, monkeypatch):
    monkeypatch.setattr(periodic_runs, "GROUP_BYTES", 3000)
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randrange(1, 120), rng.choice([2, 400]))) for i in range(-20, 80)]
    rows += [(200, "a " * 3000), (201, ("ä\x0bb\tc " * 40) + "ä"), (202, ""), (203, None), (204, " \n"), (205, "x" * 4000), (None, "q r " * 9), (7, "a " * 30), (7, "a " * 30)]
    order = lambda rows: sorted(rows, key=repr)
    found = periodic_runs.summarised(periodic_runs.find_runs(periodic_runs.with_periods(documents(rows, extra=True))))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [expected(i, t) for i, t in rows]
    assert sum(w[1] > 0 for w in want) > 20
    assert order(tuple(r) for r in found.collect()) == order(want)


def test_empty_table_and_spans(documents):
    assert periodic_runs.find_runs(documents([])).collect() == []
    row = periodic_runs.find_runs(documents(["x a b a b a b a b a b a b y"])).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 12, 2)] and row["kept"] == "x a b y"
