import hashlib
import random

import pytest

from tests.llm.conftest import prose
from tidemark.llm import blocks, substring_dedup


def expected(rows, window):
    docs = sorted(((i, (t or "").encode().split()) for i, t in rows), key=lambda r: (r[0] is None, r[0]))
    key = lambda i: float("inf") if i is None else i
    first = {}
    for i, w in docs:
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), key(i))
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < key(i):
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def run(docs, window):
    return [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.remove_repeats(docs, window).collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("window", [1, 4, 13])
def test_equals_brute_force(documents, monkeypatch, window):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 4000)
    rng = random.Random(window)
    shared = [prose(rng, n) for n in (13, 14, 25, 60)]
    rows = [" ".join(x for _ in range(3) for x in (prose(rng, rng.randrange(30)), rng.choice(shared) if rng.random() < 0.5 else "")) for _ in range(60)]
    rows += [rows[3], rows[3], shared[0], "x" * 5000, "a " * 3000, "", None, " \t\n", "Ein Übermaß an  Wörtern"]
    assert order(run(documents(rows, extra=True), window)) == order(expected(list(enumerate(rows)), window))


def test_rows_that_share_or_lack_an_id(documents):
    text = " ".join(map(str, range(20)))
    rows = [(5, text), (5, text), (None, text), (None, text + " z"), (7, text)]
    got = order(run(documents(rows), 13))
    assert [r[:3] for r in got] == [(5, 20, 0), (5, 20, 0), (7, 20, 20), (None, 20, 20), (None, 21, 20)]


def test_empty_table(documents):
    assert run(documents([]), 13) == []


def test_covers_hold_every_difference():
    for period, cover in substring_dedup.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_rows_without_an_id_are_dealt_out_evenly(documents):
    rows = [(None if i % 3 == 0 else i, f"text {i}") for i in range(1500)]
    dealt = blocks.in_blocks(documents(rows), 8).collect()
    sizes = {}
    for r in dealt:
        sizes[r["block"]] = sizes.get(r["block"], 0) + len(r["ids"])
    assert len(sizes) == 8 and max(sizes.values()) < 1.5 * 1500 / 8
