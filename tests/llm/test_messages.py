import numpy as np

from tidemark.llm import suffix_tree as st


def test_requests_are_small_and_come_back():
    rng = np.random.default_rng(0)
    keys, n_buckets = np.unique(rng.integers(0, 1 << 64, 200_000, np.uint64)), 50
    counts = np.where(rng.random(len(keys)) < 0.9, 1, rng.integers(0, 300, len(keys))).astype(np.uint64)
    for short, most in ((True, 4.5), (False, 8)):
        sent = dict(st._sent(keys, [counts], n_buckets, short))
        assert len(sent) == n_buckets and sum(map(len, sent.values())) < most * len(keys)
        got = [st._received([(0, sent[b])], 1, short)[1] for b in range(n_buckets)]
        assert np.array_equal(np.concatenate([c for _, c in got]), counts)
        assert all(len(np.unique(k)) == len(k) and (np.diff(k.astype(np.float64)) > 0).all() for k, _ in got)
        if not short:
            assert np.array_equal(np.concatenate([k for k, _ in got]), keys)
    values = [np.array([0, 7, 1 << 40], np.uint64), np.array([0, 1.5, -2], np.float32)]
    assert all(np.array_equal(a, b) for a, b in zip(values, st.widened(st.narrow(values), 2), strict=True))
    assert [len(c) for c in st.widened(st.narrow([np.empty(0, np.uint64)] * 2), 2)] == [0, 0]
