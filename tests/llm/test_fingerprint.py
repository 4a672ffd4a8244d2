import hashlib
import random

import numpy as np
import pytest

from tests.llm.conftest import prose
from tidemark.llm import blocks, fingerprint as fp


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = (fp.vectors(t.encode()) for t in (text, edited, after))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.text_form(a), fp.text_form(b), fp.likeness(a, b), fp.likeness(a, c)))
    return out


def run(docs):
    return sorted((tuple(r) for r in fp.compare_edits(docs).collect()), key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.mark.parametrize("each", [300, 1 << 20])
def test_equals_brute_force(documents, monkeypatch, each):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", each)
    rng = random.Random(0)
    rows = [(i * 7 - 40, "\n".join(prose(rng, rng.randrange(30)) for _ in range(3)) + "é世") for i in range(30)]
    rows += [(500, ""), (501, None), (502, "x\n" * 4000), (503, "y" * 9000), (600, "a"), (None, "no id")]
    assert run(documents(rows, extra=True)) == expected(rows)


def test_single_row_and_empty_table(documents):
    assert run(documents([(4, "abcdef")])) == expected([(4, "abcdef")])
    assert run(documents([])) == []


def test_repeated_rows(documents):
    rows = [(1, "b"), (1, "a"), (1, "a"), (0, "c")]
    assert sorted(run(documents(rows))) == sorted(expected(rows))


def test_multisets():
    one, two = b"first\nsecond\nthird " * 3, b"other\n" * 3 + b"last"
    whole = fp.vectors(one + b"\n" + two)
    same = lambda a, b: fp.text_form(a) == fp.text_form(b)
    assert same(fp.added(fp.vectors(one), fp.vectors(two)), whole)
    assert same(fp.removed(whole, fp.vectors(two)), fp.vectors(one))
    assert same(fp.vectors(b"a\nb\nc"), fp.vectors(b"c\na\nb"))
    assert not same(fp.vectors(b"a\nb"), fp.vectors(b"a\nb\nb"))
    assert fp.likeness(fp.vectors(b""), fp.vectors(b"")) == 1 and fp.likeness(fp.vectors(b""), fp.vectors(b"a")) < 0.1


def test_likeness_estimates_the_common_share():
    rng = np.random.default_rng(0)
    lines = [rng.integers(33, 126, 40, np.uint8).tobytes().replace(b"\n", b"x") for _ in range(300)]
    found = [fp.likeness(fp.vectors(b"\n".join(lines[:200])), fp.vectors(b"\n".join(lines[200 - k :][:200]))) for k in (200, 150, 100)]
    assert np.allclose(found, [1, 0.75, 0.5], atol=0.2)


def test_likeness_of_long_repeats_and_shifted_lines():
    line = b"the same line of forty-one characters, xx"
    many = b"\n".join([line] * 65536)
    assert fp.likeness(fp.vectors(many), fp.vectors(many + b"\nz")) > 0.99
    text = prose(random.Random(5), 3000, 10**6).encode()
    assert fp.likeness(fp.vectors(text), fp.vectors(b"q" + text)) > 0.99
    assert fp.likeness(fp.vectors(text), fp.vectors(prose(random.Random(6), 3000, 10**6).encode())) < 0.3


def test_pieces_join_to_the_line():
    for line in (b"", b"a", b"ab" * 500, bytes(range(256)) * 9):
        assert b"".join(fp.pieces(line)) == line
    cut = fp.pieces(prose(random.Random(7), 20000, 10**6).encode())
    assert 20 < sum(map(len, cut)) / len(cut) < 50
