import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.llm.conftest import prose
from tidemark.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.mark.parametrize("kind,eod", [("<u2", 9), ("<u2", 50256), ("<u4", 70000)])
@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_stitches_blocks(spark, tmp_path, kind, eod, block):
    rng, wanted = random.Random(block), []
    for f, tail in enumerate([0, 3, 0, 5, 0]):
        lengths = [rng.choice([0, 0, 1, 2, 9]) for _ in range(rng.randrange(1, 9))] if f != 2 else []
        tokens = [t for n in lengths for t in [*(rng.randrange(9) for _ in range(n)), eod]] + [1] * tail
        (tmp_path / f"{f}.bin").write_bytes(np.array(tokens, kind).tobytes())
        wanted += [(f, k, n) for k, n in enumerate(lengths + [tail] * bool(tail))]
    got = tc.count_tokens(spark, str(tmp_path), eod, block).collect()
    assert sorted((int(r["file"].split("/")[-1][0]), r["ordinal"], r["n_tokens"]) for r in got) == sorted(wanted)


def test_equals_the_library(documents, tmp_path, monkeypatch):
    monkeypatch.setattr(tc, "FILE_BYTES", 500)
    monkeypatch.setattr(tc, "BLOCK_TOKENS", 64)
    rng = random.Random(0)
    rows = [(i, prose(rng, rng.randrange(120))) for i in range(40)] + [(50, ""), (51, None), (52, "<|endoftext|>"), (53, "é世🙂" * 900), (7, "again"), (None, "no id")]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = tc.document_counts(documents(rows, extra=True), PATH, public_tokenizers.PATTERN, 50256, str(tmp_path / "t"))
    wanted = [(i, len(library.encode_ordinary(t or ""))) for i, t in rows]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, wanted))


def test_empty_table(documents, tmp_path):
    assert tc.document_counts(documents([]), PATH, public_tokenizers.PATTERN, 50256, str(tmp_path / "t")).count() == 0
