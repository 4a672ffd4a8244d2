import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import prose
from tidemark.llm import blocks, bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), LIBRARY.decode(ids, skip_special_tokens=False)


def run(docs):
    tokenizer = bpe.read_tokenizer(PATH)
    one, two = (sorted((tuple(r) for r in df.collect()), key=str) for df in (bpe.encode(docs, tokenizer, True), bpe.decode(bpe.encode(docs, tokenizer), tokenizer)))
    assert one == two
    return [(doc_id, ids, n, digest, text) for doc_id, ids, n, digest, text in one]


def test_equals_the_library(documents, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 3000)
    rng = random.Random(0)
    rows = [prose(rng, rng.randrange(200)) for _ in range(30)]
    rows += ["", None, " \n\t", "<|endoftext|>a <|startoftext|>", "İstanbul ΣΑΣ é ́x     \x1c ﬁ", "it's 12 世界!! 🙂", "x" * 20000, "the " * 9000, rows[0], rows[0]]
    assert run(documents(rows, extra=True)) == sorted(((i, *expected(t)) for i, t in enumerate(rows)), key=str)


def test_rows_that_share_or_lack_an_id_and_empty_tables(documents):
    rows = [(None, "a b"), (None, "a b"), (2, "c"), (2, "d")]
    assert run(documents(rows)) == sorted(((i, *expected(t)) for i, t in rows), key=str)
    assert run(documents([])) == []


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_words_are_encoded_alone_as_in_the_text(text):
    ids = [i for word in text.encode("utf-8", "ignore").split() for i in LIBRARY.encode(word.decode(), add_special_tokens=False).ids]
    assert ids == LIBRARY.encode(text.encode("utf-8", "ignore").decode(), add_special_tokens=False).ids


def test_unknown_ids_are_passed_over(spark):
    done = bpe.decode(spark.createDataFrame([([3306, 10**6, -1],), ([],), (None,)], "ids array<int>"), bpe.read_tokenizer(PATH))
    assert [r["decoded"] for r in done.collect()] == ["hello</w>", "", ""]


def test_refuses_tokenizers_with_blanks():
    with pytest.raises(ValueError):
        bpe.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
