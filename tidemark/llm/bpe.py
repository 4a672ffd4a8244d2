"""BPE encoding and decoding with a distinct-word table.

Texts are cut at ASCII white space. Each block of documents asks for its distinct words; a word meets all blocks that hold it
in one bucket, where it is encoded once; the ids go back to each block in the order in which it asked and are put in place of
the words, position by position. Decoding joins ids to their pieces; the piece table is as large as the vocabulary.

Fit for tokenizers that drop white space, so that the ids of a text are those of its words in order (checked on a probe).
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tidemark.llm import blocks as B

ENCODED = "doc_id bigint, ids array<int>, n_tokens bigint, ids_sha256 string"

_PROBE = "One two, 3 'll <x> naïve\tÅngström\n\n世界 !? end"


def read_tokenizer(path: str) -> str:
    """The tokenizer's JSON, read on the driver; some megabytes, sent with the tasks."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    probe = Tokenizer.from_str(text)
    whole = probe.encode(_PROBE, add_special_tokens=False).ids
    if whole != [i for word in _PROBE.split() for i in probe.encode(word, add_special_tokens=False).ids]:
        raise ValueError("the tokenizer does not encode word by word")
    return text


def pieces_of(tokenizer_json: str) -> dict[int, str]:
    """Id to piece, added tokens included. Only tokenizers without a decoder step: pieces are joined by a space."""
    model = json.loads(tokenizer_json)
    if model.get("decoder"):
        raise ValueError("the tokenizer has a decoder step")
    pieces = {i: piece for piece, i in model["model"]["vocab"].items()}
    return pieces | {t["id"]: t["content"] for t in model["added_tokens"]}


@lru_cache(1)
def _tokenizer(tokenizer_json: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_str(tokenizer_json)


def _id_type(tokenizer: Tokenizer) -> np.dtype:
    return np.dtype("<u2") if max(tokenizer.get_vocab().values(), default=0) < 1 << 16 else np.dtype("<u4")


def _distinct_words(texts: list[bytes], n_buckets: int) -> tuple[list[bytes], np.ndarray]:
    """A block's words in the order in which it asks for them, and their buckets."""
    words: set[bytes] = set()
    for text in texts:
        words.update(text.split())
    ordered = sorted(words)
    buckets = B.bucket_of(B.word_hashes(ordered), n_buckets)
    order = np.argsort(buckets, kind="stable")
    return [ordered[i] for i in order.tolist()], buckets[order]


class Pieces:
    """The id-to-piece table of a vocabulary, and texts by joining ids with it."""

    def __init__(self, tokenizer_json: str):
        pieces = pieces_of(tokenizer_json)
        self.table = np.array([pieces.get(i, "") for i in range(max(pieces, default=0) + 1)], object)
        self.known = np.zeros(len(self.table) + 1, bool)
        self.known[list(pieces)] = True

    def joined(self, ids: np.ndarray) -> str:
        ids = np.where((ids >= 0) & (ids < len(self.table)), ids, len(self.table))
        return " ".join(self.table[ids[self.known[ids]]].tolist())


@lru_cache(1)
def _pieces(tokenizer_json: str) -> Pieces:
    return Pieces(tokenizer_json)


def encode(docs: DataFrame, tokenizer_json: str, decoded: bool = False) -> DataFrame:
    """Per document the ids of its whole text, their number, and the SHA-256 of the ids as little-endian 32-bit integers; if
    ``decoded``, also what :func:`decode` makes of the ids, in the same pass.

    Equal to the library's ``encode(text, add_special_tokens=False)``. Null and empty texts have no ids. Only ``doc_id`` and
    ``text`` are read; every row returns a row, so repeated rows and null ids stay as they are; an empty table gives none.
    """
    docs = docs.select("doc_id", "text")
    n_buckets = B.parts(B.text_bytes(docs), B.BLOCK_BYTES)
    blocks = B.in_blocks(docs, n_buckets)
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def ask_words(table: pa.Table, _) -> Iterator[tuple[int, bytes]]:
        words, buckets = _distinct_words(B.texts_of(table), n_buckets)
        cuts = np.flatnonzero(np.diff(buckets, prepend=-1, append=n_buckets)).tolist()
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(buckets[start]), zstandard.compress(b"\n".join(words[start:end]))

    def encode_distinct(_, given: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        tokenizer = _tokenizer(shared.value)
        asked = [zstandard.decompress(payload).split(b"\n") for _, payload in given]
        distinct = sorted(set().union(*asked))
        ids: dict[bytes, bytes] = {}
        kind = _id_type(tokenizer)
        for start in range(0, len(distinct), 20_000):
            words = distinct[start : start + 20_000]
            for word, found in zip(words, tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False), strict=True):
                ids[word] = np.array(found.ids, kind).tobytes()
        for (block, _), words in zip(given, asked, strict=True):
            own = [ids[w] for w in words]
            sizes = np.fromiter(map(len, own), np.int64, len(own)) // kind.itemsize
            sizes = sizes.astype(np.min_scalar_type(int(sizes.max())))
            yield block, zstandard.compress(bytes([kind.itemsize, sizes.itemsize]) + np.uint32(len(own)).tobytes() + sizes.tobytes() + b"".join(own))

    def put_back(table: pa.Table, answers: dict[str, dict[int, bytes]]) -> pa.Table:
        texts = B.texts_of(table)
        words, _ = _distinct_words(texts, n_buckets)
        ids: list[bytes] = []
        width = 4
        for _, payload in sorted(answers.get("ids", {}).items()):
            payload = zstandard.decompress(payload)
            width, size_width, n = payload[0], payload[1], int(np.frombuffer(payload, np.uint32, 1, 2)[0])
            ends = 6 + size_width * n + width * np.cumsum(np.frombuffer(payload, f"<u{size_width}", n, 6).astype(np.int64))
            starts = np.concatenate(([6 + size_width * n], ends[:-1]))
            ids += [payload[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        place = dict(zip(words, ids, strict=True))
        del words, ids
        encoded = [np.frombuffer(b"".join(map(place.__getitem__, text.split())), f"<u{width}") for text in texts]
        del place
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        digests = [hashlib.sha256(e.astype("<u4")).hexdigest() for e in encoded]
        columns = []
        if decoded:
            pieces = _pieces(shared.value)
            columns = [pa.array([pieces.joined(e.astype(np.int64)) for e in encoded], pa.string())]
        values = pa.array(np.concatenate(encoded).astype(np.int32) if encoded else np.empty(0, np.int32))
        columns = [table.column("doc_id").cast(pa.int64()), pa.ListArray.from_arrays(offsets, values), pa.array(lengths), pa.array(digests, pa.string()), *columns]
        return pa.table(columns, names=["doc_id", "ids", "n_tokens", "ids_sha256", "decoded"][: len(columns)])

    answers = B.ask(blocks, None, "ids", ask_words, encode_distinct, n_buckets)
    return B.per_block(blocks, answers, put_back, ENCODED + (", decoded string" if decoded else ""))


def decode(encoded: DataFrame, tokenizer_json: str) -> DataFrame:
    """``encoded`` with a column ``decoded``: the pieces of ``ids`` in order, joined by a space.

    Equal to the library's ``decode(ids, skip_special_tokens=False)``; ids without a piece are passed over, a null list gives "".
    """
    shared = encoded.sparkSession.sparkContext.broadcast(tokenizer_json)
    pieces_of(tokenizer_json)  # refuses a tokenizer that this does not decode
    schema = encoded.drop("decoded").schema.add("decoded", "string")

    def join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared.value)
        for batch in batches:
            lists = (ids.values for ids in batch.column("ids"))
            texts = ["" if ids is None else pieces.joined(ids.to_numpy(zero_copy_only=False).astype(np.int64)) for ids in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.drop("decoded").mapInArrow(join_pieces, schema)
