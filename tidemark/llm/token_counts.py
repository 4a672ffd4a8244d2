"""Token counts of flat token files by a separator scan.

A token file is nothing but token ids, little-endian, each document followed by an end-of-document id; there is no index. Files are
read as bytes and cut into blocks of a fixed number of tokens. Each block searches its separators with one vector comparison and
reports the lengths between them; running sums of the separators of a file's blocks number the documents, and the part of a
document at the end of a block is added to the part at the start of the next ones.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import blocks as B

#: Tokens that one vector comparison looks at.
BLOCK_TOKENS = 1 << 20
#: Bytes after which a writing task begins another file. binaryFile reads a file whole, so files have to stay well below 2 GiB.
FILE_BYTES = 8 << 20


def token_type(eod: int) -> np.dtype:
    return np.dtype("<u2") if eod < 1 << 16 else np.dtype("<u4")


def write_token_files(docs: DataFrame, ranks_file: bytes, pattern: str, eod: int, path: str) -> None:
    """Encode every whole text to ``path``/kind=tokens/part=*, one flat file a part; kind=ids has the ids of its documents in order.

    Both files of a part come from one task and are committed with it. ``ranks_file`` holds a byte-level BPE as lines of a
    base64 token and its rank. Null and empty texts have no tokens, only their separator.
    """
    kind = token_type(eod)
    separator = np.array([eod], kind).tobytes()
    ranks = docs.sparkSession.sparkContext.broadcast(ranks_file)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.value.splitlines())}
        encoding = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        part, held, ids, size = 0, [], [], 0

        def file() -> pa.RecordBatch:
            name = f"{TaskContext.get().partitionId():06d}-{part:06d}"
            names = ",".join("" if i is None else str(i) for i in ids).encode()
            return pa.RecordBatch.from_arrays([pa.array(["tokens", "ids"]), pa.array([name, name]), pa.array([separator.join(held), names], pa.binary())], names=["kind", "part", "value"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held.append(np.array(encoding.encode_ordinary(text or ""), kind).tobytes())
                ids.append(doc_id)
                size += len(held[-1]) + len(separator)
                if size >= FILE_BYTES:
                    yield file()
                    part, held, ids, size = part + 1, [], [], 0
        if ids:
            yield file()

    files = docs.select("doc_id", "text").mapInArrow(encode, "kind string, part string, value binary")
    # The writer puts the line separator, here the end-of-document id, behind each value; a string cast keeps bytes as they are.
    writer = files.withColumn("value", F.col("value").cast("string")).write.partitionBy("kind", "part")
    writer.option("encoding", "ISO-8859-1").option("lineSep", separator.decode("latin-1")).text(path)


def count_tokens(spark: SparkSession, path: str, eod: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``file``, ``ordinal`` (from 0) and ``n_tokens`` (without separators) of each document in the token files under ``path``.

    Documents of no tokens count; tokens behind a file's last separator are a document of their own; an empty file has none.
    """
    kind = token_type(eod)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                tokens = np.frombuffer(content.as_buffer(), kind)
                starts = range(0, len(tokens), block_tokens)
                lengths = []
                for start in starts:
                    block = tokens[start : start + block_tokens]
                    ends = np.flatnonzero(block == eod)
                    lengths.append(np.diff(np.concatenate(([-1], ends, [len(block)]))) - 1)
                columns = [pa.array([name] * len(lengths), pa.string()), pa.array(range(len(lengths)), pa.int64()), pa.array(lengths, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "lengths"])

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    found = raw.mapInArrow(search, "file string, block bigint, lengths array<bigint>")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    numbered = found.withColumn("before", F.coalesce(F.sum(F.size("lengths") - 1).over(earlier), F.lit(0)))
    later = F.lead("block").over(Window.partitionBy("file").orderBy("block"))
    numbered = numbered.withColumn("last", later.isNull())
    parts = numbered.select("file", "before", "last", F.size("lengths").alias("n"), F.posexplode("lengths").alias("k", "tokens"))
    whole = parts.withColumn("open", F.col("last") & (F.col("k") == F.col("n") - 1))
    counted = whole.groupBy("file", (F.col("before") + F.col("k")).alias("ordinal")).agg(F.sum("tokens").alias("n_tokens"), F.max("open").alias("open"))
    return counted.where("NOT open OR n_tokens > 0").drop("open")


def document_counts(docs: DataFrame, ranks_path: str, pattern: str, eod: int, path: str) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every row: the texts written to token files under ``path``, and the files scanned.

    Every row returns a row, also rows that repeat or have a null id; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    with open(ranks_path, "rb") as file:
        write_token_files(docs, file.read(), pattern, eod, path)
    if "part" not in spark.read.text(path).columns:  # no file was written
        return spark.createDataFrame([], "doc_id bigint, n_tokens bigint")
    counts = count_tokens(spark, f"{path}/kind=tokens", eod)
    names = spark.read.text(f"{path}/kind=ids", wholetext=True).select("value", F.regexp_extract(F.input_file_name(), "part=([0-9-]+)", 1).alias("part"))
    ids = names.select("part", F.posexplode(F.split(F.regexp_extract("value", "^[0-9,-]*", 0), ",")).alias("ordinal", "id"))
    counts = counts.withColumn("part", F.regexp_extract("file", "part=([0-9-]+)", 1))
    return ids.join(counts, ["part", "ordinal"]).select(F.nullif(F.col("id"), F.lit("")).cast("bigint").alias("doc_id"), "n_tokens")
