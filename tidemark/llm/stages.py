"""The stages of the corpus pipeline. All but the last return the columns that they are given.

Rows that share a ``doc_id`` go through every stage, near-duplicates among them as any others; a null or empty text has an empty bag of passages, is
linked with nothing, loses nothing and is never taken by the mix. Empty tables stay empty. Other columns, whatever their names, are passed on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import bpe, minhash, mixing
from tidemark.llm import quality as quality_model
from tidemark.llm import substring_dedup as substrings
from tidemark.llm.components import stored
from tidemark.llm.labelled import held_out

TOKENIZER = "word_bpe_49k.json"


def _free_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def _with_text(docs: DataFrame, text: Column) -> list[Column]:
    """``docs`` with another ``text``, and ``n_chars`` to match."""
    n_chars = [F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars")] if "n_chars" in docs.columns else []
    changed = {"text": text.alias("text"), **{"n_chars": c for c in n_chars}}
    return [changed.get(c, F.col(f"a.`{c}`")) for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from the given labels and ``docs``, without the rows held out for tests."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model, name = quality_model.fit(docs, labels, ~held_out(2, 4)), _free_name(docs, "score")
    return quality_model.score(docs, model, name).where(F.col(name) >= quality_model.ACCEPTED).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row, one with the smallest id; rows without an id come last.

    Rows are told apart by numbers of their own, so copies that share an id or have none are one group too.
    """
    row, component = _free_name(docs, "row"), _free_name(docs, "component")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = minhash.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), F.col("component_id").alias(component))
    ids = rows.select(F.col(row).alias("_row"), "doc_id").join(found, "_row")
    first = F.row_number().over(Window.partitionBy(component).orderBy(F.asc_nulls_last("doc_id"), "_row"))
    kept = ids.withColumn("_place", first).where("_place = 1").select("_row")
    return rows.join(kept, rows[row] == kept["_row"], "left_semi").drop(row)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that a document with a smaller id has too; other texts stay as they are."""
    found = substrings.remove_repeats(docs).where("n_removed > 0").select("doc_id", "text_sha256", "kept").dropDuplicates(["doc_id", "text_sha256"])
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.sha2(F.col("a.text").cast("binary"), 256) == F.col("b.text_sha256"))
    joined = docs.alias("a").join(found.alias("b"), same, "left")
    return joined.select(*_with_text(docs, F.coalesce("b.kept", "a.text")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row for each document and pass over its source."""
    return mixing.mixed_texts(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and digests of the ids and of the text they decode to."""
    tokenizer = bpe.read_tokenizer(public_tokenizers.path(TOKENIZER))
    done = bpe.encode(docs, tokenizer, decoded=True)
    return done.select("doc_id", "n_tokens", "ids", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
