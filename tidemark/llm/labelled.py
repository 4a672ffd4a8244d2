"""Labelled samples for training: bounded, and the same in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(remainder: int, modulus: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id does not."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, learnt: Column, per_class: int) -> DataFrame:
    """``doc_id``, ``text``, ``label`` of at most ``per_class`` documents of each class, those with the smallest hashes of their ids.

    Only rows that ``learnt`` allows, with an id and a label of 0 or 1; of several labels the smallest counts, and an id with
    several texts counts once, with the smallest.
    """
    given = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).where(learnt).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    chosen = [given.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])  # at most 2 * per_class ids: small enough to broadcast
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
