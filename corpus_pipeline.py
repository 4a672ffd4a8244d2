"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again before the next one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import stages
from tidemark.llm.queries import importable
from tidemark.session import scratch_path, shuffles_dropped

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", stages.quality),
    ("near_dedup", stages.near_dedup),
    ("substring_dedup", stages.substring_dedup),
    ("mixing", stages.mixing_stage),
    ("encoding", stages.encoding),
]

#: A trained classifier and a tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with shuffles_dropped(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
