"""Column statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Filled and missing values per column, all columns in one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(c).alias("filled"), (F.col("_rows") - F.col(c)).alias("missing")
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*rows)))


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Exact number of different values; missing ones do not count."""
    return df.agg(F.count_distinct(column).alias("distinct_values"))


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value of numeric columns, one row per column, in one pass."""
    ends = [e for i, c in enumerate(columns) for e in (F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"))]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"lo{i}").cast("double").alias("min_value"),
            F.col(f"hi{i}").cast("double").alias("max_value"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*ends).select(F.inline(F.array(*rows)))


def latest_timestamp(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("latest"))
