"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import as_moment
from tidemark.operators.cleaning import parse_dates


def remove_future_dates(df: DataFrame, date_column: str, now=None) -> DataFrame:
    """Drop rows strictly later than ``now``; rows without a date stay."""
    if date_column not in df.columns:
        return df
    df = parse_dates(df, [date_column])
    moment = F.col(date_column)
    return df.filter(moment.isNull() | (moment <= as_moment(now)))


def valid_quantity(df: DataFrame, column: str = "quantity") -> DataFrame:
    """Drop zero, negative and missing quantities."""
    return df.filter(F.col(column) > 0)


def priced_products(df: DataFrame, column: str = "price") -> DataFrame:
    """Products with a price above zero, or every product when none has one.

    The test for "none" is an aggregate inside the same query, so nothing is run beforehand.
    """
    any_priced = df.agg(F.coalesce(F.bool_or(F.col(column) > 0), F.lit(False)).alias("any_priced"))
    return df.filter((F.col(column) > 0) | ~any_priced.scalar())
