"""Rows in the types of the gold tables, and the rows that do not fit them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas


def unfit(df: DataFrame, table: str) -> Column:
    """Whether a value is lost by the narrower type."""
    lost = [
        F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        for f in schemas.GOLD[table].fields
        if isinstance(f.dataType, (T.DecimalType, T.IntegerType)) and df.schema[f.name].dataType != f.dataType
    ]
    return reduce(or_, lost, F.lit(False))


def conformed(df: DataFrame, table: str) -> DataFrame:
    """Columns in the order and types of the gold table, without the rows of :func:`misfits`."""
    fits = df.filter(~unfit(df, table))
    return fits.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.GOLD[table].fields])


def misfits(df: DataFrame, table: str) -> DataFrame:
    """Rows with a number that the gold table has no room for, as they are."""
    return df.filter(unfit(df, table))
