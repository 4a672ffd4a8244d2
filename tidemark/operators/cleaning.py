"""Column cleaning over a list of columns; names the DataFrame lacks are skipped."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates, money, text


def rewrite(df: DataFrame, columns: Iterable[str], change: Callable[[Column], Column]) -> DataFrame:
    """Apply one expression to several columns in a single projection."""
    changed = {name: change(F.col(name)) for name in columns if name in df.columns}
    return df.withColumns(changed) if changed else df


def standardize_strings(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Trim and lower-case. NULL stays NULL."""
    return rewrite(df, columns, lambda c: text.standardized(c.cast("string")))


def normalize_names(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return rewrite(df, columns, lambda c: text.title_case(c.cast("string")))


def clean_email(df: DataFrame, column: str) -> DataFrame:
    return rewrite(df, [column], text.valid_email)


def mask_tax_id(df: DataFrame, column: str) -> DataFrame:
    return rewrite(df, [column], text.masked_tax_id)


def fix_negative_values(df: DataFrame, columns: Iterable[str], strategy: str = "absolute") -> DataFrame:
    """``absolute`` drops the sign, ``zero`` raises to zero, anything else changes nothing."""
    if strategy == "absolute":
        return rewrite(df, columns, F.abs)
    if strategy == "zero":
        return rewrite(df, columns, lambda c: F.when(c < 0, F.lit(0)).otherwise(c))
    return df


def round_currency(df: DataFrame, columns: Iterable[str], decimals: int = 2) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    changed = {
        name: money.rounded(F.col(name), decimals, isinstance(kinds[name], T.DecimalType))
        for name in columns
        if name in kinds
    }
    return df.withColumns(changed) if changed else df


def parse_dates(df: DataFrame, columns: Iterable[str], date_format: str | Sequence[str | None] | None = None) -> DataFrame:
    """Text to timestamp, by a format or the first of several that fits; what cannot be read becomes NULL. Columns that are dates already stay."""
    textual = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return rewrite(df, [c for c in columns if c in textual], lambda c: dates.parsed_timestamp(c, date_format))


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of "missing": NaN compares above every number in Spark, NULL does not."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return rewrite(df, floats, lambda c: F.nanvl(c, F.lit(None)))
