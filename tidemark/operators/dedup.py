"""Duplicates. "First" and "last" need an order, since a distributed table has none of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shuffles_dropped


def remove_duplicates(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    keep: str | bool = "first",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One row per ``subset``; NULLs count as equal to each other.

    keep="first" / "last": the first or last row in ``order_by``. The filter ``row_number = 1`` lets
    Catalyst put a group limit in front of the shuffle, so each map task sends one row per key and a key
    that holds a third of the table (all rows without an email, say) is no hot spot.
    keep=False: only rows that have no duplicate, by a partial aggregate rather than a window, for the
    same reason.
    """
    if subset is None and keep in ("first", "last"):
        return df.dropDuplicates()
    keys = list(subset) if subset is not None else df.columns
    if keep is False:
        return _without_repeats(df, keys)
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    if not order_by:
        raise ValueError("keeping the first or last row needs order_by columns")
    direction = (lambda c: F.col(c).asc_nulls_first()) if keep == "first" else (lambda c: F.col(c).desc_nulls_last())
    window = Window.partitionBy(*keys).orderBy(*[direction(c) for c in order_by])
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _without_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    single = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"), *[F.first(c).alias(c) for c in others])
    return single.filter("_copies = 1").select(*df.columns)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key values that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise when a key repeats; only whether there is one comes back, never the rows."""
    with shuffles_dropped(df.sparkSession):
        unique = repeated_keys(df, keys).isEmpty()
    if not unique:
        raise ValueError(f"{what} repeats a value of {list(keys)}")
