"""Dense surrogate keys 1..N without bringing the table to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the hash that choose the bucket: 16 ** 4 buckets, a fixed number. Keep it at several
# times the number of shuffle partitions; five digits are the most that should be broadcast as offsets.
BUCKET_DIGITS = 4


def key_bucket(order_by: Sequence[str], digits: int = BUCKET_DIGITS) -> Column:
    """A bucket that depends on the row alone and is even whatever the ids look like."""
    joined = F.concat_ws("|", *[F.col(c).cast("string") for c in order_by])
    return F.left(F.md5(joined), F.lit(digits))


def surrogate_key(
    df: DataFrame, name: str, order_by: Sequence[str], start: Column | int = 0, digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Add ``name`` = start + 1 .. start + N, ordered by hash bucket and then by ``order_by``.

    ``order_by`` must identify a row. The buckets' sizes come from one partial aggregate over these
    columns (at most 16 ** digits rows, turned into offsets and broadcast); the rows are then numbered bucket
    by bucket. Everything is a function of the data, so a lost task can be run again.
    """
    start = F.lit(start) if isinstance(start, int) else start
    bucketed = df.withColumn("_bucket", key_bucket(order_by, digits))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_bucket").alias("_offset_bucket"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order_by))
    numbered = bucketed.withColumn("_position", position).join(
        F.broadcast(offsets), F.col("_bucket") == F.col("_offset_bucket")
    )
    key = (start + F.col("_offset") + F.col("_position")).cast("bigint")
    return numbered.select(key.alias(name), *df.columns)


def kept_keys(df: DataFrame, known: DataFrame, name: str, natural: str) -> DataFrame:
    """Add ``name``: the key that ``known`` has for the natural key, or the next ones after its largest.

    Only new natural keys are numbered, and only the two key columns of ``known`` are read. ``df`` has one row for each
    natural key, which has to be filled.
    """
    pairs = known.select(F.col(natural).alias("_known_id"), F.col(name).alias("_known_key")).filter(F.col(natural).isNotNull())
    last = known.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
    same = F.col(natural) == F.col("_known_id")
    old = df.join(pairs, same).select(F.col("_known_key").alias(name), *df.columns)
    new = df.join(pairs, same, "left_anti")
    return old.unionByName(surrogate_key(new, name, [natural], start=F.greatest(last, F.lit(0))))
