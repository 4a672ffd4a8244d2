"""Bringing new rows into an existing table: upsert and type-2 history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import lookup
from tidemark.operators.dedup import require_unique
from tidemark.operators.keys import surrogate_key
from tidemark.session import shuffles_dropped
from tidemark.sinks.files import Store, leave

# Fixed value: the end of a period that is still open.
OPEN_END = "9999-12-31"


def upsert_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], untouched: DataFrame | None = None) -> DataFrame:
    """``target`` with the rows of ``source`` replacing those of equal keys and the rest added.

    Columns the source lacks keep their target value, and are NULL for new rows. Source keys must not
    repeat (see ``dedup.require_unique``). ``untouched`` is what :func:`untouched_rows` says of the same tables, if it was asked.
    """
    keys = list(keys)
    if untouched is None:
        untouched = target.join(source.select(*keys), keys, "left_anti").select(*target.columns)
    kept = [c for c in target.columns if c not in source.columns]
    if kept:
        old = target.select(*[F.col(k).alias(f"_old_{k}") for k in keys], *kept)
        matches = [F.col(k) == F.col(f"_old_{k}") for k in keys]
        source = source.join(old, matches, "left").drop(*[f"_old_{k}" for k in keys])
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    return source.select(*typed).unionByName(untouched)


def untouched_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], broadcast_bytes: int | None = None) -> DataFrame:
    """The rows of ``target`` whose key ``source`` does not have, and those without a key.

    Keys are compared by themselves first. Those that stay are broadcast while they are few, as where a batch brings most of what it touches again, so that
    the rows of ``target`` are not shuffled; otherwise they are.
    """
    keys, limit = list(keys), lookup.BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    unkeyed = reduce(or_, [F.col(k).isNull() for k in keys])
    stay = target.select(*keys).filter(~unkeyed).join(source.select(*keys), keys, "left_anti").distinct()
    with shuffles_dropped(target.sparkSession):
        size = lookup.measured_bytes(stay)
    if size > limit:
        return target.join(source.select(*keys), keys, "left_anti").select(*target.columns)
    marked = target.join(F.broadcast(stay.withColumn("_stays", F.lit(True))), keys, "left")
    return marked.filter(F.col("_stays") | unkeyed).select(*target.columns)


def scd2_merge(
    dimension: DataFrame,
    incoming: DataFrame,
    natural_key: str,
    attributes: Sequence[str],
    effective: str | Column,
    surrogate: str,
    store: Store = leave,
    first_from: str | None = None,
) -> DataFrame:
    """Type-2 history: every version lasts until the day before the next one begins, whatever order the changes arrive in.

    ``effective`` as text is the day of ``incoming`` as a whole, one row for each natural key: a row that differs from the version in force
    on that day begins a new one there, also between older ones. As a column it is the day of each row, of which a natural
    key may have many: each is a change from its day on and begins a version, so that shuffled batches give the history of sorted ones.
    A change on the very day a version began replaces its attributes; the version keeps its key. A natural key that is new
    gets its first version, of a whole from ``first_from`` if given; one that is missing from ``incoming`` stays as it is, and so do columns of
    the dimension that are neither key, attribute nor period. Rows without a natural key are left out; a day may not be missing.

    Old versions and changes meet in one shuffle by natural key; all else are windows over that order. New versions are numbered after
    the largest key in use. With a ``store`` that writes, this is done once; otherwise reading the result may repeat it.
    """
    whole = isinstance(effective, str)
    day = F.lit(effective) if whole else F.coalesce(effective, F.raise_error(F.lit("a change without a day")))
    changes = incoming.select(natural_key, *attributes, day.cast("date").alias("valid_from")).filter(F.col(natural_key).isNotNull())
    require_unique(changes, [natural_key, "valid_from"], "the source of a history")
    merged = store("versions", _versions(dimension, changes, natural_key, list(attributes), surrogate, whole, first_from))
    last_key = merged.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()
    unkeyed = merged.filter(F.col(surrogate).isNull()).drop(surrogate)
    order = [natural_key] if whole else [natural_key, "valid_from"]
    added = surrogate_key(unkeyed, surrogate, order, start=F.greatest(last_key, F.lit(0))).select(*dimension.columns)
    return merged.filter(F.col(surrogate).isNotNull()).unionByName(added)


def _versions(
    dimension: DataFrame, changes: DataFrame, natural_key: str, attributes: list[str], surrogate: str, whole: bool, first_from: str | None
) -> DataFrame:
    """The versions after ``changes``, new ones without a key."""
    columns, kinds = dimension.columns, {f.name: f.dataType for f in dimension.schema.fields}
    given = {natural_key, "valid_from", *attributes}
    fresh = changes.select(*[(F.col(c) if c in given else F.lit(None)).cast(kinds[c]).alias(c) for c in columns], F.lit(True).alias("_new"))
    both = dimension.withColumn("_new", F.lit(False)).unionByName(fresh)
    history = Window.partitionBy(natural_key).orderBy("valid_from", "_new")

    def near(shift, c: str | Column) -> Column:
        return shift(c).over(history)

    # A change on the day a version began: the change takes over what the version has besides its attributes.
    with_next = near(F.lead, "_new") & (near(F.lead, "valid_from") == F.col("valid_from")) & ~F.col("_new")
    with_last = F.col("_new") & ~near(F.lag, "_new") & (near(F.lag, "valid_from") == F.col("valid_from"))
    paired = both.withColumns({"_replaced": F.coalesce(with_next, F.lit(False)), "_replaces": F.coalesce(with_last, F.lit(False))})
    inherited = {c: F.when(F.col("_replaces"), near(F.lag, c)).otherwise(F.col(c)) for c in columns if c not in given}
    kept = paired.withColumns(inherited).filter("NOT _replaced").withColumn("_new", F.col("_new") & ~F.col("_replaces"))
    if whole:  # what is in force on the day says the same: the version before or, before all versions, the first one
        state = F.struct(*attributes)
        in_force = F.coalesce(near(F.lag, state), near(F.lead, state))
        known = near(F.lag, "_new").isNotNull() | near(F.lead, "_new").isNotNull()
        kept = kept.withColumns({"_said": F.col("_new") & known & state.eqNullSafe(in_force), "_known": known}).filter("NOT _said")
        if first_from is not None:
            first = F.col("_new") & ~F.col("_known")
            kept = kept.withColumn("valid_from", F.when(first, F.lit(first_from).cast("date")).otherwise(F.col("valid_from")))
    kept = kept.withColumns({"_next": near(F.lead, "valid_from"), "_next_new": F.coalesce(near(F.lead, "_new"), F.lit(False))})
    until, new = F.date_sub("_next", 1), F.col("_new")
    periods = {
        "valid_to": F.when(new, F.coalesce(until, F.lit(OPEN_END).cast("date"))).when(F.col("_next_new"), F.least("valid_to", until)).otherwise(F.col("valid_to")),
        "is_current": F.when(new, F.col("_next").isNull()).otherwise(F.col("is_current") & ~F.col("_next_new")),
    }
    return kept.withColumns(periods).select(*columns)
