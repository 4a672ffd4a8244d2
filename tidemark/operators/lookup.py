"""Left look-ups of a large table in a reference, with the broadcast behind a check of its size."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import sieve as sieves
from tidemark.sinks.files import written_bytes

# A reference is broadcast when its columns, measured, take no more than this. The hash table that the driver builds and sends is three to five times
# as large, and a plan may hold several.
BROADCAST_BYTES = 16 * 1024 * 1024
# A key is treated as hot from this share of the rows on; the sketch returns at most 1 / share keys.
HOT_SHARE = 0.001
# Most versions of a key that an as-of look-up searches in a line; beyond that facts and versions are put in order together.
LINE_VERSIONS = 128
# Parts that a hot key with all rows would be cut into, for each shuffle partition.
PARTS_PER_PARTITION = 4


def measured_bytes(df: DataFrame) -> int:
    """Rows times fixed width plus the bytes of all strings: known from the write, or one aggregate."""
    known = written_bytes(df)
    if known is not None:
        return known
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    text = sum((F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in strings), start=F.lit(0))
    return df.agg((F.count(F.lit(1)) * 16 * len(df.columns) + text).alias("bytes")).first()["bytes"]


def left_lookup(
    facts: DataFrame,
    reference: DataFrame,
    fact_key: str,
    reference_key: str,
    also: Column | None = None,
    broadcast_bytes: int | None = None,
    measured: DataFrame | None = None,
    hot_from: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
    size: int | None = None,
) -> DataFrame:
    """``facts`` with the other columns of ``reference``, NULL where there is no match.

    ``also`` narrows the match further, as in a look-up by period; it names columns of either side.
    ``measured`` is what to measure instead of ``reference``, if something no smaller is cheaper to read, and ``size`` its bytes if they are known;
    ``hot_from`` is where to look for hot keys instead of ``facts``, if an earlier form of it is cheaper.

    A small reference is broadcast. A larger one is joined by shuffle, with the hot keys of ``facts`` cut
    into as many parts as their share asks for and the few matching reference rows repeated. Rows without a key
    stay out of the join. ``spread_by`` names columns that tell the rows of a hot key apart; without them rows are
    numbered in the order of the scan, which has to be repeatable, as that of files is.
    """
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    reference = reference.withColumnRenamed(reference_key, "_ref_key")
    if size is None:
        size = measured_bytes(reference if measured is None else measured)
    if size <= limit:
        match = F.col(fact_key) == F.col("_ref_key")
        joined = facts.join(F.broadcast(reference), match if also is None else match & also, "left")
        return joined.drop("_ref_key")
    hot = hot_keys(facts if hot_from is None else hot_from, fact_key)
    keyed, unkeyed = (facts.filter(F.col(fact_key).isNull() == without) for without in (False, True))
    found = _spread_lookup(keyed, reference, fact_key, also, hot, spread_by)
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in reference.schema.fields if f.name != "_ref_key"]
    return found.unionByName(unkeyed.select("*", *absent))


def _spread_lookup(
    facts: DataFrame, reference: DataFrame, fact_key: str, also: Column | None, hot: DataFrame, spread_by: Sequence[str] | None
) -> DataFrame:
    row = F.xxhash64(*spread_by) if spread_by else F.monotonically_increasing_id()
    facts = facts.join(F.broadcast(hot), F.col(fact_key) == F.col("_hot_key"), "left")
    facts = facts.withColumn("_salt", F.pmod(row, F.coalesce("_parts", F.lit(1)))).drop("_hot_key", "_parts")
    reference = reference.join(F.broadcast(hot), F.col("_ref_key") == F.col("_hot_key"), "left")
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)) - 1)
    reference = reference.withColumn("_ref_salt", F.explode(every_salt)).drop("_hot_key", "_parts")
    match = (F.col(fact_key) == F.col("_ref_key")) & (F.col("_salt") == F.col("_ref_salt"))
    joined = facts.join(reference, match if also is None else match & also, "left")
    return joined.drop("_ref_key", "_salt", "_ref_salt")


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Every key with more than ``share`` of the rows, at most 1 / share of them, and into how many parts to cut it.

    A sketch names the keys that may be hot; these are counted. The parts follow the key's share of the rows and the
    number of shuffle partitions.
    """
    spark = df.sparkSession
    keys = df.select(key).filter(F.col(key).isNotNull())
    sketch = keys.stat.freqItems([key], share).select(F.explode(f"{key}_freqItems").alias("_hot_key"))
    counted = keys.join(F.broadcast(sketch), F.col(key) == F.col("_hot_key"), "left").groupBy("_hot_key").agg(F.count(F.lit(1)).alias("rows")).collect()
    total, partitions = sum(r["rows"] for r in counted), int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = [
        (r["_hot_key"], math.ceil(PARTS_PER_PARTITION * partitions * r["rows"] / total))
        for r in counted
        if r["_hot_key"] is not None and r["rows"] > share * total
    ]
    kind = T.StructType([T.StructField("_hot_key", df.schema[key].dataType), T.StructField("_parts", T.LongType())])
    return spark.createDataFrame(parts, kind)


def as_of_lookup(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    day: Column,
    version_key: str,
    valid_from: str,
    value: str,
    broadcast_bytes: int | None = None,
    hot_from: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """``facts`` with the ``value`` of the version that was valid on ``day``: the latest that had begun, or the first one if none had.

    A missing day takes the latest version; a missing or unknown key gives NULL. While no key has more than ``LINE_VERSIONS`` versions,
    these are put in a line for each key, which is looked up by key like any reference. Otherwise the facts' distinct keys and days are put in order with
    the versions, and the last version is carried forward; so a key costs its days plus its versions, not their product, and one with a
    third of all facts has no more rows there than the calendar has days. The answers are joined back by key and day with
    :func:`left_lookup`, which splits a hot day of a hot key. ``hot_from`` is an earlier form of ``facts`` that ``day`` can be taken of.
    """
    when = F.coalesce(day.cast("date"), F.lit("9999-12-31").cast("date"))
    most, size = _line_sizes(versions, version_key)
    if most <= LINE_VERSIONS:
        version = F.struct(F.col(valid_from).alias("day"), F.col(value).alias("value"))
        told = versions.filter(F.col(version_key).isNotNull() & F.col(value).isNotNull())
        lines = told.groupBy(F.col(version_key).alias("_version_of")).agg(F.sort_array(F.collect_list(version)).alias("_line"))
        found = left_lookup(facts, lines, fact_key, "_version_of", broadcast_bytes=broadcast_bytes, hot_from=hot_from, spread_by=spread_by, size=size)
        begun = F.filter("_line", lambda v: v["day"].isNull() | (v["day"] <= when))
        last, first = F.try_element_at(begun, F.lit(-1)), F.try_element_at("_line", F.lit(1))
        return found.withColumn(value, F.coalesce(last["value"], first["value"])).drop("_line")
    moment = F.concat(F.unix_date("_day").cast("string"), F.lit(":"), F.col("_id").cast("string"))
    asked = facts.filter(F.col(fact_key).isNotNull()).select(F.col(fact_key).alias("_id"), when.alias("_day")).distinct()
    known = versions.select(F.col(version_key).alias("_id"), F.col(valid_from).alias("_day"), F.col(value).alias("_value"))
    nothing = F.lit(None).cast(versions.schema[value].dataType)
    line = known.withColumn("_asked", F.lit(False)).unionByName(asked.withColumns({"_value": nothing, "_asked": F.lit(True)}))
    order = Window.partitionBy("_id").orderBy("_day", "_asked")
    begun = F.last("_value", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = F.first("_value", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    answers = line.select(moment.alias("_moment"), "_asked", F.coalesce(begun, first).alias(value)).filter("_asked").drop("_asked")

    def keyed(df: DataFrame) -> DataFrame:
        at = F.concat(F.unix_date(when).cast("string"), F.lit(":"), F.col(fact_key).cast("string"))
        return df.withColumn("_at", at)

    hot = None if hot_from is None else keyed(hot_from)
    return left_lookup(keyed(facts), answers, "_at", "_moment", broadcast_bytes=broadcast_bytes, hot_from=hot, spread_by=spread_by).drop("_at")


def _line_sizes(versions: DataFrame, key: str) -> tuple[int, int]:
    """The most versions of a key, and the bytes of all keys with their versions' days and values."""
    text = F.octet_length(F.col(key).cast("string"))
    keys = versions.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    row = keys.agg(F.max("n").alias("most"), F.sum(64 + text + 32 * F.col("n")).alias("bytes")).first()
    return row["most"] or 0, row["bytes"] or 0


def validate_foreign_keys(
    df: DataFrame,
    fk_column: str,
    reference: DataFrame,
    pk_column: str,
    broadcast_bytes: int | None = None,
    hot_from: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
    stored: DataFrame | None = None,
    sieve: DataFrame | None = None,
    orphans: DataFrame | None = None,
) -> DataFrame:
    """Rows whose key exists in the reference or in ``stored`` (of the same key column), and rows without a key.

    If the keys are too many to broadcast, those of ``df`` that are not among them are looked for first: distinct keys are shuffled, not rows. They
    are usually few and then broadcast instead; ``orphans``, one column, are these keys where they are known. Otherwise rows are shuffled too.
    ``hot_from`` is an earlier form of ``df`` with all of its keys. ``sieve`` is a :mod:`tidemark.operators.sieve` over the keys of ``stored``. If the keys are too many to broadcast, rows that it and a
    sieve over the reference's keys refuse go before the shuffle; what passes is looked up exactly.
    """
    if fk_column not in df.columns or pk_column not in reference.columns:
        return df
    keys = reference.select(pk_column)
    if stored is not None:
        keys = keys.unionByName(stored.select(pk_column))
    keys = keys.filter(F.col(pk_column).isNotNull())
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    size = _total_bytes(reference, stored, pk_column)
    if size > limit:
        if orphans is None:
            orphans = orphan_rows(df if hot_from is None else hot_from, fk_column, keys, pk_column).select(fk_column)
        if measured_bytes(orphans) <= limit:
            few = orphans.toDF("_orphan")
            return df.join(F.broadcast(few), F.col(fk_column) == F.col("_orphan"), "left_anti")
    if sieve is not None and size > limit:
        df = sieves.sifted(df, fk_column, sieves.with_keys(sieve, reference.select(pk_column), pk_column), broadcast_bytes=broadcast_bytes)
    known = keys.distinct().withColumn("_known", F.lit(True))
    joined = left_lookup(df, known, fk_column, pk_column, broadcast_bytes=broadcast_bytes, hot_from=hot_from, spread_by=spread_by, size=size)
    return joined.filter(F.col("_known") | F.col(fk_column).isNull()).drop("_known")


def too_many(reference: DataFrame, pk_column: str) -> bool:
    """Whether a written table has more keys than are broadcast; one that was not written is not measured for this."""
    return (written_bytes(reference.select(pk_column)) or 0) > BROADCAST_BYTES


def _total_bytes(reference: DataFrame, stored: DataFrame | None, column: str) -> int:
    return sum(measured_bytes(df.select(column)) for df in (reference, stored) if df is not None)


def orphan_rows(df: DataFrame, fk_column: str, reference: DataFrame, pk_column: str) -> DataFrame:
    """Key values without a reference row and how many rows carry them.

    Rows are counted per key before the join, so a hot key travels once.
    """
    counted = df.filter(F.col(fk_column).isNotNull()).groupBy(fk_column).agg(F.count(F.lit(1)).alias("rows"))
    known = reference.select(F.col(pk_column).alias("_ref_key"))
    return counted.join(known, F.col(fk_column) == F.col("_ref_key"), "left_anti")
