"""Audits of the gold tables: row contracts, keys, and whether the warehouse is filled."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.dates import UNKNOWN_DATE_KEY
from tidemark.operators.lookup import orphan_rows
from tidemark.plans.gold import UNKNOWN_KEY


def _rules(contract: schemas.RowContract) -> dict[str, Column]:
    """Rule name -> whether a row breaks it. A missing value breaks ``required`` only."""
    broken = {f"{c} required": F.col(c).isNull() for c in contract.required}
    broken.update({f"{c} max_length": F.length(c) > n for c, n in contract.max_length.items()})
    broken.update({f"{c} above": F.col(c) <= F.lit(n) for c, n in contract.above.items()})
    broken.update({f"{c} at_least": F.col(c) < F.lit(n) for c, n in contract.at_least.items()})
    broken.update({f"{c} at_most": F.col(c) > F.lit(n) for c, n in contract.at_most.items()})
    return broken


def flag_violations(df: DataFrame, contract: schemas.RowContract) -> DataFrame:
    """Each row with the names of the rules it breaks."""
    names = [F.when(broken, F.lit(rule)) for rule, broken in _rules(contract).items()]
    return df.withColumn("violations", F.array_compact(F.array(*names)))


def row_contract_audit(df: DataFrame, table: str, contract: schemas.RowContract | None = None) -> DataFrame:
    """Rows that break each rule, all rules in one pass; rules nobody breaks count zero."""
    rules = _rules(contract or schemas.CONTRACTS[table])
    counts = df.agg(*[F.count_if(broken).alias(f"r{i}") for i, broken in enumerate(rules.values())])
    rows = [
        F.struct(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


def distinct_numbers(df: DataFrame, key: str) -> DataFrame:
    """One row: ``n`` rows, ``filled`` and ``different`` values of a whole-number column, in one pass.

    Each task sets bits, 32,768 numbers to a bitmap of 4 KB; the bitmaps of a range meet by OR. For dense surrogate keys this shuffles a bit
    for each key, where a distinct count shuffles the key itself and expands the rows. Scattered numbers cost a bitmap each: use it for dense ones.
    """
    c = F.col(key).cast("bigint")
    ranges = df.groupBy(F.bitmap_bucket_number(c).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.count(c).alias("filled"), F.bitmap_construct_agg(F.bitmap_bit_position(c)).alias("bits")
    )
    total = lambda v: F.coalesce(F.sum(v), F.lit(0)).cast("bigint")
    marked = F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits"))
    return ranges.agg(total("n").alias("n"), total("filled").alias("filled"), total(marked).alias("different"))


def key_integrity_audit(gold: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated or missing primary keys of every table, and fact rows whose key has no dimension row."""
    parts = []
    for name, df in gold.items():
        key = schemas.PRIMARY_KEYS[name]
        broken = {
            "primary key repeated": F.col("filled") - F.col("different"),
            "not null": F.col("n") - F.col("filled"),
        }
        parts.append(_audit_rows(distinct_numbers(df, key), name, key, broken))
    for key, dimension in schemas.FOREIGN_KEYS.items():
        orphans = orphan_rows(gold["fact_orders"], key, gold[dimension], schemas.PRIMARY_KEYS[dimension])
        total = orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
        parts.append(_audit_rows(total, "fact_orders", key, {"foreign key": F.col("n")}))
    return reduce(DataFrame.unionByName, parts)


def _audit_rows(counts: DataFrame, table: str, column: str, broken: Mapping[str, Column]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(rule).alias("rule"),
            violations.cast("bigint").alias("violations"),
        )
        for rule, violations in broken.items()
    ]
    return counts.select(F.inline(F.array(*rows)))


def orphan_audit(fact: DataFrame) -> DataFrame:
    """Fact rows without a known customer, product or day, in one pass."""
    return fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_if(F.col("customer_key") == UNKNOWN_KEY).alias("orphan_customers"),
        F.count_if(F.col("product_key") == UNKNOWN_KEY).alias("orphan_products"),
        F.count_if(F.col("date_key") == UNKNOWN_DATE_KEY).alias("unknown_dates"),
    )


def warehouse_monitor(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, whether the table is empty, which is an error, and when its latest row was loaded, where the table knows."""
    counts = []
    for name, df in tables.items():
        latest = F.max(schemas.LOADED_AT) if schemas.LOADED_AT in df.columns else F.lit(None)
        counted = df.agg(F.count(F.lit(1)).alias("row_count"), latest.cast("timestamp").alias("latest"))
        counts.append(counted.select(F.lit(name).alias("table_name"), "row_count", (F.col("row_count") == 0).alias("is_empty"), "latest"))
    return reduce(DataFrame.unionByName, counts)


def require_filled(tables: Mapping[str, DataFrame]) -> None:
    """Raise when a warehouse table is empty."""
    empty = [r["table_name"] for r in warehouse_monitor(tables).filter("is_empty").collect()]
    if empty:
        raise ValueError(f"empty tables: {', '.join(empty)}")
