"""The whole run: bronze tables in, checked silver and gold layers out."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import sieve
from tidemark.operators.key_index import KeyIndex
from tidemark.plans.gold import UNKNOWN_KEY, build_gold, incremental_gold
from tidemark.plans.silver import build_silver
from tidemark.quality.checks import run_suite
from tidemark.quality.report import dq_gate, report_text
from tidemark.quality.suites import SUITES
from tidemark.sinks import warehouse
from tidemark.sinks.files import Store, discard, layer_store, written_bytes
from tidemark.sources.layers import current_path, read_table

log = logging.getLogger(__name__)

# The fact is partitioned by year and month of the order day.
FACT_PARTITIONS = ("year", "month")
# What a later batch of orders may refer to, beside its own tables: dimension, id and surrogate key.
KNOWN = {"customers": ("dim_customer", "customer_id", "customer_key"), "products": ("dim_product", "product_id", "product_key")}
# A sieve is built anew once this share of its bits is set.
FULL = 0.5


def check_layer(tables: Mapping[str, DataFrame], suites: Mapping[str, Mapping] = SUITES, now=None) -> DataFrame:
    """The results of every table's suite."""
    results = None
    for name, suite in suites.items():
        if name in tables:
            part = run_suite(tables[name], suite, now)
            results = part if results is None else results.unionByName(part)
    if results is None:
        raise ValueError("no table has a suite")
    return results


def run_medallion(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    base: str,
    order_by: Mapping[str, Sequence[str]],
    now=None,
    suites: Mapping[str, Mapping] = SUITES,
    warehouse_database: str | None = None,
    effective: str | None = None,
) -> dict[str, DataFrame]:
    """Write silver, check it, write gold, and optionally load it into catalogue tables.

    A critical check that fails stops the run before gold. A batch that finds the warehouse filled is merged into it, whichever tables
    it has: its orders may name customers and products of earlier batches, keys stay, and changed customers get a new version from
    ``effective`` on.
    """
    rejected = layer_store(base, "rejected")
    root = f"{base.rstrip('/')}/warehouse"
    known, sieves = earlier(spark, warehouse_database) if warehouse_database else ({}, {})
    silver = build_silver(bronze, order_by, now, store=layer_store(base, "silver"), known=known, sieves=sieves, rejected=rejected)
    results = layer_store(base, "quality")("results", check_layer(silver, suites, now).coalesce(1)) if set(silver) & set(suites) else None
    if results is not None:
        log.info(report_text(results))
        dq_gate(results)
    store = layer_store(base, "gold")
    if not warehouse_database:
        return build_gold(spark, silver, store, unknown_members=True, rejected=rejected)
    return load_warehouse(spark, silver, root, warehouse_database, effective, store, rejected, now)


def _place(spark: SparkSession, database: str) -> str:
    """Where a database keeps what goes with its tables."""
    return spark.sql(f"DESCRIBE DATABASE {database}").filter("info_name = 'Location'").first()["info_value"].rstrip("/")


def earlier(spark: SparkSession, database: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The ids of the customers and products that a warehouse holds, and the sieves over them; nothing for one that is still empty."""
    known, sieves = {}, {}
    if not spark.catalog.databaseExists(database):
        return known, sieves
    for name, (table, natural, key) in KNOWN.items():
        if spark.catalog.tableExists(f"{database}.{table}") and not spark.table(f"{database}.{table}").isEmpty():
            known[name] = spark.table(f"{database}.{table}").filter(F.col(key) != UNKNOWN_KEY).select(natural)
            sieves[name] = read_table(spark, f"{_place(spark, database)}/sieves/{name}")
    return known, sieves


def keep_sieves(spark: SparkSession, silver: Mapping[str, DataFrame], database: str) -> None:
    """Put the batch's ids into the stored sieves; one that is new or full is built over the whole dimension."""
    place = _place(spark, database)
    for name, (table, natural, key) in KNOWN.items():
        if name not in silver:
            continue
        path, batch = f"{place}/sieves/{name}", silver[name].select(natural)
        extended = None
        if current_path(spark, path) != path and sieve.n_blocks(read_table(spark, path)) is not None:
            extended = sieve.with_keys(read_table(spark, path), batch, natural)
        if extended is None or sieve.fill(extended) > FULL:
            ids = spark.table(f"{database}.{table}").filter(F.col(key) != UNKNOWN_KEY).select(natural)
            extended = sieve.sieve(ids, natural, sieve.blocks_for(ids.count()))
        layer_store(place, "sieves")(name, extended)


def load_warehouse(
    spark: SparkSession, silver: Mapping[str, DataFrame], root: str, database: str, effective: str | None, store: Store, rejected: Store, now=None
) -> dict[str, DataFrame]:
    """The first batch fills the star schema; later ones are merged in, the fact by the months that they touch.

    Orders find their keys and the months they were in through an index beside the fact (``key_index``); one whose day changed leaves its old
    month. Tables and the fact's partitions are written to folders of their own and switched, under the place of the first batch's ``root``.
    """
    warehouse.create_star_schema(spark, database, root, {"fact_orders": FACT_PARTITIONS})
    place, fact_table = _place(spark, database), f"{database}.fact_orders"
    index = KeyIndex(spark, f"{place}/order_index", "order_id", "order_key", FACT_PARTITIONS)
    existing = {name: spark.table(f"{database}.{name}") for name in schemas.GOLD}
    later, keyed, old_places = not existing["dim_date"].isEmpty(), None, None
    if not later:
        gold = build_gold(spark, silver, store, unknown_members=True, rejected=rejected)
    else:
        if effective is None:
            raise ValueError("a later batch needs the day from which its changes hold")
        if "orders" in silver and index.exists():
            keyed = store("orders_keyed", index.keyed(silver["orders"]))
            places = keyed.select(F.inline("_places")).distinct()
            old_places = spark.createDataFrame(places.collect(), places.schema)  # as few as directory names
            silver = {**silver, "orders": keyed}
        gold = incremental_gold(spark, silver, existing, effective, store, rejected)
        if keyed is not None and written_bytes(gold["fact_orders"]) is not None:
            discard(keyed)
    changed = {"dim_date": not later, "dim_customer": not later or "customers" in silver, "dim_product": not later or "products" in silver}
    for name, df in gold.items():
        if changed.get(name):
            columns = [c for c in df.columns if c in (*schemas.GOLD[name].names, schemas.LOADED_AT)]
            warehouse.load_table(df.select(*columns), f"{database}.{name}", place, "replace", now)
    keep_sieves(spark, silver, database)
    if "fact_orders" in gold:
        day = F.col("date_key")
        fact = gold["fact_orders"].withColumns({"year": F.floor(day / 10000).cast("int"), "month": (F.floor(day / 100) % 100).cast("int")})
        index.record(fact)
        warehouse.upsert_table_partitions(fact, fact_table, ["order_id"], FACT_PARTITIONS, place, old_places, now)
    return gold
