"""Bronze to silver: cleaned, typed, deduplicated tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import labels, money
from tidemark.functions.dates import as_moment
from tidemark.operators import cleaning, dedup, filters, lookup, nulls
from tidemark.sinks.files import Store, leave

# What a missing phone number and a missing stock become.
PHONE_FILL = "fill_value:N/A"
STOCK_FILL = "fill_value:0"


def processed_at(df: DataFrame, now=None) -> DataFrame:
    return df.withColumn("processed_at", as_moment(now).cast("timestamp"))


def silver_customers(
    df: DataFrame, order_by: Sequence[str], now=None, normalize_first: bool = False
) -> DataFrame:
    """One row per e-mail address as it was recorded.

    Addresses are compared before they are cleaned, so variants in capitals survive and the uniqueness
    check reports them; ``normalize_first`` compares the cleaned addresses instead.
    """
    if normalize_first:
        df = cleaning.clean_email(df, "email")
    df = dedup.remove_duplicates(df, ["email"], order_by=order_by)
    df = cleaning.normalize_names(df, ["first_name", "last_name"])
    df = cleaning.clean_email(df, "email")
    df = nulls.handle_nulls(df, {"phone": PHONE_FILL})
    df = cleaning.standardize_strings(df, ["state"])
    df = df.withColumn("segment", labels.segment(F.col("segment")))
    df = cleaning.parse_dates(df, ["registration_date"])
    return processed_at(df, now)


def silver_products(df: DataFrame, order_by: Sequence[str], now=None) -> DataFrame:
    """One row per product, with positive prices and a cost below the price."""
    df = dedup.remove_duplicates(df, ["product_id"], order_by=order_by)
    df = cleaning.fix_negative_values(df, ["price", "cost_price"])
    df = cleaning.rewrite(df, ["price", "cost_price"], money.to_money)
    df = nulls.handle_nulls(df, {"stock_quantity": STOCK_FILL})
    df = df.withColumn("stock_quantity", F.col("stock_quantity").cast("bigint"))
    df = cleaning.normalize_names(df, ["category", "subcategory"])
    df = df.withColumn("cost_price", money.plausible_cost(F.col("price"), F.col("cost_price")))
    df = cleaning.parse_dates(df, ["created_at"])
    return processed_at(df, now)


def silver_orders(df: DataFrame, order_by: Sequence[str], now=None) -> DataFrame:
    """One row per order line id, past and with a quantity, its total recomputed."""
    df = _slimmed(df, ["order_id", *order_by], now)
    df = dedup.remove_duplicates(df, ["order_id"], order_by=order_by)
    df = cleaning.standardize_strings(df, ["payment_method"])
    df = df.withColumn("status", labels.order_status(F.col("status")))
    df = filters.remove_future_dates(df, "order_date", now)
    df = filters.valid_quantity(df)
    df = cleaning.fix_negative_values(df, ["unit_price"])
    df = cleaning.rewrite(df, ["unit_price", "shipping_cost", "discount_percent"], money.to_money)
    total = money.line_total(F.col("quantity"), F.col("unit_price"), F.col("discount_percent"))
    df = df.withColumn("total_amount", total)
    return processed_at(df, now)


def _slimmed(df: DataFrame, keys: Sequence[str], now=None) -> DataFrame:
    """``df`` with only its ``keys`` left in the rows that :func:`silver_orders` drops once they have been compared with their duplicates.

    Such a row still decides which of its duplicates is first, but takes nothing else through the shuffle and the sorts. It lacks a quantity then, by
    which it is dropped. Dates are parsed on the way. Nothing changes where rows are compared by their quantity, or this is no number.
    """
    if "quantity" in keys or not isinstance(df.schema["quantity"].dataType, T.NumericType):
        return df
    keep = F.col("quantity") > 0
    if "order_date" in df.columns and "order_date" not in keys:
        df = cleaning.parse_dates(df, ["order_date"])
        keep &= F.col("order_date").isNull() | (F.col("order_date") <= as_moment(now))
    slim = {c: F.when(F.col("_keep"), F.col(c)).alias(c) for c in df.columns if c not in keys}
    return df.withColumn("_keep", keep).select(*[slim.get(c, F.col(c)) for c in df.columns])


PARENTS = (("customers", "customer_id"), ("products", "product_id"))


def valid_orders(
    orders: DataFrame,
    silver: Mapping[str, DataFrame],
    broadcast_bytes: int | None = None,
    known: Mapping[str, DataFrame] | None = None,
    sieves: Mapping[str, DataFrame] | None = None,
    missing: DataFrame | None = None,
) -> DataFrame:
    """Orders whose customer and product, where given, survived the cleaning or are ``known`` from earlier batches.

    ``missing`` is what :func:`missing_parents` says of the same tables, if it is written.
    """
    kept, known, sieves = orders, known or {}, sieves or {}
    for name, key in PARENTS:
        if name in silver or name in known:
            reference = silver.get(name, known.get(name))
            stored, sieve = (known.get(name), sieves.get(name)) if name in silver else (None, None)
            orphans = None
            if missing is not None and missing.schema["value"].dataType == orders.schema[key].dataType:
                orphans = missing.filter(F.col("column_name") == key).select("value")
            kept = lookup.validate_foreign_keys(
                kept, key, reference, key, broadcast_bytes, hot_from=orders, spread_by=["order_id"], stored=stored, sieve=sieve, orphans=orphans
            )
    return kept


def missing_parents(orders: DataFrame, silver: Mapping[str, DataFrame], known: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``column_name``, ``value`` and ``rows`` of the customers and products that orders name and neither the batch nor an earlier one has."""
    sources, known = {}, known or {}
    for name, key in PARENTS:
        if given := [tables[name].select(key) for tables in (silver, known) if name in tables]:
            sources[key] = reduce(DataFrame.unionByName, given)
    if not sources:
        return orders.sparkSession.createDataFrame([], "column_name string, value string, rows bigint")
    if len({orders.schema[key].dataType for key in sources}) == 1 and all(df.schema[key].dataType == orders.schema[key].dataType for key, df in sources.items()):
        named = F.array(*[F.struct(F.lit(key).alias("column_name"), F.col(key).alias("value")) for key in sources])
        counted = orders.select(F.inline(named)).filter("value IS NOT NULL").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))
        there = reduce(DataFrame.unionByName, [df.select(F.lit(key).alias("column_name"), F.col(key).alias("value")) for key, df in sources.items()])
        return counted.join(there, ["column_name", "value"], "left_anti").select("column_name", "value", "rows")
    parts = [
        lookup.orphan_rows(orders, key, df, key).select(F.lit(key).alias("column_name"), F.col(key).alias("value"), "rows") for key, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def build_silver(
    bronze: Mapping[str, DataFrame],
    order_by: Mapping[str, Sequence[str]],
    now=None,
    normalize_first: bool = False,
    store: Store = leave,
    known: Mapping[str, DataFrame] | None = None,
    sieves: Mapping[str, DataFrame] | None = None,
    rejected: Store = leave,
) -> dict[str, DataFrame]:
    """Whichever of customers, products and orders are given. ``order_by`` decides which duplicate is first.

    With a ``store`` that writes, orders are checked against customers and products read from files. ``known`` are customers and products of
    earlier batches, by their ids, which orders may name too, and ``sieves`` those over their ids. What orders name and nobody knows goes to ``rejected``, counted,
    or to ``store`` if there is no other place and parents are too many to broadcast: it is then found once, before the orders are read in full.
    """
    silver: dict[str, DataFrame] = {}
    if "customers" in bronze:
        customers = silver_customers(bronze["customers"], order_by["customers"], now, normalize_first)
        silver["customers"] = store("customers", customers)
    if "products" in bronze:
        silver["products"] = store("products", silver_products(bronze["products"], order_by["products"], now))
    if "orders" in bronze:
        missing, aside = None, rejected
        if rejected is leave and any(lookup.too_many(tables[name], key) for name, key in PARENTS for tables in (silver, known or {}) if name in tables):
            aside = store
        if aside is not leave:
            missing = aside("missing_parents", missing_parents(bronze["orders"], silver, known))
        orders = silver_orders(valid_orders(bronze["orders"], silver, known=known, sieves=sieves, missing=missing), order_by["orders"], now)
        silver["orders"] = store("orders", orders)
    return silver
