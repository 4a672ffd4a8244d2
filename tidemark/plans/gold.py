"""Silver to gold: the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import dates, money
from tidemark.operators.conform import conformed, misfits, unfit
from tidemark.operators.keys import kept_keys, surrogate_key
from tidemark.operators.lookup import as_of_lookup, left_lookup
from tidemark.operators.merge import OPEN_END, scd2_merge, upsert_rows
from tidemark.sinks.files import Store, leave

# The calendar's default span, the first day of a customer's first version, and the key of
# an unknown customer or product.
CALENDAR_START, CALENDAR_END = "2023-01-01", "2027-12-31"
FIRST_VALID_FROM = "2024-01-01"
UNKNOWN_KEY = -1

CUSTOMER_ATTRIBUTES = (
    "first_name", "last_name", "email", "phone", "address", "city", "state", "segment",
)


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day; Monday is day 0."""
    span = spark.range(1).select(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")).alias("days"))
    return calendar(span.select(F.explode("days").alias("full_date")))


def calendar(days: DataFrame) -> DataFrame:
    """The calendar attributes of the dates in ``full_date``."""
    d = F.col("full_date")
    return days.select(
        dates.date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        (F.dayofmonth(d) == 1).alias("is_month_start"),
        (F.last_day(d) == d).alias("is_month_end"),
        dates.is_holiday(d).alias("is_holiday"),
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    """Every customer as a first, current version."""
    keyed = surrogate_key(customers.select("customer_id", *CUSTOMER_ATTRIBUTES), "customer_key", ["customer_id"])
    return keyed.withColumns(
        {
            "valid_from": F.lit(FIRST_VALID_FROM).cast("date"),
            "valid_to": F.lit(OPEN_END).cast("date"),
            "is_current": F.lit(True),
        }
    )


def dim_product(products: DataFrame) -> DataFrame:
    return surrogate_key(_described_products(products), "product_key", ["product_id"])


def _described_products(products: DataFrame) -> DataFrame:
    price, cost = F.col("price"), F.col("cost_price")
    return products.select(
        "product_id", "name", "category", "subcategory", "price", "cost_price",
        money.price_range(price).alias("price_range"),
        money.margin_percent(price, cost).alias("margin_percent"),
        "supplier", "rating",
    )


def fact_key_lookup(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    as_of: bool = False,
    broadcast_bytes: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Surrogate keys for natural ones, -1 where there is none.

    ``as_of`` takes the customer version that was valid on the day of the order, of which the first counts from the beginning of time
    on and the last one for orders without a date; use it once the dimension holds history.
    """
    hot_from = orders if hot_from is None else hot_from
    spread_by = ["order_id"] if "order_id" in orders.columns else None
    options = {"broadcast_bytes": broadcast_bytes, "hot_from": hot_from, "spread_by": spread_by}
    if as_of:
        found = as_of_lookup(orders, customers, "customer_id", F.col("order_date"), "customer_id", "valid_from", "customer_key", **options)
    else:
        found = left_lookup(orders, customers.select("customer_key", F.col("customer_id").alias("_customer")), "customer_id", "_customer", **options)
    found = left_lookup(
        found,
        products.select("product_key", F.col("product_id").alias("_product")),
        "product_id",
        "_product",
        **options,
    )
    unknown = F.lit(UNKNOWN_KEY).cast("bigint")
    return found.withColumns(
        {
            "customer_key": F.coalesce("customer_key", unknown),
            "product_key": F.coalesce("product_key", unknown),
        }
    )


def date_membership(orders: DataFrame, days: DataFrame) -> DataFrame:
    """The order day's key, or the unknown key if the calendar lacks the day or the order has no date."""
    keyed = orders.withColumn("_day", dates.date_key(F.col("order_date")))
    known = days.select(F.col("date_key").alias("_known_day"), "date_key")
    found = left_lookup(keyed, known, "_day", "_known_day")
    return found.withColumn("date_key", F.coalesce("date_key", F.lit(dates.UNKNOWN_DATE_KEY))).drop("_day")


def fact_orders(
    orders: DataFrame,
    customers: DataFrame | None,
    products: DataFrame | None,
    days: DataFrame,
    as_of: bool = False,
    broadcast_bytes: int | None = None,
    known: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per order line, with all columns or only ``columns``; keys that are not asked for are not looked up.

    Orders are numbered before the look-ups: the pass that sizes the key buckets then reads nothing but
    the order id, and that for hot keys nothing but the foreign key. Orders that bring their ``order_key`` keep it, as do orders of the fact ``known``.
    """
    columns = list(columns or schemas.GOLD["fact_orders"].names)
    found = orders
    if "order_key" in columns and "order_key" not in found.columns:
        found = surrogate_key(found, "order_key", ["order_id"]) if known is None else kept_keys(found, known, "order_key", "order_id")
    if "customer_key" in columns or "product_key" in columns:
        found = fact_key_lookup(found, customers, products, as_of, broadcast_bytes, hot_from=orders)
    if "date_key" in columns:
        found = date_membership(found, days)
    derived = {
        "discount_amount": money.line_discount(F.col("quantity"), F.col("unit_price"), F.col("discount_percent")),
        "net_amount": F.col("total_amount"),
        "order_status": F.col("status"),
    }
    return found.select(*[derived.get(c, F.col(c)).alias(c) for c in columns])


def build_gold(
    spark: SparkSession, silver: Mapping[str, DataFrame], store: Store = leave, unknown_members: bool = False, rejected: Store = leave
) -> dict[str, DataFrame]:
    """The dimensions there is data for, and the fact once orders and both dimensions are there, in the types of the gold tables.

    With a ``store`` that writes, the fact looks its keys up in dimensions read from files. ``unknown_members`` adds the
    rows that unknown keys refer to. Fact rows whose numbers do not fit go to ``rejected``.
    """
    gold = {"dim_date": dim_date(spark)}
    if "customers" in silver:
        gold["dim_customer"] = conformed(dim_customer(silver["customers"]), "dim_customer")
    if "products" in silver:
        gold["dim_product"] = conformed(dim_product(silver["products"]), "dim_product")
    if unknown_members:
        gold = with_unknown_members(gold)
    gold = {name: store(name, df) for name, df in gold.items()}
    if "orders" in silver and "dim_customer" in gold and "dim_product" in gold:
        fact = fact_orders(silver["orders"], gold["dim_customer"], gold["dim_product"], gold["dim_date"])
        gold["fact_orders"] = _fitting(fact, store, rejected)
    return gold


def _fitting(fact: DataFrame, store: Store, rejected: Store) -> DataFrame:
    """The fact rows that fit; the others go to ``rejected``. They are counted while the former are written, and only looked up again if there are any."""
    if store is leave or rejected is leave:
        rejected("fact_orders", misfits(fact, "fact_orders"))
        return store("fact_orders", conformed(fact, "fact_orders"))
    seen = Observation()
    fits = store("fact_orders", conformed(fact.observe(seen, F.count_if(unfit(fact, "fact_orders")).alias("lost")), "fact_orders"))
    try:
        lost = seen.get["lost"]
    except Py4JJavaError:  # a plan that Spark knows to give no rows may be run without counting
        lost = None
    none = fact.sparkSession.createDataFrame([], fact.schema)
    rejected("fact_orders", none if lost == 0 else misfits(fact, "fact_orders"))
    return fits


def incremental_gold(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    existing: Mapping[str, DataFrame],
    effective: str,
    store: Store = leave,
    rejected: Store = leave,
) -> dict[str, DataFrame]:
    """A later batch of whatever tables: the dimensions with the batch merged in, and the fact rows of the batch alone.

    Known customers, products and orders keep their keys and new ones are numbered from the largest on; a dimension without a batch stays. Changed
    customers get a new version from ``effective`` on, and each order the version of its day. The fact rows are to be upserted by order id;
    orders that bring an ``order_key`` keep it, for the others ``existing`` needs the fact.
    """
    gold = {name: existing[name] for name in ("dim_date", "dim_customer", "dim_product")}
    if "customers" in silver:
        gold["dim_customer"] = store(
            "dim_customer",
            scd2_merge(
                existing["dim_customer"], silver["customers"], "customer_id", CUSTOMER_ATTRIBUTES, effective, "customer_key",
                store, FIRST_VALID_FROM,
            ),
        )
    if "products" in silver:
        described = _described_products(silver["products"])
        batch = conformed(kept_keys(described, existing["dim_product"], "product_key", "product_id"), "dim_product")
        gold["dim_product"] = store("dim_product", upsert_rows(existing["dim_product"], store("product_batch", batch), ["product_id"]))
    if "orders" in silver:
        known = None if "order_key" in silver["orders"].columns else existing["fact_orders"]
        fact = fact_orders(silver["orders"], gold["dim_customer"], gold["dim_product"], gold["dim_date"], as_of=True, known=known)
        gold["fact_orders"] = _fitting(fact, store, rejected)
    return gold


def with_unknown_members(gold: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Add a row for the unknown customer, product and day, so that every fact key has a dimension row."""
    spark = next(iter(gold.values())).sparkSession
    members = dict(gold)
    day = calendar(spark.range(1).select(F.lit("1900-01-01").cast("date").alias("full_date")))
    members["dim_date"] = gold["dim_date"].unionByName(day)
    for name, key, natural in (("dim_customer", "customer_key", "customer_id"), ("dim_product", "product_key", "product_id")):
        if name not in gold:
            continue
        values = {c.name: F.lit(None).cast(c.dataType) for c in gold[name].schema.fields}
        values[key] = F.lit(UNKNOWN_KEY).cast("bigint")
        values[natural] = F.lit("unknown")
        if name == "dim_customer":
            values |= {"valid_from": F.lit("1900-01-01").cast("date"), "valid_to": F.lit(OPEN_END).cast("date"), "is_current": F.lit(True)}
        row = spark.range(1).select(*[v.alias(c) for c, v in values.items()])
        members[name] = gold[name].unionByName(row)
    return members
