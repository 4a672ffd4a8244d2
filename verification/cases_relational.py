"""Look-ups, duplicates, keys and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.labels import ORDER_STATUSES
from tidemark.operators import dedup, keys, lookup
from tidemark.plans import gold, sales, silver
from tidemark.quality import audits, checks, profile
from tidemark.session import scratch_path
from tidemark.sinks import files
from verification import tables_sql as q
from verification.bronze import NOW, ORDER_BY, bronze, given, raw_customers, raw_orders, raw_products
from verification.registry import case


def clean(spark, sf_dir):
    """Silver, each table written before the next one reads it."""
    return silver.build_silver(bronze(spark, sf_dir), ORDER_BY, NOW, store=written(spark, "silver"))


def star(spark, sf_dir, silver_tables=None, unknown_members=False):
    """Gold on top of written silver; only the fact is left to the query that asked for it."""
    store = written(spark, "gold")
    return gold.build_gold(
        spark,
        silver_tables or clean(spark, sf_dir),
        store=lambda name, df: df if name == "fact_orders" else store(name, df),
        unknown_members=unknown_members,
    )


def dated_sales(spark, sf_dir):
    """The two columns of the fact that calendar questions need, and the calendar; no customer or product is looked up."""
    days = gold.dim_date(spark)
    orders = clean(spark, sf_dir)["orders"]
    return gold.fact_orders(orders, None, None, days, columns=["date_key", "total_amount"]), days


def stored_star(spark, sf_dir):
    """Gold with the fact written too, for queries that read it several times."""
    return gold.build_gold(spark, clean(spark, sf_dir), store=written(spark, "gold"))


def written(spark, layer):
    return files.layer_store(scratch_path(spark, "layers"), layer)


def masters(spark, sf_dir):
    """Silver customers and products, written."""
    tables = {"customers": raw_customers(spark, sf_dir), "products": raw_products(spark, sf_dir)}
    return silver.build_silver(tables, ORDER_BY, NOW, store=written(spark, "silver"))


@case("validate_foreign_keys", "SELECT order_id, customer_id, product_id, l_partkey, l_suppkey FROM valid_orders")
def validate_foreign_keys(spark, sf_dir):
    kept = silver.valid_orders(raw_orders(spark, sf_dir), masters(spark, sf_dir))
    return kept.select("order_id", "customer_id", "product_id", "l_partkey", "l_suppkey")


@case("validate_foreign_keys_spread", "SELECT order_id, customer_id, product_id, l_partkey, l_suppkey FROM valid_orders")
def validate_foreign_keys_spread(spark, sf_dir):
    """The same without any broadcast of the reference: shuffle joins with the hot keys spread."""
    kept = silver.valid_orders(raw_orders(spark, sf_dir), masters(spark, sf_dir), broadcast_bytes=0)
    return kept.select("order_id", "customer_id", "product_id", "l_partkey", "l_suppkey")


FACT_KEYS = """SELECT order_id, l_partkey, l_suppkey, coalesce(customer_key, -1) AS customer_key, coalesce(product_key, -1) AS product_key
    FROM raw_orders
    LEFT JOIN (SELECT customer_key, customer_id AS c_id FROM dim_customer) ON customer_id = c_id
    LEFT JOIN (SELECT product_key, product_id AS p_id FROM dim_product) ON product_id = p_id"""


def _found_keys(spark, sf_dir, broadcast_bytes=None):
    dims = gold.build_gold(spark, masters(spark, sf_dir), store=written(spark, "gold"))
    orders = raw_orders(spark, sf_dir)
    found = gold.fact_key_lookup(orders, dims["dim_customer"], dims["dim_product"], broadcast_bytes=broadcast_bytes)
    return found.select("order_id", "l_partkey", "l_suppkey", "customer_key", "product_key")


@case("fact_key_lookup", FACT_KEYS)
def fact_key_lookup(spark, sf_dir):
    return _found_keys(spark, sf_dir)


@case("fact_key_lookup_spread", FACT_KEYS)
def fact_key_lookup_spread(spark, sf_dir):
    return _found_keys(spark, sf_dir, broadcast_bytes=0)


@case(
    "date_membership",
    """SELECT coalesce(dim_date.date_key, 19000101) AS date_key, count(*) AS lines FROM raw_orders
    LEFT JOIN dim_date ON full_date = CAST(CAST(order_date AS TIMESTAMP) AS DATE) GROUP BY 1""",
)
def date_membership(spark, sf_dir):
    orders = raw_orders(spark, sf_dir).withColumn("order_date", F.col("order_date").cast("timestamp"))
    found = gold.date_membership(orders, gold.dim_date(spark))
    return found.groupBy("date_key").agg(F.count(F.lit(1)).alias("lines"))


@case(
    "orphan_audit",
    """SELECT count(*) AS fact_rows, count(*) FILTER (customer_key = -1) AS orphan_customers,
      count(*) FILTER (product_key = -1) AS orphan_products, count(*) FILTER (date_key = 19000101) AS unknown_dates,
      (SELECT count(*) FROM raw_orders WHERE customer_id NOT IN (SELECT customer_id FROM silver_customers)) AS raw_orphans
    FROM fact_orders""",
)
def orphan_audit(spark, sf_dir):
    cleaned = clean(spark, sf_dir)
    counts = audits.orphan_audit(star(spark, sf_dir, cleaned)["fact_orders"])
    raw = lookup.orphan_rows(raw_orders(spark, sf_dir), "customer_id", cleaned["customers"], "customer_id")
    return counts.withColumn("raw_orphans", raw.agg(F.coalesce(F.sum("rows"), F.lit(0))).scalar())


@case(
    "holiday_revenue",
    """SELECT is_holiday, CAST(sum(total_amount) AS DOUBLE) AS total_amount
    FROM fact_orders f JOIN dim_date d ON f.date_key = d.date_key GROUP BY is_holiday""",
)
def holiday_revenue(spark, sf_dir):
    return sales.holiday_revenue(*dated_sales(spark, sf_dir))


@case(
    "sales_by_calendar",
    """SELECT grain, label, CAST(sum(total_amount) AS DOUBLE) AS total_amount, count(*) AS lines FROM (
      SELECT total_amount, unnest([
        {'grain': 'year', 'label': coalesce(CAST(year AS VARCHAR), 'unknown')},
        {'grain': 'month', 'label': coalesce(year || '-' || lpad(CAST(month AS VARCHAR), 2, '0'), 'unknown')},
        {'grain': 'quarter', 'label': coalesce(year || '-Q' || quarter, 'unknown')},
        {'grain': 'weekday', 'label': coalesce(day_name, 'unknown')},
        {'grain': 'holiday', 'label': coalesce(CAST(is_holiday AS VARCHAR), 'unknown')}], recursive := true)
      FROM fact_orders f LEFT JOIN dim_date d ON f.date_key = d.date_key) GROUP BY grain, label""",
)
def sales_by_calendar(spark, sf_dir):
    return sales.sales_by_calendar(*dated_sales(spark, sf_dir))


@case(
    "payment_method_top_avg",
    """SELECT payment_method, round(CAST(sum(total_amount) AS DOUBLE) / count(*), 4) AS mean_sale FROM fact_orders
    GROUP BY payment_method ORDER BY avg(total_amount) DESC, payment_method LIMIT 1""",
)
def payment_method_top_avg(spark, sf_dir):
    top = sales.payment_method_top_avg(star(spark, sf_dir)["fact_orders"])
    return top.withColumn("mean_sale", F.round(F.col("mean_sale").cast("double"), 4))


@case(
    "null_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS filled, count(*) - count({c}) AS missing FROM raw_orders"
        for c in ("order_id", "customer_id", "product_id", "quantity", "unit_price", "status")
    ),
)
def null_counts(spark, sf_dir):
    columns = ["order_id", "customer_id", "product_id", "quantity", "unit_price", "status"]
    return profile.null_counts(raw_orders(spark, sf_dir), columns)


@case("distinct_count", "SELECT count(DISTINCT email) AS distinct_values FROM raw_customers")
def distinct_count(spark, sf_dir):
    return profile.distinct_count(raw_customers(spark, sf_dir), "email")


@case(
    "min_max",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value FROM raw_orders"
        for c in ("quantity", "unit_price", "discount_percent", "total_amount")
    ),
)
def min_max(spark, sf_dir):
    return profile.min_max(raw_orders(spark, sf_dir), ["quantity", "unit_price", "discount_percent", "total_amount"])


@case("latest_timestamp", "SELECT CAST(max(ts) AS VARCHAR) AS latest FROM events")
def latest_timestamp(spark, sf_dir):
    return profile.latest_timestamp(given(spark, sf_dir, "events"), "ts")


DEDUP = ["order_id", "customer_id", "l_partkey", "l_suppkey"]
PICK = "SELECT order_id, customer_id, l_partkey, l_suppkey FROM (SELECT *, {} AS rn FROM raw_orders) WHERE rn = 1"


@case("dedup_first", PICK.format(f"row_number() OVER (PARTITION BY order_id ORDER BY {q.ORDER_FIRST})"))
def dedup_first(spark, sf_dir):
    df = dedup.remove_duplicates(raw_orders(spark, sf_dir), ["order_id"], "first", ORDER_BY["orders"])
    return df.select(*DEDUP)


@case(
    "dedup_last",
    PICK.format("row_number() OVER (PARTITION BY order_id ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC)"),
)
def dedup_last(spark, sf_dir):
    df = dedup.remove_duplicates(raw_orders(spark, sf_dir), ["order_id"], "last", ORDER_BY["orders"])
    return df.select(*DEDUP)


@case("dedup_none", PICK.format("count(*) OVER (PARTITION BY order_id)"))
def dedup_none(spark, sf_dir):
    return dedup.remove_duplicates(raw_orders(spark, sf_dir), ["order_id"], False).select(*DEDUP)


@case(
    "dedup_full_row",
    "SELECT DISTINCT customer_id, status, payment_method, CAST(discount_percent AS DOUBLE) AS discount_percent FROM raw_orders",
)
def dedup_full_row(spark, sf_dir):
    df = raw_orders(spark, sf_dir).select("customer_id", "status", "payment_method", "discount_percent")
    return dedup.remove_duplicates(df)


@case(
    "surrogate_key",
    "SELECT CAST(row_number() OVER (ORDER BY substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 4), o_orderkey) AS BIGINT) AS order_key, "
    "o_orderkey FROM orders",
)
def surrogate_key(spark, sf_dir):
    return keys.surrogate_key(given(spark, sf_dir, "orders").select("o_orderkey"), "order_key", ["o_orderkey"])


@case(
    "distinct_sample",
    "SELECT string_agg(status, '|' ORDER BY status) AS sample FROM (SELECT DISTINCT status FROM raw_orders "
    f"WHERE status NOT IN {ORDER_STATUSES} ORDER BY status LIMIT 5)",
)
def distinct_sample(spark, sf_dir):
    bad = raw_orders(spark, sf_dir).filter(~F.col("status").isin(*ORDER_STATUSES))
    return checks.distinct_sample(bad, "status")


@case(
    "union_append",
    "SELECT customer_id, city, segment FROM raw_customers UNION ALL "
    "SELECT 's' || s_suppkey, n_name, NULL FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def union_append(spark, sf_dir):
    customers = raw_customers(spark, sf_dir).select("customer_id", "city", "segment")
    suppliers = given(spark, sf_dir, "supplier").join(
        given(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    as_customers = suppliers.select(
        F.col("n_name").alias("city"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("customer_id")
    )
    return customers.unionByName(as_customers, allowMissingColumns=True)
