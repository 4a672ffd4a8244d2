"""Silver, the star schema, history and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.plans import gold, silver
from verification import tables_sql as q
from verification.bronze import NOW, ORDER_BY, given, raw_customers, raw_orders, raw_products
from verification.cases_relational import masters, star, written
from verification.registry import case

ORDER_COLUMNS = (
    "order_id, customer_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
    "CAST(discount_percent AS DOUBLE) AS discount_percent, CAST(total_amount AS DOUBLE) AS total_amount, "
    "CAST(order_date AS VARCHAR) AS order_date, status, payment_method, CAST(shipping_cost AS DOUBLE) AS shipping_cost"
)


@case(
    "silver_customers",
    "SELECT * REPLACE (CAST(registration_date AS VARCHAR) AS registration_date) FROM silver_customers",
)
def silver_customers(spark, sf_dir):
    return silver.silver_customers(raw_customers(spark, sf_dir), ["row_seq"], NOW).drop("row_seq", "processed_at")


@case(
    "silver_customers_normalized",
    f"""SELECT customer_id, email FROM (
      SELECT customer_id, email, row_number() OVER (PARTITION BY email ORDER BY row_seq) AS rn
      FROM (SELECT customer_id, row_seq, {q.email('email')} AS email FROM raw_customers)) WHERE rn = 1""",
)
def silver_customers_normalized(spark, sf_dir):
    df = silver.silver_customers(raw_customers(spark, sf_dir), ["row_seq"], NOW, normalize_first=True)
    return df.select("customer_id", "email")


@case(
    "silver_products",
    "SELECT * REPLACE (CAST(created_at AS VARCHAR) AS created_at, CAST(price AS DOUBLE) AS price, "
    "CAST(cost_price AS DOUBLE) AS cost_price, CAST(rating AS DOUBLE) AS rating) FROM silver_products",
)
def silver_products(spark, sf_dir):
    return silver.silver_products(raw_products(spark, sf_dir), ["row_seq"], NOW).drop("row_seq", "processed_at")


@case("build_silver", f"SELECT {ORDER_COLUMNS} FROM silver_orders")
def build_silver(spark, sf_dir):
    orders = silver.silver_orders(
        silver.valid_orders(raw_orders(spark, sf_dir), masters(spark, sf_dir)), ORDER_BY["orders"], NOW
    )
    return orders.drop("l_partkey", "l_suppkey", "l_extendedprice", "processed_at")


@case(
    "dim_date",
    """SELECT dim_date.* REPLACE (CAST(full_date AS VARCHAR) AS full_date), coalesce(lines, 0) AS lines FROM dim_date
    LEFT JOIN (SELECT CAST(CAST(order_date AS TIMESTAMP) AS DATE) AS d, count(*) AS lines FROM raw_orders GROUP BY 1)
    ON d = full_date""",
)
def dim_date(spark, sf_dir):
    """The calendar with the raw order lines of each day."""
    day = F.col("order_date").cast("timestamp").cast("date")
    per_day = raw_orders(spark, sf_dir).groupBy(day.alias("full_date")).agg(F.count(F.lit(1)).alias("lines"))
    return gold.dim_date(spark).join(per_day, "full_date", "left").fillna(0, ["lines"])


@case(
    "dim_customer",
    "SELECT * REPLACE (CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to) FROM dim_customer",
)
def dim_customer(spark, sf_dir):
    return gold.dim_customer(silver.silver_customers(raw_customers(spark, sf_dir), ["row_seq"], NOW))


@case(
    "dim_product",
    "SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(cost_price AS DOUBLE) AS cost_price, "
    "CAST(rating AS DOUBLE) AS rating) FROM dim_product",
)
def dim_product(spark, sf_dir):
    return gold.dim_product(silver.silver_products(raw_products(spark, sf_dir), ["row_seq"], NOW))


FACT = """SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_percent AS DOUBLE) AS discount_percent,
    CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(total_amount AS DOUBLE) AS total_amount,
    CAST(net_amount AS DOUBLE) AS net_amount, CAST(shipping_cost AS DOUBLE) AS shipping_cost) FROM fact_orders"""


@case("fact_orders", FACT)
def fact_orders(spark, sf_dir):
    return star(spark, sf_dir)["fact_orders"]


@case(
    "build_gold",
    """SELECT order_key, order_id, coalesce(c.customer_id, 'unknown') AS customer_id, c.segment,
      coalesce(p.product_id, 'unknown') AS product_id, p.price_range, p.margin_percent,
      coalesce(d.day_name, 'Monday') AS day_name, coalesce(d.is_holiday, true) AS is_holiday,
      CAST(net_amount AS DOUBLE) AS net_amount, order_status
    FROM fact_orders f LEFT JOIN dim_customer c ON f.customer_key = c.customer_key
      LEFT JOIN dim_product p ON f.product_key = p.product_key LEFT JOIN dim_date d ON f.date_key = d.date_key""",
)
def build_gold(spark, sf_dir):
    """The star joined back together; with the unknown members every row finds its dimension rows."""
    tables = star(spark, sf_dir, unknown_members=True)
    return (
        tables["fact_orders"]
        .join(tables["dim_customer"], "customer_key")
        .join(tables["dim_product"], "product_key")
        .join(tables["dim_date"], "date_key")
        .select(
            "order_key", "order_id", "customer_id", "segment", "product_id", "price_range", "margin_percent",
            "day_name", "is_holiday", "net_amount", "order_status",
        )
    )


MOVED_SQL = """
    SELECT CASE WHEN c_custkey % 11 = 0 THEN 'n' || c_custkey ELSE 'c' || c_custkey END AS customer_id,
      s.* EXCLUDE (customer_id) REPLACE (CASE WHEN c_custkey % 7 = 0 THEN 'moved' ELSE city END AS city)
    FROM (SELECT * FROM dim_customer) s JOIN customer ON s.customer_id = 'c' || c_custkey"""

ATTRIBUTES = ", ".join(gold.CUSTOMER_ATTRIBUTES)
SCD2_SQL = f"""
    SELECT * REPLACE (CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to) FROM (
    SELECT d.* REPLACE (CASE WHEN m.customer_id IS NOT NULL AND m.city <> d.city THEN DATE '2025-05-31' ELSE d.valid_to END AS valid_to,
      NOT coalesce(m.city <> d.city, false) AS is_current)
    FROM dim_customer d LEFT JOIN ({MOVED_SQL}) m ON m.customer_id = d.customer_id
    UNION ALL
    SELECT (SELECT max(customer_key) FROM dim_customer) + {q.numbered('customer_id')} AS customer_key, customer_id, {ATTRIBUTES},
      DATE '2025-06-01', DATE '9999-12-31', true
    FROM (SELECT m.* FROM ({MOVED_SQL}) m LEFT JOIN dim_customer d ON m.customer_id = d.customer_id
      WHERE d.customer_id IS NULL OR m.city <> d.city))"""


@case("scd2_merge", SCD2_SQL)
def scd2_merge(spark, sf_dir):
    """Some customers moved, some are new, and some no longer appear."""
    store = written(spark, "silver")
    customers = store("customers", silver.silver_customers(raw_customers(spark, sf_dir), ["row_seq"], NOW))
    number = F.substring("customer_id", 2, 20).cast("bigint")
    incoming = customers.withColumns(
        {
            "city": F.when(number % 7 == 0, "moved").otherwise(F.col("city")),
            "customer_id": F.when(number % 11 == 0, F.concat(F.lit("n"), number.cast("string"))).otherwise(
                F.col("customer_id")
            ),
        }
    )
    dimension = store("dim_customer", gold.dim_customer(customers))
    return merge.scd2_merge(
        dimension, incoming, "customer_id", gold.CUSTOMER_ATTRIBUTES, "2025-06-01", "customer_key", store=store
    )


@case(
    "upsert",
    """SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, o_orderstatus, o_totalprice FROM orders
      WHERE o_orderkey NOT IN (SELECT o_orderkey * 2 FROM orders)
    UNION ALL
    SELECT s.o_orderkey * 2, t.o_custkey, 'U', s.o_totalprice FROM orders s LEFT JOIN orders t ON t.o_orderkey = s.o_orderkey * 2""",
)
def upsert(spark, sf_dir):
    """The source holds every order under twice its number: half of them replace a row, half are new."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    target = given(spark, sf_dir, "orders").select(*columns)
    source = target.select(
        (F.col("o_orderkey") * 2).alias("o_orderkey"), F.lit("U").alias("o_orderstatus"), "o_totalprice"
    )
    merged = merge.upsert_rows(target, source, ["o_orderkey"])
    return merged.withColumn("o_custkey", F.col("o_custkey").cast("double"))
