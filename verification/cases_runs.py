"""Later batches, history, and input that is not as expected."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import merge
from tidemark.plans import gold, medallion, silver
from tidemark.quality import audits, checks
from tidemark.quality.suites import SUITES
from tidemark.session import scratch_path
from tidemark.sinks import files
from tidemark.sources import delimited, layers
from verification import tables_sql as q
from verification.bronze import NOW, ORDER_BY, bronze, given, raw_customers, raw_products
from verification.cases_io import CUSTOMERS, CUSTOMERS_SQL
from verification.cases_relational import clean, written
from verification.registry import case

EFFECTIVE = "2025-06-01"


def _number(column):
    return F.regexp_extract(column, "([0-9]+)", 1).cast("bigint")


def _batches(spark, sf_dir):
    """Two overlapping batches of silver: two thirds of the customers, products and orders each, with a third in common.

    In the second batch some customers have moved and some products cost more.
    """
    tables = clean(spark, sf_dir)
    ids = {"customers": "customer_id", "products": "product_id", "orders": "order_id"}
    first = {name: df.filter(_number(ids[name]) % 3 != 0) for name, df in tables.items()}
    second = {name: df.filter(_number(ids[name]) % 3 != 1) for name, df in tables.items()}
    moved, dearer = _number("customer_id") % 7 == 0, _number("product_id") % 5 == 0
    second["customers"] = second["customers"].withColumn("city", F.when(moved, "moved").otherwise(F.col("city")))
    second["products"] = second["products"].withColumn("price", F.when(dearer, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)"))
    return first, second


def _loaded(spark, sf_dir):
    first, second = _batches(spark, sf_dir)
    one = gold.build_gold(spark, first, written(spark, "first"))
    two = gold.incremental_gold(spark, second, one, EFFECTIVE, written(spark, "second"))
    fact = written(spark, "whole")("fact_orders", merge.upsert_rows(one["fact_orders"], two["fact_orders"], ["order_id"]))
    return {**two, "fact_orders": fact}


def _digits(column):
    return f"CAST(regexp_extract({column}, '([0-9]+)', 1) AS BIGINT)"


FIRST, SECOND = f"{_digits('{0}')} % 3 <> 0", f"{_digits('{0}')} % 3 <> 1"
MOVES = f"({_digits('customer_id')} % 7 = 0 AND {SECOND.format('customer_id')})"
HISTORY_SQL = f"""
    SELECT customer_id, city, DATE '2024-01-01' AS valid_from,
      CASE WHEN {MOVES} AND {FIRST.format('customer_id')} AND city <> 'moved' THEN DATE '2025-05-31' ELSE DATE '9999-12-31' END AS valid_to,
      {FIRST.format('customer_id')} AS early
    FROM (SELECT customer_id, CASE WHEN {MOVES} AND NOT {FIRST.format('customer_id')} THEN 'moved' ELSE city END AS city FROM silver_customers)
    UNION ALL
    SELECT customer_id, 'moved', DATE '2025-06-01', DATE '9999-12-31', false FROM silver_customers
    WHERE {MOVES} AND {FIRST.format('customer_id')}"""


@case(
    "incremental_gold",
    f"""SELECT order_id, coalesce(h.customer_id, 'unknown') AS customer_id, h.city, CAST(h.valid_from AS VARCHAR) AS valid_from,
      coalesce(p.product_id, 'unknown') AS product_id,
      CAST(CASE WHEN {_digits('p.product_id')} % 5 = 0 AND {SECOND.format('p.product_id')} THEN price + 1 ELSE price END AS DOUBLE) AS price,
      CAST(total_amount AS DOUBLE) AS total_amount
    FROM silver_orders o
    LEFT JOIN ({HISTORY_SQL}) h ON h.customer_id = o.customer_id AND CASE WHEN {SECOND.format('o.order_id')}
        THEN CAST(order_date AS DATE) <= h.valid_to AND (h.valid_from = DATE '2024-01-01' OR CAST(order_date AS DATE) >= h.valid_from) ELSE h.early END
    LEFT JOIN silver_products p ON p.product_id = o.product_id AND ({SECOND.format('o.order_id')} OR {FIRST.format('p.product_id')})""",
)
def incremental_gold(spark, sf_dir):
    """The fact after two batches, joined with the customer version and the product that each order found."""
    tables = gold.with_unknown_members(_loaded(spark, sf_dir))
    unknown = F.col("customer_key") == -1
    return (
        tables["fact_orders"]
        .join(tables["dim_customer"], "customer_key")
        .join(tables["dim_product"], "product_key")
        .select("order_id", "customer_id", "city", F.when(~unknown, F.col("valid_from")).alias("valid_from"), "product_id", "price", "total_amount")
    )


@case(
    "incremental_key_audit",
    "SELECT unnest(['dim_date', 'dim_customer', 'dim_product', 'fact_orders']) AS table_name, CAST(0 AS BIGINT) AS violations",
)
def incremental_key_audit(spark, sf_dir):
    """After two batches no key repeats, and every fact key has its dimension row."""
    found = audits.key_integrity_audit(gold.with_unknown_members(_loaded(spark, sf_dir)))
    return found.groupBy("table_name").agg(F.sum("violations").alias("violations"))


def _run(spark, batches, after=lambda database: None):
    """Whole runs of bronze batches into a warehouse of its own; ``after`` sees it after the first one. The tables at the end."""
    database, base = f"runs_{uuid.uuid4().hex[:12]}", scratch_path(spark, "runs")
    for k, batch in enumerate(batches):
        medallion.run_medallion(spark, batch, f"{base}/{k}", ORDER_BY, NOW, {}, database, effective=EFFECTIVE)
        if k == 0:
            seen = after(database)
    return {name: spark.table(f"{database}.{name}") for name in schemas.GOLD}, seen


def _joined(tables):
    fact, customers, products = tables["fact_orders"], tables["dim_customer"], tables["dim_product"]
    return fact.join(customers, "customer_key").join(products, "product_key")


def _digit_column(c):
    return F.regexp_extract(c, "([0-9]+)", 1).cast("bigint")


ORDERS_OF = f"""SELECT order_id, customer_id, coalesce(product_id, 'unknown') AS product_id FROM (
      SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {q.ORDER_FIRST}) AS rn FROM raw_orders
      WHERE (product_id IS NULL OR product_id IN (SELECT product_id FROM silver_products)) AND ({{}}))
    WHERE rn = 1 AND quantity > 0 AND CAST(order_date AS TIMESTAMP) <= TIMESTAMP '{NOW}'"""
HALVES = """(SELECT customer_id FROM (SELECT *, row_number() OVER (PARTITION BY email, row_seq % 2 ORDER BY row_seq) AS rn FROM raw_customers) WHERE rn = 1 {})"""


@case(
    "delta_batch",
    ORDERS_OF.format(
        f"customer_id IN {HALVES.format('AND row_seq % 2 = 0')} OR ({_digits('order_id')} % 3 = 0 AND customer_id IN {HALVES.format('')})"
    ),
)
def delta_batch(spark, sf_dir):
    """The second batch brings the other customers, no products, and orders of customers and products of both batches."""
    given_tables = bronze(spark, sf_dir)
    even, late = F.col("row_seq") % 2 == 0, _digit_column("order_id") % 3 == 0
    first = {**given_tables, "customers": given_tables["customers"].filter(even), "orders": given_tables["orders"].filter(~late)}
    second = {"customers": given_tables["customers"].filter(~even), "orders": given_tables["orders"].filter(late)}
    return _joined(_run(spark, [first, second])[0]).select("order_id", "customer_id", "product_id")


@case("orders_only_batch", "SELECT order_id, customer_id, coalesce(product_id, 'unknown') AS product_id, CAST(total_amount AS DOUBLE) AS total_amount FROM silver_orders")
def orders_only_batch(spark, sf_dir):
    """The second batch has orders alone."""
    given_tables, late = bronze(spark, sf_dir), _digit_column("order_id") % 3 == 0
    first = {**given_tables, "orders": given_tables["orders"].filter(~late)}
    second = {"orders": given_tables["orders"].filter(late)}
    return _joined(_run(spark, [first, second])[0]).select("order_id", "customer_id", "product_id", "total_amount")


@case(
    "redelivered_orders",
    f"""SELECT order_id, o.customer_id, true AS same_key, CASE WHEN {_digits('o.customer_id')} % 7 = 0
        AND ({_digits('order_id')} % 17 = 0 OR CAST(order_date AS DATE) >= DATE '{EFFECTIVE}') THEN 'moved' ELSE city END AS city
    FROM silver_orders o JOIN silver_customers USING (customer_id)""",
)
def redelivered_orders(spark, sf_dir):
    """All orders come twice, some from before the first version, some without a date; meanwhile some customers moved."""
    tables = bronze(spark, sf_dir)
    undated = F.when(_digit_column("order_id") % 17 != 0, F.col("order_date"))
    past = tables["orders"].filter(F.col("order_date").cast("timestamp") <= F.lit(NOW).cast("timestamp"))
    first = {**tables, "orders": past.withColumn("order_date", undated)}
    moved = F.when(_digit_column("customer_id") % 7 == 0, "moved").otherwise(F.col("city"))
    second = {"customers": tables["customers"].withColumn("city", moved), "orders": first["orders"]}

    def keys(database):
        columns = ["order_id", F.col("order_key").alias("first_key")]
        return written(spark, "keys")("orders", spark.table(f"{database}.fact_orders").select(*columns))

    end, before = _run(spark, [first, second], keys)
    same = F.coalesce(F.col("first_key") == F.col("order_key"), F.lit(False)).alias("same_key")
    return _joined(end).join(before, "order_id", "full").select("order_id", "customer_id", same, "city")


@case("empty_batch", "SELECT order_id, customer_id, city, CAST(total_amount AS DOUBLE) AS total_amount FROM silver_orders JOIN silver_customers USING (customer_id)")
def empty_batch(spark, sf_dir):
    """A second batch of no rows changes nothing."""
    tables = bronze(spark, sf_dir)
    nothing = {name: df.filter(F.lit(False)) for name, df in tables.items()}
    return _joined(_run(spark, [tables, nothing])[0]).select("order_id", "customer_id", "city", "total_amount")


CHANGES = 4


@case(
    "scd2_changes",
    f"""SELECT customer_id, city, CAST(valid_from AS VARCHAR) AS valid_from, is_current, CAST(coalesce(until - 1, DATE '9999-12-31') AS VARCHAR) AS valid_to
    FROM (SELECT *, lead(valid_from) OVER w AS until, lead(valid_from) OVER w IS NULL AS is_current FROM (
        SELECT customer_id, city, valid_from FROM dim_customer
        UNION ALL SELECT customer_id, 'city ' || j, DATE '2023-11-01' + CAST((j * 40 + {_digits('customer_id')} % 20) AS INTEGER)
        FROM dim_customer, (SELECT unnest(range({CHANGES})) AS j) WHERE {_digits('customer_id')} % {CHANGES} >= j)
      WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from))""",
)
def scd2_changes(spark, sf_dir):
    """Up to four dated changes for each customer, some before the first version, arrive in two batches and not in their order."""
    store = written(spark, "silver")
    customers = store("customers", silver.silver_customers(raw_customers(spark, sf_dir), ["row_seq"], NOW))
    dimension = store("dim_customer", gold.dim_customer(customers))
    number, j = _digit_column("customer_id"), F.col("j")
    moves = customers.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(CHANGES - 1)))).filter(number % CHANGES >= j)
    moves = moves.withColumns({"city": F.concat(F.lit("city "), j), "day": F.date_add(F.lit("2023-11-01").cast("date"), (j * 40 + number % 20).cast("int"))})
    for late in (True, False):
        batch = moves.filter((j % 2 == 0) == late)
        dimension = merge.scd2_merge(dimension, batch, "customer_id", gold.CUSTOMER_ATTRIBUTES, F.col("day"), "customer_key", store=written(spark, "history"))
    return dimension.select("customer_id", "city", "valid_from", "is_current", "valid_to")


@case(
    "fact_key_as_of",
    f"""SELECT order_id, o.customer_id, CAST(CASE WHEN {_digits('o.customer_id')} IS NULL THEN -1 ELSE {_digits('o.customer_id')} * 1000
      + greatest(0, least({_digits('o.customer_id')} % 90, (CAST(order_date AS DATE) - DATE '2024-01-01') // 10)) END AS BIGINT) AS customer_key
    FROM silver_orders o""",
)
def fact_key_as_of(spark, sf_dir):
    """Up to ninety versions for each customer, a new one every ten days; orders from before the first one take the first."""
    tables = clean(spark, sf_dir)
    number = _digit_column("customer_id")
    versions = tables["customers"].select("customer_id", F.explode(F.sequence(F.lit(0).cast("bigint"), number % 90)).alias("j")).select(
        "customer_id", (number * 1000 + F.col("j")).alias("customer_key"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("j") * 10).cast("int")).alias("valid_from"),
    )
    products = gold.dim_product(tables["products"])
    return gold.fact_key_lookup(tables["orders"], versions, products, as_of=True).select("order_id", "customer_id", "customer_key")


@case(
    "scd2_same_day",
    """SELECT customer_key, customer_id, CASE WHEN CAST(regexp_extract(customer_id, '([0-9]+)', 1) AS BIGINT) % 7 = 0 THEN 'moved' ELSE city END AS city,
      CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, is_current FROM dim_customer""",
)
def scd2_same_day(spark, sf_dir):
    """A change on the day a version began replaces it, with the key it has."""
    store = written(spark, "silver")
    customers = store("customers", silver.silver_customers(raw_customers(spark, sf_dir), ["row_seq"], NOW))
    dimension = store("dim_customer", gold.dim_customer(customers))
    moved = customers.withColumn("city", F.when(_number("customer_id") % 7 == 0, "moved").otherwise(F.col("city")))
    merged = merge.scd2_merge(dimension, moved, "customer_id", gold.CUSTOMER_ATTRIBUTES, gold.FIRST_VALID_FROM, "customer_key", store=store)
    return merged.select("customer_key", "customer_id", "city", "valid_from", "valid_to", "is_current")


@case("read_csv_reordered", f"SELECT * REPLACE (CAST(NULL AS VARCHAR) AS country) FROM ({CUSTOMERS_SQL})")
def read_csv_reordered(spark, sf_dir):
    """Columns in another order than the schema's, one of them absent and one unknown."""
    path = scratch_path(spark, "reordered")
    shuffled = [c for c in reversed(CUSTOMERS) if c != "country"]
    files.write_csv(raw_customers(spark, sf_dir).select(*shuffled[:3], F.lit("?").alias("odd"), *shuffled[3:]), path)
    return delimited.read_csv(spark, path, schemas.BRONZE["customers"], expected_columns=CUSTOMERS)


@case("read_csv_directory_headers", f"{CUSTOMERS_SQL} UNION ALL {CUSTOMERS_SQL}")
def read_csv_directory_headers(spark, sf_dir):
    """Files whose headers name the columns in two orders."""
    path, customers = scratch_path(spark, "headers"), raw_customers(spark, sf_dir)
    files.write_csv(customers.select(*CUSTOMERS), path)
    files.write_csv(customers.select(*CUSTOMERS[::-1]), path, mode="append")
    return delimited.read_csv_directory(spark, path, schemas.BRONZE["customers"]).filter("_corrupt_record IS NULL").select(*CUSTOMERS)


DIRTY = "CASE WHEN l_orderkey % 5 = 0 THEN 5000.0 WHEN l_orderkey % 7 = 0 THEN 200000000.0 ELSE 1.0 END"


@case(
    "silver_out_of_range",
    """SELECT count(*) AS kept, count(*) FILTER (l_orderkey % 5 = 0) AS discounts_above, count(*) FILTER (l_orderkey % 7 = 0) AS prices_above,
      false AS discount_passed FROM lineitem""",
)
def silver_out_of_range(spark, sf_dir):
    """A discount of 5000 and a price of 200 million stay, and the range check reports them."""
    lines = given(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey")
    orders = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", F.monotonically_increasing_id()).alias("order_id"), F.lit("c").alias("customer_id"),
        F.lit("p").alias("product_id"), F.lit(1).alias("quantity"), F.when(key % 7 == 0, 2e8).otherwise(1.0).alias("unit_price"),
        F.when(key % 5 == 0, 5000.0).otherwise(0.0).alias("discount_percent"), F.lit(0.0).alias("total_amount"),
        F.lit("2024-01-01 00:00:00").alias("order_date"), F.lit("completed").alias("status"), F.lit("pix").alias("payment_method"),
        F.lit(0.0).alias("shipping_cost"),
    )
    kept = files.layer_store(scratch_path(spark, "layers"), "silver")("orders", silver.silver_orders(orders, ["order_id"], NOW))
    results = checks.run_suite(kept, SUITES["orders"], NOW)
    ranges = results.filter("check_name LIKE 'range_%' AND column_name = 'discount_percent'")
    passed = ranges.agg(F.bool_and("passed").alias("discount_passed"))
    counts = kept.agg(
        F.count(F.lit(1)).alias("kept"), F.count_if(F.col("discount_percent") > 100).alias("discounts_above"),
        F.count_if(F.col("unit_price") > 10**7).alias("prices_above"),
    )
    return counts.join(passed)


@case("publish_empty", "SELECT count(*) AS row_count, false AS published FROM part")
def publish_empty(spark, sf_dir):
    """An empty table does not take the place of a filled one."""
    base, parts = scratch_path(spark, "store"), given(spark, sf_dir, "part")
    files.publish_layer({"part": parts}, base, "silver")
    published = files.publish_layer({"part": parts.filter("p_partkey IS NULL")}, base, "silver")["part"]
    back = layers.read_layer(spark, base, "silver", ["part"])["part"].agg(F.count(F.lit(1)).alias("row_count"))
    return back.withColumn("published", F.lit(published))


@case("write_object_store_multiline", "SELECT count(*) AS row_count, true AS verified FROM part")
def write_object_store_multiline(spark, sf_dir):
    """Values with line breaks, as CSV."""
    path, parts = scratch_path(spark, "object"), given(spark, sf_dir, "part")
    broken = parts.select("p_partkey", F.concat("p_name", F.lit("\n"), "p_brand").alias("text"))
    verified = files.write_object_store(broken, path, "csv")
    back = layers.read_table(spark, path, "csv", **files.CSV_OPTIONS, multiLine="true").filter(F.contains("text", F.lit("\n")))
    return back.agg(F.count(F.lit(1)).alias("row_count")).withColumn("verified", F.lit(verified))


@case(
    "file_profile_empty",
    "SELECT true AS is_empty, CAST(0 AS BIGINT) AS row_count UNION ALL SELECT false, count(*) FROM part",
)
def file_profile_empty(spark, sf_dir):
    """A file of a header alone shows with no rows."""
    path, parts = scratch_path(spark, "profiled"), given(spark, sf_dir, "part").select("p_partkey", "p_name")
    files.write_csv(parts.filter("p_partkey IS NULL").coalesce(1), path)
    files.write_csv(parts.repartition(1), path, mode="append")
    df = spark.read.options(**files.CSV_OPTIONS).schema("p_partkey bigint, p_name string").csv(path)
    found = delimited.file_profile(df, files.list_dataset_files(spark, path, "*.csv"))
    return found.select((F.col("row_count") == 0).alias("is_empty"), "row_count")


@case(
    "bronze_products_whole_numbers",
    "SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(p_size AS DOUBLE) AS price, CAST(p_size % 5 AS DOUBLE) AS rating FROM part",
)
def bronze_products_whole_numbers(spark, sf_dir):
    """Ids and prices that look like whole numbers keep the types of the product table."""
    from tidemark.sources import catalog

    path, parts = scratch_path(spark, "products"), given(spark, sf_dir, "part")
    rate = F.struct((F.col("p_size") % 5).alias("rate"))
    files.write_json(parts.select(F.col("p_partkey").alias("product_id"), F.col("p_size").alias("price"), rate.alias("rating")), path)
    return catalog.read_bronze_products(spark, path, "unused").select("product_id", "price", "rating")
