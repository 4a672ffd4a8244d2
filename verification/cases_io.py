"""Sources and sinks: a table is written under the shared folder, read back and compared."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans.gold import build_gold
from tidemark.plans.silver import build_silver
from tidemark.schemas import table_schema
from tidemark.session import scratch_path
from tidemark.sinks import files, warehouse
from tidemark.sources import catalog, delimited, layers
from verification.bronze import NOW, ORDER_BY, bronze, given, raw_customers, raw_orders, raw_products
from verification.cases_model import FACT, ORDER_COLUMNS
from verification.cases_relational import clean, star
from verification.registry import case

CUSTOMERS = schemas.BRONZE["customers"].names
CUSTOMERS_SQL = f"SELECT {', '.join(CUSTOMERS)} FROM raw_customers"
LATIN1 = "ISO-8859-1"


def written(df: DataFrame, name: str, **options) -> str:
    path = scratch_path(df.sparkSession, name)
    files.write_csv(df, path, **options)
    return path


@case("read_csv", CUSTOMERS_SQL)
def read_csv(spark, sf_dir):
    """Latin-1 with semicolons, recognised without being told."""
    path = written(raw_customers(spark, sf_dir).select(*CUSTOMERS), "customers", delimiter=";", encoding=LATIN1)
    return delimited.read_csv(spark, path, schemas.BRONZE["customers"], expected_columns=CUSTOMERS)


@case(
    "sniff_csv_dialect",
    """SELECT 'customers' AS dataset, 'ISO-8859-1' AS encoding, ';' AS delimiter, count(*) AS row_count FROM raw_customers
    UNION ALL SELECT 'products', 'UTF-8', ',', count(*) FROM raw_products
    UNION ALL SELECT 'orders', 'UTF-8', chr(9), count(*) FROM raw_orders""",
)
def sniff_csv_dialect(spark, sf_dir):
    tables = bronze(spark, sf_dir)
    dialects = {"customers": (";", LATIN1), "products": (",", "UTF-8"), "orders": ("\t", "UTF-8")}
    parts = []
    for name, (delimiter, encoding) in dialects.items():
        found = delimited.sniff_csv_dialect(spark, written(tables[name], name, delimiter=delimiter, encoding=encoding))
        rows = found.groupBy("encoding", "delimiter").agg((F.sum("lines") - F.count(F.lit(1))).alias("row_count"))
        parts.append(rows.withColumn("dataset", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


@case("read_csv_directory", f"{CUSTOMERS_SQL} UNION ALL {CUSTOMERS_SQL}")
def read_csv_directory(spark, sf_dir):
    """Files of two dialects in one directory."""
    customers = raw_customers(spark, sf_dir).select(*CUSTOMERS)
    path = written(customers, "mixed")
    files.write_csv(customers, path, delimiter=";", encoding=LATIN1, mode="append")
    whole = delimited.read_csv_directory(spark, path, schemas.BRONZE["customers"])
    return whole.filter("_corrupt_record IS NULL AND source_file IS NOT NULL").select(*CUSTOMERS)


PROFILED = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


@case(
    "file_profile",
    " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file_name, true AS has_size, count(*) AS row_count, CAST(6 AS INTEGER) AS column_count, "
        f"'{kinds}' AS data_types FROM {t}"
        for t, kinds in PROFILED.items()
    ),
)
def file_profile(spark, sf_dir):
    profiles = [delimited.file_profile(given(spark, sf_dir, t)) for t in PROFILED]
    whole = reduce(DataFrame.unionByName, profiles)
    has_size = (F.col("size_bytes") > 0) & F.col("last_modified").isNotNull()
    return whole.select("file_name", has_size.alias("has_size"), "row_count", "column_count", "data_types")


@case(
    "file_profile_broken",
    """SELECT CAST(-1 AS BIGINT) AS row_count, 2 AS column_count UNION ALL SELECT count(*), 2 FROM part WHERE p_partkey % 3 = 0
    UNION ALL SELECT count(*), 2 FROM part WHERE p_partkey % 3 > 0 UNION ALL SELECT 0, 2""",
)
def file_profile_broken(spark, sf_dir):
    """Of four files one is no Parquet at all and one has no rows."""
    path, parts = scratch_path(spark, "some-broken"), given(spark, sf_dir, "part").select("p_partkey", "p_name")
    for some in (parts.filter("p_partkey % 3 = 0"), parts.filter("p_partkey % 3 > 0"), parts.filter("p_partkey < 0")):
        some.coalesce(1).write.mode("append").parquet(path)
    parts.select("p_name").coalesce(1).write.mode("append").text(path)
    schema = parts.schema
    found = delimited.profile_files(files.list_dataset_files(spark, path, "part-*"), lambda reader, paths: reader.schema(schema).parquet(*paths))
    return found.select("row_count", "column_count")


@case(
    "ingest_product_catalog",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_retailprice AS price, (p_partkey % 9) * 0.5::DOUBLE AS rating,
      'Uncategorized' AS category, 'Uncategorized' AS subcategory, 'FakeStoreAPI' AS supplier, 'API-PRD-' || p_partkey AS sku,
      CAST(150 AS INTEGER) AS stock_quantity, '{NOW}' AS created_at,
      CAST(round(CAST(p_retailprice AS DECIMAL(18,6)) * 0.65, 2) AS DOUBLE) AS cost_price FROM part""",
)
def ingest_product_catalog(spark, sf_dir):
    parts = given(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("price"),
        F.struct((F.col("p_partkey") % 9 * 0.5).alias("rate"), F.col("p_size").alias("count")).alias("rating"),
    )
    path = scratch_path(spark, "catalog")
    files.write_json(parts, path)
    record = table_schema(
        id="long", title="string", price="double", rating=table_schema(rate="double", count="long")
    )
    return catalog.read_product_catalog(spark, path, record, now=NOW)


@case(
    "ingest_categories",
    "SELECT category, count(*) AS products FROM (SELECT unnest([p_type, p_brand]) AS category FROM part) GROUP BY category",
)
def ingest_categories(spark, sf_dir):
    lists = given(spark, sf_dir, "part").select(F.to_json(F.array("p_type", "p_brand")).alias("document"))
    return catalog.categories(lists, "document").groupBy("category").agg(F.count(F.lit(1)).alias("products"))


@case(
    "ingest_users",
    "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS records FROM events GROUP BY 1",
)
def ingest_users(spark, sf_dir):
    users = catalog.users(given(spark, sf_dir, "events"), "props", table_schema(k="long"))
    return users.groupBy("k").agg(F.count(F.lit(1)).alias("records"))


@case(
    "ingest_users_nested",
    "SELECT row_seq AS id, phone, first_name AS firstname, last_name AS lastname, city, zip_code AS zipcode FROM raw_customers",
)
def ingest_users_nested(spark, sf_dir):
    customers = raw_customers(spark, sf_dir)
    records = customers.select(
        F.col("row_seq").alias("id"),
        "phone",
        F.struct(F.col("first_name").alias("firstname"), F.col("last_name").alias("lastname")).alias("name"),
        F.struct("city", F.col("zip_code").alias("zipcode")).alias("address"),
    )
    path = scratch_path(spark, "users")
    files.write_json(records, path)
    users = catalog.read_users(spark, path)
    return users.select("id", "phone", "name.firstname", "name.lastname", "address.city", "address.zipcode")


@case(
    "read_bronze_products",
    " UNION ALL ".join(
        f"SELECT '{o}' AS origin, product_id, name, CAST(price AS DOUBLE) AS price, CAST(rating AS DOUBLE) AS rating FROM raw_products"
        for o in ("json", "csv")
    ),
)
def read_bronze_products(spark, sf_dir):
    """Once with a catalogue of nested ratings, once without a catalogue."""
    products = raw_products(spark, sf_dir).select(*schemas.BRONZE["products"].names)
    csv_path, json_path = written(products, "products"), scratch_path(spark, "products-json")
    files.write_json(products.withColumn("rating", F.struct(F.col("rating").alias("rate"))), json_path)
    columns = ["product_id", "name", "price", "rating"]
    with_json = catalog.read_bronze_products(spark, json_path, csv_path).select(F.lit("json").alias("origin"), *columns)
    without = catalog.read_bronze_products(spark, json_path + "-absent", csv_path)
    return with_json.unionByName(without.select(F.lit("csv").alias("origin"), *columns))


@case("read_parquet_layer", f"SELECT {ORDER_COLUMNS} FROM silver_orders")
def read_parquet_layer(spark, sf_dir):
    base = scratch_path(spark, "layers")
    build_silver(bronze(spark, sf_dir), ORDER_BY, NOW, store=files.layer_store(base, "silver"))
    orders = layers.read_layer(spark, base, "silver", ["orders"])["orders"]
    return orders.drop("l_partkey", "l_suppkey", "l_extendedprice", "processed_at")


@case(
    "sql_query",
    "SELECT o_orderpriority, count(*) AS orders_above FROM orders WHERE o_totalprice >= 250000.0 GROUP BY 1",
)
def sql_query(spark, sf_dir):
    return layers.sql_query(
        spark,
        "SELECT o_orderpriority, count(*) AS orders_above FROM {orders} WHERE o_totalprice >= :floor GROUP BY 1",
        {"floor": 250000.0},
        orders=given(spark, sf_dir, "orders"),
    )


@case("write_csv", CUSTOMERS_SQL)
def write_csv(spark, sf_dir):
    path = written(raw_customers(spark, sf_dir).select(*CUSTOMERS), "customers")
    return delimited.read_csv(spark, path, schemas.BRONZE["customers"], delimiter=",", encoding="UTF-8")


@case("write_json", CUSTOMERS_SQL)
def write_json(spark, sf_dir):
    path = scratch_path(spark, "customers")
    files.write_json(raw_customers(spark, sf_dir).select(*CUSTOMERS), path)
    return spark.read.schema(schemas.BRONZE["customers"]).json(path)


SILVER_TOTALS = """
    SELECT 'customers' AS table_name, count(*) AS row_count, CAST(count(email) AS DOUBLE) AS total FROM silver_customers
    UNION ALL SELECT 'products', count(*), CAST(sum(price + cost_price) AS DOUBLE) FROM silver_products
    UNION ALL SELECT 'orders', count(*), CAST(sum(total_amount) AS DOUBLE) FROM silver_orders"""


@case("write_silver", SILVER_TOTALS)
def write_silver(spark, sf_dir):
    base = scratch_path(spark, "layers")
    build_silver(bronze(spark, sf_dir), ORDER_BY, NOW, store=files.layer_store(base, "silver"))
    back = layers.read_layer(spark, base, "silver", ["customers", "products", "orders"])
    totals = {
        "customers": F.count("email"), "products": F.sum(F.col("price") + F.col("cost_price")),
        "orders": F.sum("total_amount"),
    }
    return _totals(back, totals)


def _totals(tables, totals) -> DataFrame:
    parts = [
        tables[name].agg(F.count(F.lit(1)).alias("row_count"), total.cast("double").alias("total")).select(
            F.lit(name).alias("table_name"), "row_count", "total"
        )
        for name, total in totals.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@case("write_gold", FACT)
def write_gold(spark, sf_dir):
    base = scratch_path(spark, "layers")
    build_gold(spark, clean(spark, sf_dir), store=files.layer_store(base, "gold"))
    return layers.read_layer(spark, base, "gold", ["fact_orders"])["fact_orders"]


@case(
    "write_object_store",
    " UNION ALL ".join(f"SELECT '{o}' AS origin, t.* FROM ({CUSTOMERS_SQL}) t" for o in ("parquet", "csv")),
)
def write_object_store(spark, sf_dir):
    customers = raw_customers(spark, sf_dir).select(*CUSTOMERS)
    parts = []
    for data_format in ("parquet", "csv", "xlsx"):
        path = scratch_path(spark, "object")
        if files.write_object_store(customers, path, data_format):
            reader = spark.read.options(**files.CSV_OPTIONS).schema(schemas.BRONZE["customers"]).format(data_format)
            parts.append(reader.load(layers.current_path(spark, path)).withColumn("origin", F.lit(data_format)))
    return reduce(DataFrame.unionByName, parts)


@case("publish_layer", SILVER_TOTALS.replace("AS total FROM", "AS total, true AS verified FROM", 1).replace(
    ") FROM silver_products", "), true FROM silver_products").replace(") FROM silver_orders", "), true FROM silver_orders"))
def publish_layer(spark, sf_dir):
    base = scratch_path(spark, "store")
    verified = files.publish_layer(clean(spark, sf_dir), base, "silver")
    back = layers.read_layer(spark, base, "silver", verified)
    totals = {
        "customers": F.count("email"), "products": F.sum(F.col("price") + F.col("cost_price")),
        "orders": F.sum("total_amount"),
    }
    names = F.create_map(*[F.lit(v) for pair in verified.items() for v in pair])
    return _totals(back, totals).withColumn("verified", names[F.col("table_name")])


def _by_month(spark, sf_dir) -> str:
    moment = F.col("order_date").cast("timestamp")
    orders = raw_orders(spark, sf_dir).withColumns({"year": F.year(moment), "month": F.month(moment)})
    path = scratch_path(spark, "by-month")
    files.write_partitioned(orders, path, ["year", "month"])
    return path


BY_MONTH = """SELECT CAST(year(CAST(order_date AS TIMESTAMP)) AS INTEGER) AS year, CAST(month(CAST(order_date AS TIMESTAMP)) AS INTEGER) AS month,
    {} FROM raw_orders"""


@case("write_partitioned", BY_MONTH.format("order_id, status, CAST(unit_price AS DOUBLE) AS unit_price"))
def write_partitioned(spark, sf_dir):
    return spark.read.parquet(_by_month(spark, sf_dir)).select("year", "month", "order_id", "status", "unit_price")


@case(
    "partition_groups",
    "SELECT coalesce(CAST(quantity AS VARCHAR), 'none') AS quantity, count(*) AS row_count FROM raw_orders GROUP BY 1",
)
def partition_groups(spark, sf_dir):
    """Rows per partition, among them the partition of rows without a value."""
    orders = raw_orders(spark, sf_dir).select("order_id", "quantity")
    path = scratch_path(spark, "by-quantity")
    files.write_partitioned(orders, path, ["quantity"])
    groups = spark.read.parquet(path).groupBy("quantity").agg(F.count(F.lit(1)).alias("row_count"))
    return groups.select(F.coalesce(F.col("quantity").cast("string"), F.lit("none")).alias("quantity"), "row_count")


@case("write_partitioned_empty", "SELECT p_size, count(*) AS row_count FROM part GROUP BY p_size")
def write_partitioned_empty(spark, sf_dir):
    """No rows do not take the place of some."""
    path, parts = scratch_path(spark, "by-size"), given(spark, sf_dir, "part").select("p_partkey", "p_size")
    files.write_partitioned(parts, path, ["p_size"])
    files.write_partitioned(parts.filter("p_partkey IS NULL"), path, ["p_size"])
    return spark.read.parquet(path).groupBy("p_size").agg(F.count(F.lit(1)).alias("row_count"))


@case("write_csv_empty", CUSTOMERS_SQL)
def write_csv_empty(spark, sf_dir):
    customers = raw_customers(spark, sf_dir).select(*CUSTOMERS)
    path = written(customers, "customers")
    files.write_csv(customers.filter("customer_id IS NULL"), path)
    return delimited.read_csv(spark, path, schemas.BRONZE["customers"], delimiter=",", encoding="UTF-8")


@case(
    "list_dataset_files",
    "SELECT DISTINCT 'year=' || year(CAST(order_date AS TIMESTAMP)) || '/month=' || month(CAST(order_date AS TIMESTAMP)) AS directory, "
    "false AS has_empty_file FROM raw_orders",
)
def list_dataset_files(spark, sf_dir):
    listed = files.list_dataset_files(spark, _by_month(spark, sf_dir), "*.parquet")
    directory = F.regexp_extract("path", "(year=[^/]+/month=[^/]+)/", 1)
    return listed.groupBy(directory.alias("directory")).agg(F.bool_or(F.col("size_bytes") == 0).alias("has_empty_file"))


@case(
    "verify_write",
    "SELECT 'orders' AS table_name, count(*) AS row_count, true AS complete, false AS complete_if_one_more FROM raw_orders "
    "UNION ALL SELECT 'customers', count(*), true, false FROM raw_customers",
)
def verify_write(spark, sf_dir):
    base = scratch_path(spark, "layers")
    tables = {"orders": raw_orders(spark, sf_dir), "customers": raw_customers(spark, sf_dir)}
    found = []
    for name, rows in files.write_layer(tables, base, "bronze").items():
        path = layers.table_path(base, "bronze", name)
        found.append((name, rows, files.verify_write(spark, path, rows), files.verify_write(spark, path, rows + 1)))
    return spark.createDataFrame(
        found, table_schema(table_name="string", row_count="long", complete="boolean", complete_if_one_more="boolean")
    )


def _warehouse(spark, sf_dir) -> tuple[str, str]:
    """A database of its own with the star schema, the dimensions and the fact loaded."""
    database, base = f"gold_{uuid.uuid4().hex[:12]}", scratch_path(spark, "warehouse")
    warehouse.create_star_schema(spark, database, base)
    for name, df in star(spark, sf_dir).items():
        warehouse.load_table(warehouse.conformed(df, name), f"{database}.{name}", base, "append")
    return database, base


@case("create_star_schema", FACT)
def create_star_schema(spark, sf_dir):
    database, _ = _warehouse(spark, sf_dir)
    return spark.table(f"{database}.fact_orders").select(*schemas.GOLD["fact_orders"].names)


@case(
    "table_row_count",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in schemas.GOLD)
    + " UNION ALL SELECT 'no_such_table', -1",
)
def table_row_count(spark, sf_dir):
    database, _ = _warehouse(spark, sf_dir)
    names = [*schemas.GOLD, "no_such_table"]
    counts = [(name, warehouse.table_row_count(spark, f"{database}.{name}")) for name in names]
    return spark.createDataFrame(counts, table_schema(table_name="string", row_count="long"))


@case(
    "upsert_table",
    """SELECT product_key, product_id, name, CAST(price AS DOUBLE) AS price, CAST(margin_percent AS DOUBLE) AS margin_percent FROM (
      SELECT product_key, product_id, name, price * 2 AS price, margin_percent FROM dim_product
      UNION ALL SELECT product_key, 'new-' || product_id, name, price, margin_percent FROM dim_product)""",
)
def upsert_table(spark, sf_dir):
    """Every product gets a new price, and as many new products arrive."""
    database, base = _warehouse(spark, sf_dir)
    table = f"{database}.dim_product"
    now = spark.table(table)
    dearer = now.withColumn("price", F.col("price") * 2)
    added = now.withColumn("product_id", F.concat(F.lit("new-"), F.col("product_id")))
    source = warehouse.conformed(dearer.unionByName(added), "dim_product")
    warehouse.upsert_table(source, table, schemas.NATURAL_KEYS["dim_product"], base)
    return spark.table(table).select("product_key", "product_id", "name", "price", "margin_percent")


@case(
    "upsert_partitions",
    """SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM orders
    UNION ALL SELECT -1 - o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'""",
)
def upsert_partitions(spark, sf_dir):
    """Finished orders get a new total, and as many new ones arrive; the other states are not rewritten."""
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "by-status")
    files.write_partitioned(orders, path, ["o_orderstatus"])
    finished = orders.filter("o_orderstatus = 'F'")
    changed = finished.withColumn("o_totalprice", -F.col("o_totalprice"))
    added = finished.withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    warehouse.upsert_partitions(changed.unionByName(added), path, ["o_orderkey"], ["o_orderstatus"])
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")


MOVED = "CASE o_orderstatus WHEN 'P' THEN 'F' WHEN 'F' THEN 'O' ELSE 'O' END"


@case(
    "upsert_partitions_moved",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 OR o_orderstatus = 'P' THEN {MOVED} ELSE o_orderstatus END AS o_orderstatus,
      CASE WHEN o_orderkey % 2 = 0 OR o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def upsert_partitions_moved(spark, sf_dir):
    """Some orders change state and leave their old partition, one partition with its last row."""
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "by-status")
    files.write_partitioned(orders, path, ["o_orderstatus"])
    some = orders.filter("o_orderkey % 2 = 0 OR o_orderstatus = 'P'")
    changed = some.withColumns({"o_orderstatus": F.expr(MOVED), "o_totalprice": -F.col("o_totalprice")})
    warehouse.upsert_partitions(changed, path, ["o_orderkey"], ["o_orderstatus"], follow_moves=True)
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@case(
    "source_health",
    " UNION ALL ".join(f"SELECT '{t}' AS source, true AS healthy, count(*) AS row_count FROM {t}" for t in ("orders", "lineitem", "customer", "part"))
    + " UNION ALL SELECT 'broken', false, count(*) FROM orders",
)
def source_health(spark, sf_dir):
    parts = []
    for name in ("orders", "lineitem", "customer", "part"):
        source = given(spark, sf_dir, name)
        counted = source.agg(F.count(F.lit(1)).alias("row_count"))
        healthy = layers.source_health(source)
        parts.append(counted.select(F.lit(name).alias("source"), F.lit(healthy).alias("healthy"), "row_count"))
    # Text where Parquet is expected: planning works, reading does not.
    path = scratch_path(spark, "broken")
    orders = given(spark, sf_dir, "orders")
    orders.select(F.col("o_orderkey").cast("string")).write.text(path)
    healthy = layers.source_health(spark.read.schema("o_orderkey string").parquet(path))
    counted = spark.read.text(path).agg(F.count(F.lit(1)).alias("row_count"))
    parts.append(counted.select(F.lit("broken").alias("source"), F.lit(healthy).alias("healthy"), "row_count"))
    return reduce(DataFrame.unionByName, parts)
