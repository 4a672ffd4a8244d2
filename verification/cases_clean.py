"""Column functions and row filters, on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import dates, labels, money
from tidemark.operators import cleaning, filters, nulls
from tidemark.plans import silver
from verification import tables_sql as q
from verification.bronze import NOW, raw_customers, raw_orders, raw_products
from verification.registry import case

LINE = ["order_id", "l_partkey", "l_suppkey"]
LINE_SQL = "order_id, l_partkey, l_suppkey"


@case("standardize_strings", "SELECT customer_id, lower(trim(state)) AS state, lower(trim(segment)) AS segment FROM raw_customers")
def standardize_strings(spark, sf_dir):
    df = cleaning.standardize_strings(raw_customers(spark, sf_dir), ["state", "segment", "no_such_column"])
    return df.select("customer_id", "state", "segment")


@case(
    "normalize_names",
    f"SELECT customer_id, {q.title('first_name')} AS first_name, {q.title('last_name')} AS last_name, "
    f"{q.title('email')} AS email FROM raw_customers",
)
def normalize_names(spark, sf_dir):
    df = cleaning.normalize_names(raw_customers(spark, sf_dir), ["first_name", "last_name", "email"])
    return df.select("customer_id", "first_name", "last_name", "email")


@case("clean_email", f"SELECT customer_id, {q.email('email')} AS email FROM raw_customers")
def clean_email(spark, sf_dir):
    return cleaning.clean_email(raw_customers(spark, sf_dir), "email").select("customer_id", "email")


@case(
    "mask_tax_id",
    r"""SELECT c_custkey, regexp_replace(substr(d, 1, 3) || '.' || substr(d, 4, 3) || '.' || substr(d, 7, 3) || '-' || substr(d, 10, 2), 'x', '') AS tax_id
    FROM (SELECT c_custkey, lpad(CAST(c_custkey * 7919 + 10000000 AS VARCHAR), 11, '0') AS d FROM customer)""",
)
def mask_tax_id(spark, sf_dir):
    """Ids arrive as bare digits, or with the separators in the wrong places."""
    digits = F.lpad((F.col("c_custkey") * 7919 + 10000000).cast("string"), 11, "0")
    loose = F.concat(F.left(digits, F.lit(5)), F.lit(" .-"), F.substring(digits, 6, 6))
    given = F.when(F.col("c_custkey") % 2 == 0, digits).otherwise(loose)
    df = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", given.alias("tax_id"))
    return cleaning.mask_tax_id(df, "tax_id")


@case(
    "fix_negative_values",
    f"SELECT {LINE_SQL}, CAST(abs(unit_price) AS DOUBLE) AS unit_price, "
    "CAST(greatest(unit_price, 0) AS DOUBLE) AS floored FROM raw_orders",
)
def fix_negative_values(spark, sf_dir):
    df = raw_orders(spark, sf_dir).withColumn("floored", F.col("unit_price"))
    df = cleaning.fix_negative_values(df, ["unit_price"], "absolute")
    return cleaning.fix_negative_values(df, ["floored"], "zero").select(*LINE, "unit_price", "floored")


@case(
    "round_currency",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.065, 2) AS DOUBLE) AS tax, "
    "round_even(l_extendedprice * 0.065 * 100, 0) / 100 AS tax_double FROM lineitem",
)
def round_currency(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    exact = F.col("l_extendedprice").cast("decimal(12,2)") * F.lit("0.065").cast("decimal(3,3)")
    df = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", exact.alias("tax"),
        (F.col("l_extendedprice") * 0.065).alias("tax_double"),
    )
    return cleaning.round_currency(df, ["tax", "tax_double"])


@case(
    "parse_dates",
    "SELECT customer_id, CAST(TRY_CAST(registration_date AS TIMESTAMP) AS VARCHAR) AS registration_date FROM raw_customers",
)
def parse_dates(spark, sf_dir):
    df = cleaning.parse_dates(raw_customers(spark, sf_dir), ["registration_date"])
    return df.select("customer_id", "registration_date")


MIXED = "CASE row_seq % 4 WHEN 0 THEN '2024-03-0' || (1 + row_seq % 9) WHEN 1 THEN '0' || (1 + row_seq % 9) || '/04/2024' WHEN 2 THEN '0' || (1 + row_seq % 9) || '.05.2024 07:30' ELSE 'soon' END"


@case(
    "parse_dates_formats",
    """SELECT customer_id, CASE row_seq % 4 WHEN 0 THEN '2024-03-0' || (1 + row_seq % 9) || ' 00:00:00' WHEN 1 THEN '2024-04-0' || (1 + row_seq % 9) || ' 00:00:00'
      WHEN 2 THEN '2024-05-0' || (1 + row_seq % 9) || ' 07:30:00' END AS registration_date FROM raw_customers""",
)
def parse_dates_formats(spark, sf_dir):
    """Dates in three notations in one column, and text that is none."""
    mixed = raw_customers(spark, sf_dir).withColumn("registration_date", F.expr(MIXED))
    parsed = cleaning.parse_dates(mixed, ["registration_date"], [None, "dd/MM/yyyy", "dd.MM.yyyy HH:mm"])
    return parsed.select("customer_id", "registration_date")


@case(
    "handle_nulls_fill_value",
    "SELECT customer_id, coalesce(phone, 'N/A') AS phone, coalesce(email, 'none:given') AS email FROM raw_customers",
)
def handle_nulls_fill_value(spark, sf_dir):
    df = nulls.handle_nulls(
        raw_customers(spark, sf_dir), {"phone": "fill_value:N/A", "email": "fill_value:none:given"}
    )
    return df.select("customer_id", "phone", "email")


@case("map_status", f"SELECT {LINE_SQL}, {q.status('status')} AS status FROM raw_orders")
def map_status(spark, sf_dir):
    return raw_orders(spark, sf_dir).select(*LINE, labels.order_status(F.col("status")).alias("status"))


@case("clean_segment", f"SELECT customer_id, {q.segment('segment')} AS segment FROM raw_customers")
def clean_segment(spark, sf_dir):
    return raw_customers(spark, sf_dir).select("customer_id", labels.segment(F.col("segment")).alias("segment"))


@case(
    "adjust_cost_price",
    f"SELECT row_seq, CAST({q.PLAUSIBLE_COST} AS DOUBLE) AS cost_price "
    "FROM (SELECT row_seq, abs(price) AS price, cost_price AS cost FROM raw_products)",
)
def adjust_cost_price(spark, sf_dir):
    df = cleaning.fix_negative_values(raw_products(spark, sf_dir), ["price"])
    return df.select("row_seq", money.plausible_cost(F.col("price"), F.col("cost_price")).alias("cost_price"))


@case("recalc_total", f"SELECT {LINE_SQL}, CAST({q.LINE_TOTAL} AS DOUBLE) AS total_amount FROM raw_orders")
def recalc_total(spark, sf_dir):
    total = money.line_total(F.col("quantity"), F.col("unit_price"), F.col("discount_percent"))
    return raw_orders(spark, sf_dir).select(*LINE, total.alias("total_amount"))


@case("discount_amount", f"SELECT {LINE_SQL}, CAST({q.LINE_DISCOUNT} AS DOUBLE) AS discount_amount FROM raw_orders")
def discount_amount(spark, sf_dir):
    discount = money.line_discount(F.col("quantity"), F.col("unit_price"), F.col("discount_percent"))
    return raw_orders(spark, sf_dir).select(*LINE, discount.alias("discount_amount"))


@case("margin_percent", f"SELECT row_seq, {q.MARGIN} AS margin_percent FROM raw_products")
def margin_percent(spark, sf_dir):
    margin = money.margin_percent(F.col("price"), F.col("cost_price"))
    return raw_products(spark, sf_dir).select("row_seq", margin.alias("margin_percent"))


@case("price_range", f"SELECT row_seq, {q.PRICE_RANGE} AS price_range FROM raw_products")
def price_range(spark, sf_dir):
    return raw_products(spark, sf_dir).select("row_seq", money.price_range(F.col("price")).alias("price_range"))


@case("date_key", f"SELECT {LINE_SQL}, CAST(strftime(CAST(order_date AS TIMESTAMP), '%Y%m%d') AS INTEGER) AS date_key FROM raw_orders")
def date_key(spark, sf_dir):
    df = cleaning.parse_dates(raw_orders(spark, sf_dir), ["order_date"])
    return df.select(*LINE, dates.date_key(F.col("order_date")).alias("date_key"))


@case("processed_at", f"SELECT customer_id, '{NOW}' AS processed_at FROM raw_customers")
def processed_at(spark, sf_dir):
    return silver.processed_at(raw_customers(spark, sf_dir), NOW).select("customer_id", "processed_at")


@case("cast_stock", "SELECT row_seq, CAST(coalesce(stock_quantity, 0) AS BIGINT) AS stock_quantity FROM raw_products")
def cast_stock(spark, sf_dir):
    df = nulls.handle_nulls(raw_products(spark, sf_dir), {"stock_quantity": silver.STOCK_FILL})
    return df.select("row_seq", F.col("stock_quantity").cast("bigint").alias("stock_quantity"))


@case("project_rename", f"SELECT {LINE_SQL}, CAST(shipping_cost AS DOUBLE) AS shipping_cost, status AS order_status FROM raw_orders")
def project_rename(spark, sf_dir):
    df = raw_orders(spark, sf_dir).withColumnRenamed("status", "order_status")
    return df.select(*LINE, "shipping_cost", "order_status")


@case("remove_future_dates", f"SELECT {LINE_SQL}, order_date FROM raw_orders WHERE CAST(order_date AS TIMESTAMP) <= TIMESTAMP '{NOW}'")
def remove_future_dates(spark, sf_dir):
    return filters.remove_future_dates(raw_orders(spark, sf_dir), "order_date", NOW).select(*LINE, "order_date")


@case("filter_invalid_quantity", f"SELECT {LINE_SQL}, quantity FROM raw_orders WHERE quantity > 0")
def filter_invalid_quantity(spark, sf_dir):
    return filters.valid_quantity(raw_orders(spark, sf_dir)).select(*LINE, "quantity")


@case("handle_nulls_drop", "SELECT customer_id, email FROM raw_customers WHERE email IS NOT NULL")
def handle_nulls_drop(spark, sf_dir):
    return nulls.handle_nulls(raw_customers(spark, sf_dir), {"email": "drop"}).select("customer_id", "email")


@case(
    "filter_priced_products",
    "SELECT row_seq, CAST(price AS DOUBLE) AS price FROM raw_products "
    "WHERE price > 0 OR NOT EXISTS (SELECT 1 FROM raw_products WHERE price > 0)",
)
def filter_priced_products(spark, sf_dir):
    return filters.priced_products(raw_products(spark, sf_dir)).select("row_seq", "price")


@case(
    "handle_nulls_mean",
    f"SELECT {LINE_SQL}, round(coalesce(quantity, (SELECT avg(quantity) FROM raw_orders)), 6) AS quantity FROM raw_orders",
)
def handle_nulls_mean(spark, sf_dir):
    df = nulls.handle_nulls(raw_orders(spark, sf_dir), {"quantity": "fill_mean"})
    return df.select(*LINE, F.round("quantity", 6).alias("quantity"))


@case(
    "handle_nulls_median",
    f"SELECT {LINE_SQL}, CAST(coalesce(quantity, (SELECT median(quantity) FROM raw_orders)) AS DOUBLE) AS quantity FROM raw_orders",
)
def handle_nulls_median(spark, sf_dir):
    return nulls.handle_nulls(raw_orders(spark, sf_dir), {"quantity": "fill_median"}).select(*LINE, "quantity")


GAPS = {"discount_percent": "l_suppkey % 5 = 0", "shipping_cost": "l_partkey % 3 = 0"}


def _cents_median(column: str) -> str:
    return f"(SELECT floor(median(CAST({column} * 100 AS BIGINT)) + 0.5) / 100 FROM raw_orders WHERE NOT {GAPS[column]})"


@case(
    "handle_nulls_median_columns",
    f"SELECT {LINE_SQL}, CAST(coalesce(quantity, (SELECT median(quantity) FROM raw_orders)) AS DOUBLE) AS quantity, "
    + ", ".join(f"CAST(CASE WHEN {gap} THEN {_cents_median(c)} ELSE {c} END AS DOUBLE) AS {c}" for c, gap in GAPS.items())
    + " FROM raw_orders",
)
def handle_nulls_median_columns(spark, sf_dir):
    """Three columns with gaps, whose medians are found together."""
    holes = {c: F.when(~F.expr(gap), F.col(c)) for c, gap in GAPS.items()}
    filled = nulls.handle_nulls(raw_orders(spark, sf_dir).withColumns(holes), dict.fromkeys(["quantity", *GAPS], "fill_median"), finish_rows=1000)
    return filled.select(*LINE, F.col("quantity").cast("double"), *GAPS)


@case(
    "handle_nulls_median_rounds",
    f"SELECT {LINE_SQL}, CAST(coalesce(unit_price, (SELECT floor(median(CAST(unit_price * 100 AS BIGINT)) + 0.5) / 100 FROM (SELECT CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE unit_price END AS unit_price FROM raw_orders))) AS DOUBLE) AS unit_price "
    "FROM (SELECT * REPLACE (CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE unit_price END AS unit_price) FROM raw_orders)",
)
def handle_nulls_median_rounds(spark, sf_dir):
    """The median of a decimal, bracketed round by round down to a few rows."""
    orders = raw_orders(spark, sf_dir).withColumn("unit_price", F.when(F.col("l_partkey") % 7 != 0, F.col("unit_price")))
    return nulls.handle_nulls(orders, {"unit_price": "fill_median"}, finish_rows=50).select(*LINE, "unit_price")



@case(
    "handle_nulls_mode",
    "SELECT row_seq, coalesce(supplier, (SELECT supplier FROM raw_products WHERE supplier IS NOT NULL "
    "GROUP BY supplier ORDER BY count(*) DESC, supplier LIMIT 1)) AS supplier FROM raw_products",
)
def handle_nulls_mode(spark, sf_dir):
    return nulls.handle_nulls(raw_products(spark, sf_dir), {"supplier": "fill_mode"}).select("row_seq", "supplier")
