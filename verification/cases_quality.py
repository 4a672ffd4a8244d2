"""Quality checks, reports and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.labels import ORDER_STATUSES, PAYMENT_METHODS
from tidemark.plans.medallion import check_layer
from tidemark.quality import audits, checks, history, report
from tidemark.quality.suites import SUITES
from tidemark.session import scratch_path
from tidemark.sinks import warehouse
from tidemark.sources.delimited import schema_check as check_schema
from verification.bronze import NOW, given, raw_customers, raw_orders, raw_products
from verification.cases_relational import clean, star, stored_star, written
from verification.registry import case


def rows_of(results, *columns):
    """The columns all results share, then those named; counts that may be missing as doubles."""
    shared = ["check_name", "table_name", "column_name", "passed", F.col("violations").cast("double").alias("violations")]
    return results.select(*shared, *columns)


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def completeness_sql(source: str, table: str, columns, threshold: float) -> str:
    return union(
        f"""SELECT 'completeness_{c}' AS check_name, '{table}' AS table_name, '{c}' AS column_name,
        count({c}) >= {threshold}::DOUBLE * count(*) AS passed, CAST(count(*) - count({c}) AS DOUBLE) AS violations,
        round(CAST(count({c}) AS DOUBLE) / count(*) * 100, 2) AS actual, CAST({threshold * 100} AS DOUBLE) AS threshold
        FROM {source}"""
        for c in columns
    )


def uniqueness_sql(source: str, table: str, columns) -> str:
    return union(
        f"""SELECT 'uniqueness_{c}' AS check_name, '{table}' AS table_name, '{c}' AS column_name,
        count({c}) = count(DISTINCT {c}) AS passed, CAST(count({c}) - count(DISTINCT {c}) AS DOUBLE) AS violations,
        round(CAST(count({c}) - count(DISTINCT {c}) AS DOUBLE) / count({c}) * 100, 2) AS actual FROM {source}"""
        for c in columns
    )


def ranges_sql(source: str, table: str, bounds) -> str:
    return union(
        f"""SELECT 'range_{c}' AS check_name, '{table}' AS table_name, '{c}' AS column_name,
        count(*) FILTER ({c} < {low} OR {c} > {high}) = 0 AS passed,
        CAST(count(*) FILTER ({c} < {low} OR {c} > {high}) AS DOUBLE) AS violations,
        CAST(min({c}) AS DOUBLE) AS actual_min, CAST(max({c}) AS DOUBLE) AS actual_max FROM {source}"""
        for c, (low, high) in bounds.items()
    )


def allowed_sql(source: str, table: str, vocabularies) -> str:
    parts = []
    for c, allowed in vocabularies.items():
        bad = f"{c} NOT IN ({', '.join(repr(a) for a in allowed)})"
        parts.append(
            f"""SELECT 'allowed_values_{c}' AS check_name, '{table}' AS table_name, '{c}' AS column_name,
            count(*) FILTER ({bad}) = 0 AS passed, CAST(count(*) FILTER ({bad}) AS DOUBLE) AS violations,
            (SELECT coalesce(string_agg({c}, '|' ORDER BY {c}), '') FROM
              (SELECT DISTINCT {c} FROM {source} WHERE {bad} ORDER BY {c} LIMIT 5)) AS sample FROM {source}"""
        )
    return union(parts)


CUSTOMER_COLUMNS = ["customer_id", "email", "phone", "registration_date"]


@case("check_completeness", completeness_sql("raw_customers", "customers", CUSTOMER_COLUMNS, 0.97))
def check_completeness(spark, sf_dir):
    results = checks.check_completeness(raw_customers(spark, sf_dir), "customers", CUSTOMER_COLUMNS, 0.97, NOW)
    return rows_of(results, "actual", "threshold")


@case("check_uniqueness", uniqueness_sql("raw_customers", "customers", ["customer_id", "email"]))
def check_uniqueness(spark, sf_dir):
    results = checks.check_uniqueness(raw_customers(spark, sf_dir), "customers", ["customer_id", "email"], NOW)
    return rows_of(results, "actual")


BOUNDS = {"quantity": (1, 45), "unit_price": (0.01, 10000.0), "discount_percent": (0.0, 100.0)}


@case("check_value_ranges", ranges_sql("raw_orders", "orders", BOUNDS))
def check_value_ranges(spark, sf_dir):
    results = checks.check_value_ranges(raw_orders(spark, sf_dir), "orders", {**BOUNDS, "no_such_column": (0, 1)}, NOW)
    return rows_of(results, "actual_min", "actual_max")


@case(
    "check_allowed_values",
    allowed_sql("raw_orders", "orders", {"status": ORDER_STATUSES, "payment_method": PAYMENT_METHODS}),
)
def check_allowed_values(spark, sf_dir):
    vocabularies = {"status": ORDER_STATUSES, "payment_method": PAYMENT_METHODS}
    return rows_of(checks.check_allowed_values(raw_orders(spark, sf_dir), "orders", vocabularies, NOW), "sample")


@case(
    "check_freshness",
    """SELECT 'freshness' AS check_name, 'events' AS table_name, 'ts' AS column_name, age <= 24 AS passed,
      round(age, 2) AS actual, CAST(24 AS DOUBLE) AS threshold
    FROM (SELECT CAST(epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts)) AS DOUBLE) / 3.6e9 AS age FROM events)""",
)
def check_freshness(spark, sf_dir):
    """``ts`` has no time zone and neither has the moment it is compared with."""
    events = given(spark, sf_dir, "events")
    results = checks.check_freshness(events, "events", "ts", 24, "2024-01-31 00:00:00")
    return results.select("check_name", "table_name", "column_name", "passed", "actual", "threshold")


def suite_sql(name: str) -> str:
    """All checks of a silver table's suite, reduced to the columns they share."""
    wanted, source = SUITES[name]["checks"], f"silver_{name}"
    parts = [completeness_sql(source, name, wanted["completeness"]["columns"], wanted["completeness"]["threshold"])]
    parts.append(uniqueness_sql(source, name, wanted["uniqueness"]["columns"]))
    if "ranges" in wanted:
        parts.append(ranges_sql(source, name, wanted["ranges"]))
    if "allowed_values" in wanted:
        parts.append(allowed_sql(source, name, wanted["allowed_values"]))
    return union(f"SELECT check_name, table_name, column_name, passed, violations FROM ({p})" for p in parts)


ALL_SUITES = union(suite_sql(name) for name in SUITES)


@case("run_suite", ALL_SUITES)
def run_suite(spark, sf_dir):
    return rows_of(check_layer(clean(spark, sf_dir), now=NOW))


@case(
    "dq_report",
    f"""SELECT coalesce(table_name, 'ALL') AS table_name, count(*) AS total_checks,
      count(*) FILTER (passed) AS passed_checks, count(*) FILTER (NOT passed) AS failed_checks,
      round(CAST(count(*) FILTER (passed) AS DOUBLE) / count(*) * 100, 1) AS pass_rate
    FROM ({ALL_SUITES}) GROUP BY ROLLUP (table_name)""",
)
def dq_report(spark, sf_dir):
    return report.dq_report(check_layer(clean(spark, sf_dir), now=NOW))


@case(
    "dq_gate",
    f"SELECT table_name, check_name FROM ({ALL_SUITES}) "
    "WHERE NOT passed AND (check_name LIKE '%uniqueness%' OR check_name LIKE '%id%')",
)
def dq_gate(spark, sf_dir):
    """The checks that would stop the run before gold."""
    return report.critical_failures(check_layer(clean(spark, sf_dir), now=NOW)).select("table_name", "check_name")


@case(
    "min_date_rule",
    """SELECT 'min_date_order_date' AS check_name, 'orders' AS table_name, 'order_date' AS column_name,
      count(*) FILTER (CAST(order_date AS TIMESTAMP) < DATE '2024-01-01') = 0 AS passed,
      CAST(count(*) FILTER (CAST(order_date AS TIMESTAMP) < DATE '2024-01-01') AS DOUBLE) AS violations FROM raw_orders""",
)
def min_date_rule(spark, sf_dir):
    orders = raw_orders(spark, sf_dir).withColumn("order_date", F.col("order_date").cast("timestamp"))
    return rows_of(checks.check_min_date(orders, "orders", "order_date", "2024-01-01", NOW))


def contract_sql(table: str, contract: schemas.RowContract) -> str:
    rules = [(f"{c} required", f"{c} IS NULL") for c in contract.required]
    rules += [(f"{c} max_length", f"length({c}) > {n}") for c, n in contract.max_length.items()]
    rules += [(f"{c} above", f"{c} <= {n}") for c, n in contract.above.items()]
    rules += [(f"{c} at_least", f"{c} < {n}") for c, n in contract.at_least.items()]
    rules += [(f"{c} at_most", f"{c} > {n}") for c, n in contract.at_most.items()]
    return union(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, count(*) FILTER ({broken}) AS violations FROM {table}"
        for rule, broken in rules
    )


STRICT = schemas.RowContract(
    required=("email", "state"), max_length={"phone": 5, "email": 16}, at_least={"customer_key": 10}
)


@case(
    "row_contract_audit",
    union([contract_sql(t, c) for t, c in schemas.CONTRACTS.items()] + [contract_sql("dim_customer", STRICT)]),
)
def row_contract_audit(spark, sf_dir):
    """Every gold table against its own contract, and customers against one that they break."""
    tables = stored_star(spark, sf_dir)
    result = audits.row_contract_audit(tables["dim_customer"], "dim_customer", STRICT)
    for name, df in tables.items():
        result = result.unionByName(audits.row_contract_audit(df, name))
    return result


def keys_sql() -> str:
    parts = []
    for table, key in schemas.PRIMARY_KEYS.items():
        parts.append(
            f"SELECT '{table}' AS table_name, '{key}' AS column_name, 'primary key repeated' AS rule, "
            f"count({key}) - count(DISTINCT {key}) AS violations FROM {table}"
        )
        parts.append(f"SELECT '{table}', '{key}', 'not null', count(*) FILTER ({key} IS NULL) FROM {table}")
    for key, dimension in schemas.FOREIGN_KEYS.items():
        parts.append(
            f"SELECT 'fact_orders', '{key}', 'foreign key', count(*) FROM fact_orders "
            f"WHERE {key} NOT IN (SELECT {schemas.PRIMARY_KEYS[dimension]} FROM {dimension})"
        )
    return union(parts)


@case("key_integrity_audit", keys_sql())
def key_integrity_audit(spark, sf_dir):
    return audits.key_integrity_audit(stored_star(spark, sf_dir))


@case(
    "warehouse_monitor",
    union(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) = 0 AS is_empty, '{NOW}' AS latest FROM {t}" for t in schemas.GOLD
    ),
)
def warehouse_monitor(spark, sf_dir):
    loaded = {name: warehouse.with_load_time(df, NOW) for name, df in star(spark, sf_dir).items()}
    return audits.warehouse_monitor(loaded)


@case("run_suite_history", ALL_SUITES)
def run_suite_history(spark, sf_dir):
    """The suites over three batches of each table, of which only the states are kept."""
    store, parts = written(spark, "batches"), []
    periods = {"customers": F.date_format("registration_date", "yyyy-MM"), "products": F.col("category"), "orders": F.date_format("order_date", "yyyy-MM")}
    tables = clean(spark, sf_dir)
    for name, df in tables.items():
        kept = history.SuiteHistory(spark, scratch_path(spark, "states"), SUITES[name], periods[name])
        place = F.pmod(F.xxhash64(df.columns[0]), F.lit(3))
        for number in range(3):
            batch = store(f"{name}-{number}", df.filter(place == number))
            kept.add(batch, number)
        kept.add(batch, number)  # once more, as after a failure
        parts.append(rows_of(kept.results(df, NOW)))
    return reduce(DataFrame.unionByName, parts)


@case(
    "schema_check",
    "SELECT 'customers' AS table_name, false AS is_valid, 'loyalty_tier' AS missing, count(*) AS row_count FROM raw_customers "
    "UNION ALL SELECT 'products', true, '', count(*) FROM raw_products",
)
def schema_check(spark, sf_dir):
    customers = check_schema(raw_customers(spark, sf_dir), ["customer_id", "loyalty_tier", "email"])
    products = check_schema(raw_products(spark, sf_dir), schemas.BRONZE["products"].names)
    return customers.withColumn("table_name", F.lit("customers")).unionByName(
        products.withColumn("table_name", F.lit("products"))
    )


