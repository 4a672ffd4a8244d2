"""Bronze tables derived from the given ones, in SQL that Spark and DuckDB both accept.

The given tables are clean, so each expression makes some values dirty by key arithmetic. Every row of
the source tables is used; ``raw_products`` adds a second record for some parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NOW = "2027-06-30 00:00:00"

RAW_CUSTOMERS = r"""
SELECT
  'c' || c_custkey AS customer_id,
  CASE c_custkey % 3 WHEN 0 THEN '  JOÃO ' WHEN 1 THEN 'maria' ELSE 'ANA paula' END AS first_name,
  ' silva ' || c_custkey AS last_name,
  CASE
    WHEN c_custkey % 50 = 7 THEN NULL
    WHEN c_custkey % 40 = 3 THEN 'invalid-email'
    WHEN c_custkey % 60 = 17 THEN 'joão' || c_custkey || '@shop.com'
    WHEN c_custkey % 25 = 9 THEN 'user' || (c_custkey - 1) || '@shop.com'
    WHEN c_custkey % 25 = 11 THEN ' USER' || (c_custkey - 1) || '@Shop.com '
    ELSE 'user' || c_custkey || '@shop.com'
  END AS email,
  CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE '11-' || c_custkey END AS phone,
  'Rua ' || c_custkey AS address,
  n_name AS city,
  ' ' || n_name || ' ' AS state,
  '0' || c_custkey AS zip_code,
  'BR' AS country,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'B2C' WHEN 'FURNITURE' THEN ' b2b' WHEN 'MACHINERY' THEN 'Enterprise'
    WHEN 'BUILDING' THEN 'Premium' ELSE 'other' END AS segment,
  CASE WHEN c_custkey % 97 = 0 THEN 'not-a-date'
    ELSE '2024-0' || (1 + c_custkey % 9) || '-1' || (c_custkey % 10) || ' 10:00:00' END AS registration_date,
  c_custkey % 10 <> 0 AS is_active,
  c_custkey AS row_seq
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

RAW_PRODUCTS = r"""
SELECT
  'p' || p_partkey AS product_id,
  CASE WHEN copy = 0 THEN p_name ELSE p_name || ' (copy)' END AS name,
  lower(p_type) AS category,
  p_brand AS subcategory,
  CASE WHEN p_partkey % 100 = 4 THEN -price ELSE price END AS price,
  CASE WHEN p_partkey % 77 = 0 THEN CAST(0 AS DECIMAL(12,2))
    WHEN p_partkey % 30 = 0 THEN CAST(price * 1.20 AS DECIMAL(12,2))
    ELSE CAST(price * 0.65 AS DECIMAL(12,2)) END AS cost_price,
  CASE WHEN p_partkey % 33 = 0 THEN NULL ELSE CAST(p_size * 10 AS DOUBLE) END AS stock_quantity,
  CASE WHEN p_partkey % 45 = 0 THEN NULL ELSE 'Supplier ' || (p_partkey % 50) END AS supplier,
  CAST(1 + (p_partkey % 10) * 0.5 AS DECIMAL(2,1)) AS rating,
  'SKU-' || p_partkey AS sku,
  CASE WHEN p_partkey % 89 = 0 THEN 'soon' ELSE '2023-0' || (1 + p_partkey % 9) || '-2' || (p_partkey % 9) || ' 08:30:00' END
    AS created_at,
  p_partkey * 2 + copy AS row_seq
FROM (
  SELECT *, CAST(CAST(p_retailprice AS DECIMAL(12,2)) * (1 + p_partkey % 60) * 0.03 AS DECIMAL(12,2)) AS price
  FROM (
    SELECT *, 0 AS copy FROM {part}
    UNION ALL
    SELECT *, 1 AS copy FROM {part} WHERE p_partkey % 200 = 1
  ) AS records
) AS priced
"""

RAW_ORDERS = r"""
SELECT
  'o' || l_orderkey || '-' || l_linenumber AS order_id,
  CASE WHEN l_orderkey % 211 = 0 THEN 'c-missing' ELSE 'c' || o_custkey END AS customer_id,
  CASE WHEN l_partkey % 401 = 0 THEN NULL ELSE 'p' || l_partkey END AS product_id,
  CASE WHEN l_orderkey % 53 = 0 THEN 0 WHEN l_orderkey % 59 = 0 THEN NULL ELSE CAST(l_quantity AS INT) END AS quantity,
  CASE WHEN l_partkey % 90 = 0 THEN -unit_price ELSE unit_price END AS unit_price,
  CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS discount_percent,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS total_amount,
  CAST(o_orderdate + INTERVAL '28' YEAR AS STRING) AS order_date,
  CASE WHEN l_orderkey % 31 = 0 THEN 'unknown' WHEN o_orderstatus = 'F' THEN 'Completed'
    WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE ' shipped ' END AS status,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'credit_card' WHEN '2' THEN 'debit_card' WHEN '3' THEN ' PIX'
    WHEN '4' THEN 'boleto' ELSE 'wallet' END AS payment_method,
  CAST(CAST(l_tax AS DECIMAL(5,2)) * 100 AS DECIMAL(10,2)) AS shipping_cost,
  l_partkey, l_suppkey, l_extendedprice
FROM (
  SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.02 AS DECIMAL(10,2)) AS unit_price FROM {lineitem}
) AS lines JOIN {orders} ON l_orderkey = o_orderkey
"""

ORDER_BY = {
    "customers": ["row_seq"],
    "products": ["row_seq"],
    "orders": ["l_partkey", "l_suppkey", "l_extendedprice"],
}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        RAW_CUSTOMERS, customer=given(spark, sf_dir, "customer"), nation=given(spark, sf_dir, "nation")
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_PRODUCTS, part=given(spark, sf_dir, "part"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_ORDERS, lineitem=given(spark, sf_dir, "lineitem"), orders=given(spark, sf_dir, "orders"))


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": raw_customers(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "orders": raw_orders(spark, sf_dir),
    }
