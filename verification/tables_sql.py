"""The derived tables in DuckDB SQL: bronze, silver and gold."""

from __future__ import annotations

from verification import bronze

GIVEN = {t: t for t in ("customer", "nation", "part", "orders", "lineitem")}

EMAIL_PATTERN = "^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+[.][a-zA-Z0-9-.]+$"


def title(c: str) -> str:
    runs = rf"regexp_extract_all(lower(trim({c})), '(\p{{L}}+|\P{{L}}+)')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || w[2:]), '')"


def email(c: str) -> str:
    return f"CASE WHEN regexp_matches(lower(trim({c})), '{EMAIL_PATTERN}') THEN lower(trim({c})) END"


def segment(c: str) -> str:
    s = f"lower(trim({c}))"
    return f"CASE WHEN {s} IN ('b2c', 'b2b', 'premium', 'enterprise') THEN {s} ELSE 'b2c' END"


def status(c: str) -> str:
    s = f"lower(trim({c}))"
    accepted = "('completed', 'pending', 'shipped', 'cancelled', 'returned')"
    return f"CASE WHEN {s} IN {accepted} THEN {s} ELSE 'pending' END"


def line_share(percent: str) -> str:
    return f"CAST(CAST(quantity AS DECIMAL(10,0)) * unit_price * {percent} * 0.01 AS DECIMAL(12,2))"


def bucket(c: str) -> str:
    return f"substr(md5({c}), 1, 4)"


def numbered(c: str) -> str:
    return f"CAST(row_number() OVER (ORDER BY {bucket(c)}, {c}) AS BIGINT)"


LINE_TOTAL = line_share("(CAST(100 AS DECIMAL(5,2)) - discount_percent)")
LINE_DISCOUNT = line_share("discount_percent")
PRICE_RANGE = (
    "CASE WHEN price <= 50 THEN 'Budget' WHEN price <= 250 THEN 'Mid-Range' "
    "WHEN price <= 1000 THEN 'Premium' ELSE 'Luxury' END"
)
MARGIN = (
    "CASE WHEN price > 0 THEN round(CAST(price - cost_price AS DOUBLE) / CAST(price AS DOUBLE) * 100, 2) ELSE 0.0 END"
)
PLAUSIBLE_COST = (
    "CASE WHEN cost >= price OR cost <= 0 THEN CAST(round(price * 0.70, 2) AS DECIMAL(12,2)) ELSE cost END"
)
HOLIDAY = "month(d) * 100 + day(d) IN (101, 501, 907, 1012, 1102, 1115, 1225)"
ORDER_FIRST = "l_partkey, l_suppkey, l_extendedprice"

TABLES = {
    "raw_customers": bronze.RAW_CUSTOMERS.format(**GIVEN),
    "raw_products": bronze.RAW_PRODUCTS.format(**GIVEN),
    "raw_orders": bronze.RAW_ORDERS.format(**GIVEN),
    "silver_customers": f"""
        SELECT customer_id, {title('first_name')} AS first_name, {title('last_name')} AS last_name,
          {email('email')} AS email, coalesce(phone, 'N/A') AS phone, address, city,
          lower(trim(state)) AS state, zip_code, country, {segment('segment')} AS segment,
          TRY_CAST(registration_date AS TIMESTAMP) AS registration_date, is_active
        FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY row_seq) AS rn FROM raw_customers)
        WHERE rn = 1""",
    "silver_products": f"""
        SELECT product_id, name, category, subcategory, price, {PLAUSIBLE_COST} AS cost_price, stock_quantity,
          supplier, rating, sku, created_at
        FROM (
          SELECT product_id, name, {title('category')} AS category, {title('subcategory')} AS subcategory,
            abs(price) AS price, abs(cost_price) AS cost, CAST(coalesce(stock_quantity, 0) AS BIGINT) AS stock_quantity,
            supplier, rating, sku, TRY_CAST(created_at AS TIMESTAMP) AS created_at
          FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY row_seq) AS rn FROM raw_products)
          WHERE rn = 1)""",
    "valid_orders": """
        SELECT * FROM raw_orders
        WHERE (customer_id IS NULL OR customer_id IN (SELECT customer_id FROM silver_customers))
          AND (product_id IS NULL OR product_id IN (SELECT product_id FROM silver_products))""",
    "silver_orders": f"""
        SELECT order_id, customer_id, product_id, quantity, unit_price, discount_percent,
          {LINE_TOTAL} AS total_amount, order_date, status, payment_method, shipping_cost
        FROM (
          SELECT order_id, customer_id, product_id, quantity, abs(unit_price) AS unit_price, discount_percent,
            CAST(order_date AS TIMESTAMP) AS order_date, {status('status')} AS status,
            lower(trim(payment_method)) AS payment_method, shipping_cost
          FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {ORDER_FIRST}) AS rn FROM valid_orders)
          WHERE rn = 1)
        WHERE order_date <= TIMESTAMP '{bronze.NOW}' AND quantity > 0""",
    "dim_date": f"""
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
          CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, CAST(day(d) AS INTEGER) AS day_of_month,
          CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
          CAST(year(d) AS INTEGER) AS year, isodow(d) >= 6 AS is_weekend, day(d) = 1 AS is_month_start,
          last_day(d) = d AS is_month_end, {HOLIDAY} AS is_holiday
        FROM (SELECT CAST(unnest(generate_series(DATE '2023-01-01', DATE '2027-12-31', INTERVAL 1 DAY)) AS DATE) AS d)""",
    "dim_customer": f"""
        SELECT {numbered('customer_id')} AS customer_key, customer_id, first_name, last_name, email, phone, address,
          city, state, segment, DATE '2024-01-01' AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current
        FROM silver_customers""",
    "dim_product": f"""
        SELECT {numbered('product_id')} AS product_key, product_id, name, category, subcategory, price, cost_price,
          {PRICE_RANGE} AS price_range, {MARGIN} AS margin_percent, supplier, rating
        FROM silver_products""",
    "fact_orders": f"""
        SELECT {numbered('order_id')} AS order_key, order_id, coalesce(customer_key, -1) AS customer_key,
          coalesce(product_key, -1) AS product_key, coalesce(dim_date.date_key, 19000101) AS date_key, quantity,
          unit_price, discount_percent, {LINE_DISCOUNT} AS discount_amount, total_amount, total_amount AS net_amount,
          shipping_cost, payment_method, status AS order_status
        FROM silver_orders
        LEFT JOIN (SELECT customer_key, customer_id AS c_id FROM dim_customer) ON customer_id = c_id
        LEFT JOIN (SELECT product_key, product_id AS p_id FROM dim_product) ON product_id = p_id
        LEFT JOIN dim_date ON dim_date.full_date = CAST(order_date AS DATE)""",
}
