import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """A one-column table, and its values after a change, in the order given."""

    def run(kind, rows, change):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
        return [r["v"] for r in change(df).orderBy("i").collect()]

    return run


CUSTOMERS = [
    ("c1", " João ", "Silva", "JOAO.SILVA@gmail.com", " (11) 99999-9999 ", "SP", "Premium", "2024-05-15 10:00:00", 1),
    ("c2", "maria", " Oliveira ", "maria.oliveira@outlook.com", None, "RJ", "b2c", "2024-06-20 14:30:00", 2),
    ("c3", "joão", "silva", "joao.silva@gmail.com", "x", "SP", "other", "soon", 3),
]
PRODUCTS = [
    ("p1", "Smartphone X", "electronics", "cellphones", 1200.0, 800.0, 50.0, "TechCorp", 4.5, "ELE-1", "2023-01-10 08:00:00", 1),
    ("p2", "T-Shirt Classic", "clothing", "t-shirts", -49.9, 60.0, None, "Wearable", 4.2, "CLO-2", "2023-02-15 09:00:00", 2),
]
ORDERS = [
    ("o1", "c1", "p1", 2, 1200.0, 10.0, 0.0, "2024-06-25 15:00:00", "Completed", "credit_card", 0.0),
    ("o1", "c2", "p1", 9, 1.0, 0.0, 0.0, "2024-06-25 15:00:00", "Completed", "credit_card", 0.0),
    ("o2", "c2", "p2", 1, -49.9, 0.0, 49.9, "2024-06-26 16:00:00", "odd", " PIX ", 15.0),
    ("o3", "c1", "p1", 3, 1200.0, 0.0, 0.0, "2028-12-31 23:59:59", "completed", "boleto", 0.0),
    ("o4", "gone", "p1", 3, 1200.0, 0.0, 0.0, "2024-01-01 00:00:00", "completed", "boleto", 0.0),
    ("o5", "c1", None, 1, 10.0, 5.0, 0.0, "2022-01-01 00:00:00", "RETURNED", "wallet", 0.0),
    ("o6", "c1", "p1", 0, 10.0, 5.0, 0.0, "2024-01-01 00:00:00", "completed", "wallet", 0.0),
    ("o7", "c1", "p1", None, 10.0, 5.0, 0.0, "2024-01-01 00:00:00", "completed", "wallet", 0.0),
    ("o8", "c1", "p1", 1, 10.0, 5.0, 0.0, "not a date", "completed", "wallet", 0.0),
]
ORDER_BY = {"customers": ["row_seq"], "products": ["row_seq"], "orders": ["customer_id"]}
NOW = "2024-12-31 00:00:00"


@pytest.fixture
def bronze(spark):
    customers = spark.createDataFrame(
        CUSTOMERS,
        "customer_id string, first_name string, last_name string, email string, phone string, state string, "
        "segment string, registration_date string, row_seq int",
    ).selectExpr("*", "'Rua A' AS address", "'São Paulo' AS city")
    products = spark.createDataFrame(
        PRODUCTS,
        "product_id string, name string, category string, subcategory string, price double, cost_price double, "
        "stock_quantity double, supplier string, rating double, sku string, created_at string, row_seq int",
    )
    orders = spark.createDataFrame(
        ORDERS,
        "order_id string, customer_id string, product_id string, quantity int, unit_price double, "
        "discount_percent double, total_amount double, order_date string, status string, payment_method string, "
        "shipping_cost double",
    )
    return {"customers": customers, "products": products, "orders": orders}
