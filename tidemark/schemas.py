"""One StructType per table, and the rules each gold row has to keep."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def table_schema(**columns: str | T.DataType) -> T.StructType:
    """A StructType from ``name=type``; type names as in a schema's JSON form, so no session is needed."""
    schema = T.StructType()
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return schema


BRONZE = {
    "customers": table_schema(
        customer_id="string", first_name="string", last_name="string", email="string", phone="string",
        address="string", city="string", state="string", zip_code="string", country="string", segment="string",
        registration_date="string", is_active="boolean",
    ),
    "products": table_schema(
        product_id="string", name="string", category="string", subcategory="string", price="double",
        cost_price="double", stock_quantity="double", supplier="string", rating="double", sku="string",
        created_at="string",
    ),
    "orders": table_schema(
        order_id="string", customer_id="string", product_id="string", quantity="integer", unit_price="double",
        discount_percent="double", total_amount="double", order_date="string", status="string",
        payment_method="string", shipping_cost="double",
    ),
}

CATALOG_PRODUCT = table_schema(
    id="long", title="string", price="double", description="string", category="string", image="string",
    rating=table_schema(rate="double", count="long"),
)

CATALOG_USER = table_schema(
    id="long", email="string", username="string", phone="string",
    name=table_schema(firstname="string", lastname="string"),
    address=table_schema(
        city="string", street="string", number="long", zipcode="string",
        geolocation=table_schema(lat="string", long="string"),
    ),
)

GOLD = {
    "dim_date": table_schema(
        date_key="integer", full_date="date", day_of_week="integer", day_name="string", day_of_month="integer",
        month="integer", month_name="string", quarter="integer", year="integer", is_weekend="boolean",
        is_month_start="boolean", is_month_end="boolean", is_holiday="boolean",
    ),
    "dim_customer": table_schema(
        customer_key="long", customer_id="string", first_name="string", last_name="string", email="string",
        phone="string", address="string", city="string", state="string", segment="string", valid_from="date",
        valid_to="date", is_current="boolean",
    ),
    "dim_product": table_schema(
        product_key="long", product_id="string", name="string", category="string", subcategory="string",
        price="decimal(10,2)", cost_price="decimal(10,2)", price_range="string", margin_percent="decimal(5,2)",
        supplier="string", rating="decimal(2,1)",
    ),
    "fact_orders": table_schema(
        order_key="long", order_id="string", customer_key="long", product_key="long", date_key="integer",
        quantity="integer", unit_price="decimal(10,2)", discount_percent="decimal(5,2)",
        discount_amount="decimal(10,2)", total_amount="decimal(10,2)", net_amount="decimal(10,2)",
        shipping_cost="decimal(10,2)", payment_method="string", order_status="string",
    ),
}

# Natural keys, used for upserts, and surrogate keys, audited for uniqueness.
NATURAL_KEYS = {
    "dim_date": ["date_key"],
    "dim_customer": ["customer_id", "valid_from"],
    "dim_product": ["product_id"],
    "fact_orders": ["order_id"],
}
# The column in which warehouse tables keep the time that a row was loaded.
LOADED_AT = "created_at"
PRIMARY_KEYS = {
    "dim_date": "date_key",
    "dim_customer": "customer_key",
    "dim_product": "product_key",
    "fact_orders": "order_key",
}
FOREIGN_KEYS = {"customer_key": "dim_customer", "product_key": "dim_product", "date_key": "dim_date"}


@dataclass(frozen=True)
class RowContract:
    """What every row of a table must satisfy."""

    required: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    above: dict[str, float] = field(default_factory=dict)
    at_least: dict[str, float] = field(default_factory=dict)
    at_most: dict[str, float] = field(default_factory=dict)


# Required columns, text lengths and numeric bounds of the gold rows.
CONTRACTS = {
    "dim_date": RowContract(
        required=tuple(GOLD["dim_date"].names),
        max_length={"day_name": 15, "month_name": 15},
        at_least={"day_of_week": 0, "day_of_month": 1, "month": 1, "quarter": 1},
        at_most={"day_of_week": 6, "day_of_month": 31, "month": 12, "quarter": 4},
    ),
    "dim_customer": RowContract(
        required=("customer_key", "customer_id", "first_name", "last_name", "valid_from", "valid_to", "is_current"),
        max_length={
            "customer_id": 36, "first_name": 100, "last_name": 100, "email": 255, "phone": 50, "address": 255,
            "city": 100, "state": 50, "segment": 50,
        },
    ),
    "dim_product": RowContract(
        required=(
            "product_key", "product_id", "name", "category", "subcategory", "price", "cost_price", "price_range",
            "margin_percent",
        ),
        max_length={
            "product_id": 36, "name": 255, "category": 100, "subcategory": 100, "price_range": 50, "supplier": 255,
        },
        above={"price": 0, "cost_price": 0},
        at_least={"rating": 1.0},
        at_most={"rating": 5.0},
    ),
    "fact_orders": RowContract(
        required=(
            "order_key", "order_id", "customer_key", "product_key", "date_key", "quantity", "unit_price",
            "total_amount", "net_amount",
        ),
        max_length={"order_id": 36, "payment_method": 50, "order_status": 50},
        above={"quantity": 0, "unit_price": 0},
        at_least={
            "discount_percent": 0.0, "discount_amount": 0.0, "total_amount": 0.0, "net_amount": 0.0,
            "shipping_cost": 0.0,
        },
        at_most={"discount_percent": 100.0},
    ),
}
