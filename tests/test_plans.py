from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import NOW, ORDER_BY
from tidemark import schemas
from tidemark.plans import gold, medallion, sales, silver
from tidemark.quality import audits
from tidemark.quality.report import QualityGateError
from tidemark.quality.suites import SUITES
from tidemark.sources import layers


def by_id(df, column):
    return {r[column]: r for r in df.collect()}


@pytest.fixture
def cleaned(bronze):
    return silver.build_silver(bronze, ORDER_BY, NOW)


def test_silver_customers(cleaned):
    rows = by_id(cleaned["customers"], "customer_id")
    assert set(rows) == {"c1", "c2", "c3"}  # the two spellings of one address both survive
    assert rows["c1"]["email"] == rows["c3"]["email"] == "joao.silva@gmail.com"
    assert (rows["c1"]["first_name"], rows["c2"]["last_name"], rows["c2"]["phone"]) == ("João", "Oliveira", "N/A")
    assert (rows["c1"]["segment"], rows["c3"]["segment"], rows["c1"]["state"]) == ("premium", "b2c", "sp")
    assert rows["c3"]["registration_date"] is None and str(rows["c1"]["processed_at"]) == NOW


def test_silver_customers_by_clean_address(bronze):
    rows = by_id(silver.silver_customers(bronze["customers"], ["row_seq"], NOW, normalize_first=True), "customer_id")
    assert set(rows) == {"c1", "c2"}


def test_silver_products(cleaned):
    row = by_id(cleaned["products"], "product_id")["p2"]
    assert (str(row["price"]), str(row["cost_price"]), row["stock_quantity"]) == ("49.90", "34.93", 0)
    assert (row["category"], row["subcategory"]) == ("Clothing", "T-Shirts")


def test_silver_orders(cleaned):
    rows = by_id(cleaned["orders"], "order_id")
    assert set(rows) == {"o1", "o2", "o5", "o8"}
    assert (rows["o1"]["quantity"], str(rows["o1"]["total_amount"])) == (2, "2160.00")
    assert (rows["o2"]["status"], rows["o2"]["payment_method"], str(rows["o2"]["unit_price"])) == ("pending", "pix", "49.90")


def test_only_what_is_given(spark, bronze):
    alone = silver.build_silver({"orders": bronze["orders"]}, ORDER_BY, NOW)
    assert set(alone) == {"orders"} and "o4" in by_id(alone["orders"], "order_id")
    assert set(gold.build_gold(spark, alone)) == {"dim_date"}


def test_calendar(spark):
    days = by_id(gold.dim_date(spark), "date_key")
    assert len(days) == 1826
    assert days[20240229].asDict() == {
        "date_key": 20240229, "full_date": date(2024, 2, 29), "day_of_week": 3, "day_name": "Thursday",
        "day_of_month": 29, "month": 2, "month_name": "February", "quarter": 1, "year": 2024, "is_weekend": False,
        "is_month_start": False, "is_month_end": True, "is_holiday": False,
    }
    assert sum(d["is_holiday"] for d in days.values()) == 7 * 5


def test_star(spark, cleaned):
    star = gold.build_gold(spark, cleaned)
    facts = by_id(star["fact_orders"], "order_id")
    customers, products = by_id(star["dim_customer"], "customer_id"), by_id(star["dim_product"], "product_id")
    assert sorted(f["order_key"] for f in facts.values()) == [1, 2, 3, 4]
    assert facts["o1"]["customer_key"] == customers["c1"]["customer_key"]
    assert facts["o1"]["product_key"] == products["p1"]["product_key"]
    assert (str(facts["o1"]["discount_amount"]), facts["o1"]["net_amount"]) == ("240.00", facts["o1"]["total_amount"])
    assert (facts["o5"]["product_key"], facts["o5"]["date_key"], facts["o8"]["date_key"]) == (-1, 19000101, 19000101)
    assert facts["o5"]["order_status"] == "returned"
    assert (products["p1"]["price_range"], products["p1"]["margin_percent"]) == ("Luxury", Decimal("33.33"))
    assert tuple(audits.orphan_audit(star["fact_orders"]).first()) == (4, 0, 1, 2)
    for name, df in star.items():
        assert df.columns == schemas.GOLD[name].names
    broken = audits.key_integrity_audit(star).filter("violations > 0")
    assert {(r["column_name"], r["violations"]) for r in broken.collect()} == {("product_key", 1), ("date_key", 2)}
    assert audits.key_integrity_audit(gold.with_unknown_members(star)).filter("violations > 0").isEmpty()


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_customer_version_of_the_day(spark, cleaned, broadcast_bytes):
    star = gold.build_gold(spark, cleaned)
    first = star["dim_customer"].withColumns(
        {"valid_to": F.lit("2024-06-24").cast("date"), "is_current": F.lit(False)}
    )
    second = star["dim_customer"].withColumns(
        {"customer_key": F.col("customer_key") + 10, "valid_from": F.lit("2024-06-25").cast("date")}
    )
    history = first.unionByName(second)
    fact = gold.fact_orders(
        cleaned["orders"], history, star["dim_product"], star["dim_date"], as_of=True, broadcast_bytes=broadcast_bytes
    )
    found = by_id(fact, "order_id")
    assert found["o1"]["customer_key"] > 10 and len(found) == 4
    early, undated = found["o5"]["customer_key"], found["o8"]["customer_key"]  # the first version has no beginning; no date means now
    assert early == found["o1"]["customer_key"] - 10 and undated == found["o1"]["customer_key"]


def test_sales(spark, cleaned):
    star = gold.build_gold(spark, cleaned)
    rows = {(r["grain"], r["label"]): r["lines"] for r in sales.sales_by_calendar(star["fact_orders"], star["dim_date"]).collect()}
    assert rows == {
        ("year", "2024"): 2, ("month", "2024-06"): 2, ("quarter", "2024-Q2"): 2, ("weekday", "Tuesday"): 1,
        ("weekday", "Wednesday"): 1, ("holiday", "false"): 2,
        **{(grain, "unknown"): 2 for grain in ("year", "month", "quarter", "weekday", "holiday")},
    }
    assert sales.payment_method_top_avg(star["fact_orders"]).first()["payment_method"] == "credit_card"


def test_the_whole_run(spark, bronze, tmp_path):
    orders = bronze["orders"].filter("product_id is not null and order_id <> 'o8'")
    bronze["orders"] = orders.unionByName(orders.filter("order_id = 'o2'").withColumn("order_id", F.lit("o9")))
    suites = {"orders": SUITES["orders"], "products": SUITES["products"]}

    def run(place):
        return medallion.run_medallion(spark, bronze, str(place), ORDER_BY, NOW, suites, "run_test")

    tables = run(tmp_path / "1")
    assert set(tables) == set(schemas.GOLD)
    assert spark.table("run_test.fact_orders").count() == tables["fact_orders"].count() == 3
    assert layers.read_layer(spark, str(tmp_path / "1"), "quality", ["results"])["results"].count() == 24
    keys = {r["order_id"]: r["order_key"] for r in spark.table("run_test.fact_orders").collect()}

    # Another batch: a changed customer, a new one, an order again and a new one.
    customers = bronze["customers"].filter("customer_id <> 'c2'")
    customers = customers.withColumn("city", F.when(F.col("customer_id") == "c1", "Recife").otherwise(F.col("city")))
    bronze["customers"] = customers.withColumn("customer_id", F.when(F.col("customer_id") == "c3", "c9").otherwise(F.col("customer_id")))
    bronze["orders"] = orders.filter("order_id = 'o1'").unionByName(
        orders.filter("order_id = 'o1' AND customer_id = 'c1'").selectExpr("* EXCEPT (order_id, customer_id)", "'o10' AS order_id", "'c9' AS customer_id")
    )
    with pytest.raises(ValueError, match="later batch"):
        run(tmp_path / "2")
    medallion.run_medallion(spark, bronze, str(tmp_path / "2"), ORDER_BY, NOW, suites, "run_test", effective="2024-06-01")
    star = {name: spark.table(f"run_test.{name}") for name in schemas.GOLD}
    after = {r["order_id"]: r["order_key"] for r in star["fact_orders"].collect()}
    assert keys.items() <= after.items() and set(after) - set(keys) == {"o10"} and len(after) == 4
    assert audits.key_integrity_audit({n: d.select(*schemas.GOLD[n].names) for n, d in star.items()}).filter("violations > 0").isEmpty()
    joined = star["fact_orders"].join(star["dim_customer"], "customer_key").filter("order_id = 'o1'").first()
    assert (joined["customer_id"], joined["city"], str(joined["valid_from"])) == ("c1", "Recife", "2024-06-01")
    spark.sql("DROP DATABASE run_test CASCADE")


def test_orders_that_change_month_are_not_doubled(spark, bronze, tmp_path):
    orders = bronze["orders"].filter("order_id IN ('o1', 'o2')")
    orders = orders.unionByName(orders.filter("order_id = 'o1'").withColumn("order_id", F.lit("o11")))
    suites = {"products": SUITES["products"]}
    moved = orders.filter("order_id <> 'o2'").withColumn("order_date", F.lit("2024-08-03 10:00:00"))
    for k, batch in enumerate((orders, moved)):  # o2 stays in the month that the others leave, which the second batch does not name
        bronze["orders"] = batch
        medallion.run_medallion(spark, bronze, str(tmp_path / str(k)), ORDER_BY, NOW, suites, "run_moved", effective="2024-06-01")
        found = spark.table("run_moved.fact_orders").collect()
        if k == 0:
            keys = {r["order_id"]: r["order_key"] for r in found}
    assert sorted(r["order_id"] for r in found) == sorted(keys) and {r["order_id"]: r["order_key"] for r in found} == keys
    assert {r["order_id"]: r["month"] for r in found if r["order_id"] != "o2"} == dict.fromkeys(set(keys) - {"o2"}, 8)
    spark.sql("DROP DATABASE run_moved CASCADE")


def test_gold_has_the_declared_types(spark, cleaned):
    for name, df in gold.build_gold(spark, cleaned, unknown_members=True).items():
        assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schemas.GOLD[name].fields]


def test_numbers_out_of_range_are_set_aside(spark, bronze):
    bronze["orders"] = bronze["orders"].withColumn("unit_price", F.when(F.col("order_id") == "o1", 2e9).otherwise(F.col("unit_price")))
    silver_tables, aside = silver.build_silver(bronze, ORDER_BY, NOW), {}
    star = gold.build_gold(spark, silver_tables, rejected=lambda name, df: aside.setdefault(name, df))
    assert "o1" in by_id(silver_tables["orders"], "order_id")
    assert set(by_id(aside["fact_orders"], "order_id")) == {"o1"} and "o1" not in by_id(star["fact_orders"], "order_id")


def test_the_gate_stops_before_gold(spark, bronze, tmp_path):
    with pytest.raises(QualityGateError, match="customers.uniqueness_email"):
        medallion.run_medallion(spark, bronze, str(tmp_path), ORDER_BY, NOW)
    assert not (tmp_path / "gold").exists()


def test_rows_that_go_take_only_their_keys_to_their_duplicates(spark):
    rows = [("a", 2, 1, "2030-01-01 00:00:00", "late"), ("a", 3, 1, "2024-01-01 00:00:00", "kept not, as the first one is late"), ("b", 1, 0, "soon", "none"),
            ("c", 1, None, None, "null"), ("d", 1, 2, "soon", "undated"), (None, 1, 4, None, "no id"), (None, 2, 4, None, "no id, second")]
    orders = spark.createDataFrame(rows, "order_id string, seq int, quantity int, order_date string, status string")
    orders = orders.selectExpr("*", "status AS payment_method", "1.0D AS unit_price", "0.0D AS discount_percent", "0.0D AS shipping_cost")
    kept = silver.silver_orders(orders, ["seq"], NOW)
    assert sorted((r["payment_method"], r["order_date"]) for r in kept.collect()) == [("no id", None), ("undated", None)]
    slim = {r["seq"]: r["status"] for r in silver._slimmed(orders.filter("order_id = 'a'"), ["order_id", "seq"], NOW).collect()}
    assert slim == {2: None, 3: "kept not, as the first one is late"}
    by_quantity = silver.silver_orders(orders, ["quantity"], NOW)
    assert {r["payment_method"] for r in by_quantity.collect()} <= {"undated", "no id", "no id, second", "kept not, as the first one is late"}
