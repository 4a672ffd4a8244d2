import json

import pytest

from tidemark import schemas
from tidemark.quality import audits, checks, profile, report
from tidemark.quality.suites import SUITES, load_suite


def only(results):
    (row,) = results.collect()
    return row


def test_completeness(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (float("nan"),), (4.0,)], "col1 double")
    four = df.filter("col1 is null or not isnan(col1)")
    assert only(checks.check_completeness(four, "t", ["col1"], 0.70))["passed"]
    failed = only(checks.check_completeness(four, "t", ["col1"], 0.80))
    assert (failed["passed"], failed["violations"], failed["actual"], failed["threshold"]) == (False, 1, 75.0, 80.0)
    assert only(checks.check_completeness(df, "t", ["col1"]))["violations"] == 2
    absent = only(checks.check_completeness(df, "t", ["nope"]))
    assert (absent["check_name"], absent["passed"], absent["error"]) == ("completeness", False, "no such column")


def test_uniqueness(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,), (None,)], "id int")
    row = only(checks.check_uniqueness(df, "t", ["id"]))
    assert (row["passed"], row["violations"], row["checked_rows"], row["actual"]) == (False, 1, 4, 25.0)
    assert only(checks.check_uniqueness(df.distinct(), "t", ["id"]))["passed"]
    assert only(checks.check_uniqueness(df.filter("id is null"), "t", ["id"]))["passed"]


def test_ranges(spark):
    df = spark.createDataFrame([(18.0,), (25.0,), (99.0,), (120.0,), (None,), (float("nan"),)], "age double")
    row = only(checks.check_value_ranges(df, "t", {"age": (10, 100), "nope": (0, 1)}))
    assert (row["passed"], row["violations"], row["actual_min"], row["actual_max"]) == (False, 1, 18.0, 120.0)
    assert only(checks.check_value_ranges(df, "t", {"age": (18, 120)}))["passed"]


def test_allowed_values(spark):
    df = spark.createDataFrame([(v,) for v in "aabgfedcba"] + [(None,)], "v string")
    row = only(checks.check_allowed_values(df, "t", {"v": ["a", "b"], "nope": []}))
    assert (row["passed"], row["violations"], row["sample"]) == (False, 5, ["c", "d", "e", "f", "g"])
    assert only(checks.check_allowed_values(df, "t", {"v": list("abcdefg")}))["sample"] == []


def test_freshness(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-02 00:00:00",)], "t string")
    assert only(checks.check_freshness(df, "t", "t", 24, "2024-01-03 00:00:00"))["passed"]
    stale = only(checks.check_freshness(df, "t", "t", 24, "2024-01-03 00:36:00"))
    assert (stale["passed"], stale["actual"]) == (False, 24.6)
    assert not only(checks.check_freshness(df.limit(0), "t", "t"))["passed"]
    assert not only(checks.check_freshness(df, "t", "nope"))["passed"]


def test_an_empty_table_gives_no_results(spark):
    empty = spark.createDataFrame([], "order_id string, quantity int, status string")
    assert checks.run_suite(empty, SUITES["orders"]).filter("error is null").isEmpty()


def test_min_date_rule(spark):
    df = spark.createDataFrame([("2019-12-31 10:00:00",), ("2020-01-01 00:00:00",), (None,)], "order_date string")
    row = only(checks.check_min_date(df.selectExpr("cast(order_date as timestamp) as order_date"), "orders", "order_date", "2020-01-01"))
    assert (row["passed"], row["violations"]) == (False, 1)


def test_suite_from_a_file(spark, tmp_path):
    path = tmp_path / "people_expectations.json"
    path.write_text(json.dumps({"checks": {
        "completeness": {"columns": ["id"]}, "uniqueness": {"columns": ["id"]}, "ranges": {"n": [0, 5]},
        "allowed_values": {"s": ["x"]}, "freshness": {"column": "t", "max_age_hours": 1},
    }}))
    df = spark.createDataFrame([(1, 3, "x", "2024-01-01")], "id int, n int, s string, t string")
    results = checks.run_suite(df, load_suite(spark, str(path)), now="2024-01-01 00:30:00").collect()
    assert [r["check_name"] for r in results] == ["completeness_id", "uniqueness_id", "range_n", "allowed_values_s", "freshness"]
    assert all(r["passed"] and r["table_name"] == "people" for r in results)


@pytest.fixture
def results(spark):
    rows = [("uniqueness_sku", "products", True), ("completeness_paid", "orders", False), ("range_x", "orders", False),
            ("uniqueness_order_id", "orders", False)]
    return spark.createDataFrame(rows, "check_name string, table_name string, passed boolean").selectExpr(
        "*", "1 AS violations", "0.5 AS actual", "array('a') AS sample")


def test_report(results):
    rates = {r["table_name"]: (r["total_checks"], r["failed_checks"], r["pass_rate"]) for r in report.dq_report(results).collect()}
    assert rates == {"products": (1, 0, 100.0), "orders": (3, 3, 0.0), "ALL": (4, 3, 25.0)}
    assert "4 checks, 1 passed (25.0%)" in report.report_text(results)
    assert "0 checks" in report.report_text(results.limit(0))


def test_gate(results):
    with pytest.raises(report.QualityGateError, match="orders.completeness_paid, orders.uniqueness_order_id"):
        report.dq_gate(results)
    report.dq_gate(results.filter("check_name = 'range_x' or passed"))


def test_row_contracts(spark):
    products = spark.createDataFrame(
        [(1, "p" * 37, "n", "c", "s", 0.0, 1.0, "Budget", 1.0, None, 5.5), (2, "p", None, "c", "s", 1.0, 1.0, "Budget", 1.0, "x", None)],
        "product_key int, product_id string, name string, category string, subcategory string, price double, "
        "cost_price double, price_range string, margin_percent double, supplier string, rating double",
    )
    broken = audits.row_contract_audit(products, "dim_product").filter("violations > 0").collect()
    assert {r["rule"] for r in broken} == {"product_id max_length", "name required", "price above", "rating at_most"}
    flagged = audits.flag_violations(products, schemas.CONTRACTS["dim_product"]).orderBy("product_key").collect()
    assert [r["violations"] for r in flagged] == [["product_id max_length", "price above", "rating at_most"], ["name required"]]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (3, None)], "n int, s string")
    assert [tuple(r) for r in profile.null_counts(df).collect()] == [("n", 2, 1), ("s", 2, 1)]
    assert profile.distinct_count(df, "s").first()[0] == 1
    assert tuple(profile.min_max(df, ["n"]).first()) == ("n", 1.0, 3.0)
    assert profile.latest_timestamp(df, "n").first()[0] == 3


def test_monitor(spark):
    tables = {"a": spark.range(3), "b": spark.range(0)}
    assert {tuple(r) for r in audits.warehouse_monitor(tables).collect()} == {("a", 3, False, None), ("b", 0, True, None)}
    with pytest.raises(ValueError, match="b"):
        audits.require_filled(tables)


def test_distinct_numbers(spark):
    keys = [(k,) for k in (-1, 1, 2, 2, 32768, 32769, 10**9, None, None)]
    assert tuple(audits.distinct_numbers(spark.createDataFrame(keys, "k bigint"), "k").first()) == (9, 7, 6)
    assert tuple(audits.distinct_numbers(spark.createDataFrame([], "k bigint"), "k").first()) == (0, 0, 0)
