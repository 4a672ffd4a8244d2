"""The key index, partitions that are switched, and writes that fail or have no rows."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import key_index
from tidemark.operators.key_index import KeyIndex
from tidemark.plans import gold, medallion, silver
from tidemark.quality.suites import SUITES
from tidemark.sinks import files, warehouse
from tidemark.sources import layers
from tests.conftest import NOW, ORDER_BY


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture
def index(spark, tmp_path):
    found = KeyIndex(spark, str(tmp_path / "index"), "id", "k", ("y", "m"), buckets=16)
    assert not found.exists()
    found.record(spark.range(1, 201).selectExpr("concat('o', id) AS id", "id AS k", "2024 AS y", "CAST(id % 12 AS INT) AS m"))
    return found


@pytest.mark.parametrize("limit", [None, 0])
def test_index_keeps_keys_and_numbers_new_ones(spark, index, limit):
    batch = spark.createDataFrame([("o7", 1), ("o11", 2), ("new1", 3), ("new2", 4)], "id string, v int")
    found = {r["id"]: r for r in index.keyed(batch, limit).collect()}
    assert index.exists() and index.last_key() == 200
    assert (found["o7"]["k"], found["o11"]["k"], found["o7"]["v"]) == (7, 11, 1)
    assert sorted((found["new1"]["k"], found["new2"]["k"])) == [201, 202] and found["new1"]["_places"] is None
    assert [tuple(p) for p in found["o7"]["_places"]] == [(2024, 7)]
    # A batch that fails after it recorded its ids: run again, it finds them; another one does not get their numbers.
    index.record(spark.createDataFrame([("new1", found["new1"]["k"], 2025, 1), ("o7", 7, 2025, 2)], "id string, k bigint, y int, m int"))
    again = {r["id"]: r for r in index.keyed(batch, limit).collect()}
    assert again["new1"]["k"] == found["new1"]["k"] and again["new2"]["k"] > index.last_key()
    assert sorted(tuple(p) for p in again["o7"]["_places"]) == [(2024, 7), (2025, 2)]


def test_a_batch_reads_its_buckets_alone(spark, index):
    batch = spark.createDataFrame([("o7",), ("o8",)], "id string")
    touched = {r[0] for r in batch.select(index._bucket()).collect()}
    plan = index.known(batch)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert all(str(b) in plan[plan.index("PartitionFilters") :] for b in touched) and len(touched) <= 2
    assert index.entries(sorted(touched)).count() < 100


@pytest.fixture
def table(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS switched")
    spark.sql(f"CREATE TABLE switched.t (id INT, v INT, created_at TIMESTAMP, p INT, q STRING) USING parquet PARTITIONED BY (p, q) LOCATION '{tmp_path}/t/version-0'")
    yield "switched.t", str(tmp_path)
    spark.sql("DROP DATABASE switched CASCADE")


SOURCE = "id int, v int, p int, q string"


def test_partitions_are_switched(spark, table):
    name, base = table

    def upsert(batch, old=None, now="2024-01-01"):
        old = None if old is None else spark.createDataFrame(old, "p int, q string")
        warehouse.upsert_table_partitions(spark.createDataFrame(batch, SOURCE), name, ["id"], ["p", "q"], base, old, now)
        return rows(spark.table(name).select("id", "v", "p", "q", F.year("created_at")), "id")

    assert upsert([(1, 1, 1, "a"), (2, 1, 1, "b c"), (3, 1, 2, None)]) == [(1, 1, 1, "a", 2024), (2, 1, 1, "b c", 2024), (3, 1, 2, None, 2024)]
    kept = glob.glob(f"{base}/t/version-*/p=1/q=a/*.parquet")
    assert upsert([(2, 5, 1, "b c"), (4, 1, 3, "z/=%")], now="2025-01-01") == [(1, 1, 1, "a", 2024), (2, 5, 1, "b c", 2024), (3, 1, 2, None, 2024), (4, 1, 3, "z/=%", 2025)]
    assert glob.glob(f"{base}/t/version-*/p=1/q=a/*.parquet") == kept  # an untouched partition stays where it is
    # 1 and 3 move: their old partitions lose the last row
    assert upsert([(1, 7, 3, "z/=%"), (3, 8, 1, "b c")], [(1, "a"), (2, None)]) == [
        (1, 7, 3, "z/=%", 2024), (2, 5, 1, "b c", 2024), (3, 8, 1, "b c", 2024), (4, 1, 3, "z/=%", 2025),
    ]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2 and not glob.glob(f"{base}/t/version-*/p=2/*/*.parquet")
    assert upsert([]) == upsert([], [(9, "x")]) and spark.table(name).count() == 4


def test_a_failing_write_leaves_the_table(spark, table):
    name, base = table
    good = spark.createDataFrame([(1, 1, 1, "a")], SOURCE)
    warehouse.upsert_table_partitions(good, name, ["id"], ["p", "q"], base)
    bad = spark.createDataFrame([(1, 2, 1, "a"), (2, 0, 1, "a")], SOURCE).withColumn("v", F.when(F.col("v") == 0, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        warehouse.upsert_table_partitions(bad, name, ["id"], ["p", "q"], base)
    assert rows(spark.table(name).select("id", "v"), "id") == [(1, 1)]
    with pytest.raises(Exception, match="broken"):
        files.write_layer({"t": bad}, base, "silver")
    files.write_layer({"t": good}, base, "silver")
    before = sorted(os.listdir(f"{base}/silver/t"))
    with pytest.raises(Exception, match="broken"):
        files.write_layer({"t": bad}, base, "silver")
    assert rows(layers.read_table(spark, f"{base}/silver/t").select("id"), "id") == [(1,)] and set(before) <= set(os.listdir(f"{base}/silver/t"))


def test_layers_go_on_with_no_rows(spark, tmp_path):
    store = files.layer_store(str(tmp_path), "silver")
    assert store("t", spark.range(5)).count() == 5
    assert store("t", spark.range(5).filter("id > 9")).count() == 0
    assert store("t", spark.range(5).filter(F.lit(False))).columns == ["id"]
    assert layers.read_table(spark, f"{tmp_path}/silver/t").count() == 5
    for n in (6, 7, 8):
        store("t", spark.range(n))
    assert layers.read_table(spark, f"{tmp_path}/silver/t").count() == 8 and len(os.listdir(f"{tmp_path}/silver/t")) <= 4


def test_plain_folders_keep_their_rows(spark, tmp_path):
    path, some = str(tmp_path / "x"), spark.range(5).selectExpr("id", "id % 2 AS p")
    for write, read in (
        (lambda df: files.write_partitioned(df, f"{path}/p", ["p"]), lambda: spark.read.parquet(f"{path}/p")),
        (lambda df: files.write_csv(df, f"{path}/c"), lambda: spark.read.option("header", True).csv(f"{path}/c")),
        (lambda df: files.write_json(df, f"{path}/j"), lambda: spark.read.json(f"{path}/j")),
    ):
        assert write(some) == 5 and read().count() == 5
        assert write(some.filter("id > 7")) == 0 and read().count() == 5
        assert write(some.filter("id > 2")) == 2 and read().count() == 2


def test_a_batch_of_known_customers(spark, bronze, tmp_path):
    """Orders of customers whom only the first batch had, and later runs without customers, products or any row."""
    suites = {"products": SUITES["products"]}
    base = bronze["orders"].filter("order_id = 'o1'").limit(1)
    order = lambda i, c: base.withColumns({"order_id": F.lit(i), "customer_id": F.lit(c)})
    bronze["orders"] = order("a", "c1").withColumn("order_date", F.lit("2023-06-01 10:00:00")).unionByName(order("n", "c1").withColumn("order_date", F.lit(None).cast("string")))

    def run(k, batch):
        medallion.run_medallion(spark, batch, str(tmp_path / str(k)), ORDER_BY, NOW, suites, "run_known", effective="2024-06-01")
        fact, customers = spark.table("run_known.fact_orders"), spark.table("run_known.dim_customer")
        return {r["order_id"]: (r["order_key"], r["customer_id"]) for r in fact.join(customers, "customer_key").collect()}

    first = run(0, bronze)
    assert {i: c for i, (_, c) in first.items()} == {"a": "c1", "n": "c1"}
    assert run(1, {"orders": bronze["orders"]}) == first  # delivered again: neither key changes
    second = run(2, {"customers": bronze["customers"].filter("customer_id = 'c2'"), "orders": order("d", "c1").unionByName(order("e", "c2")).unionByName(order("f", "nobody"))})
    assert {i: c for i, (_, c) in second.items()} == {"a": "c1", "n": "c1", "d": "c1", "e": "c2"}
    left_out = layers.read_table(spark, f"{tmp_path}/2/rejected/missing_parents").collect()
    assert [tuple(r) for r in left_out] == [("customer_id", "nobody", 1)]
    assert run(3, {name: df.filter(F.lit(False)) for name, df in bronze.items()}) == second
    assert run(4, {"customers": bronze["customers"]}) == second
    spark.sql("DROP DATABASE run_known CASCADE")


def test_later_batches_read_no_key_column_of_the_fact(spark, bronze, tmp_path, monkeypatch):
    """The plan of the batch's fact rows, keys and all, has no scan of the stored fact."""
    seen = {}
    keyed = key_index.KeyIndex.keyed
    monkeypatch.setattr(key_index.KeyIndex, "keyed", lambda self, df, limit=None: seen.setdefault("plan", keyed(self, df, limit)))
    cleaned = silver.build_silver(bronze, ORDER_BY, NOW)
    for _ in range(2):
        medallion.load_warehouse(spark, cleaned, str(tmp_path / "wh"), "run_plan", "2024-06-01", files.layer_store(str(tmp_path), "gold"), files.leave, NOW)
    read = seen["plan"].inputFiles()
    assert any("/order_index/rows/bucket=" in f for f in read) and not any("/fact_orders/" in f for f in read)
    assert spark.table("run_plan.fact_orders").count() == gold.build_gold(spark, cleaned)["fact_orders"].count()
    spark.sql("DROP DATABASE run_plan CASCADE")
