"""Steps that move ids instead of rows, and passes that are not repeated."""

import glob
import os
import time

from tests.conftest import NOW, ORDER_BY
from tidemark import session
from tidemark.operators import dedup, lookup, merge, nulls
from tidemark.operators.key_index import KeyIndex
from tidemark.plans import gold, medallion, silver
from tidemark.sinks import files, warehouse
from tidemark.sources import layers


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sizes_are_of_the_columns_read(spark, tmp_path):
    rows = spark.createDataFrame([(i, "a", "x" * 1000) for i in range(10)], "k int, id string, text string")
    files.write_layer({"t": rows}, str(tmp_path), "silver")
    table = layers.read_table(spark, f"{tmp_path}/silver/t")
    assert files.written_bytes(table.select("k")) == 10 * 16
    assert files.written_bytes(table.select("id")) == 10 * 16 + 10_000  # the longest text column
    assert files.written_bytes(table) == 10 * 48 + 10_010
    assert files.written_bytes(table.selectExpr("explode(sequence(1, 1000)) AS n")) is None


def test_unknown_keys_are_broadcast_instead_of_rows_shuffled(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c"), (4, "zz")], "n int, key string")
    reference = spark.createDataFrame([("a",), ("c",), (None,), *((f"r{i}",) for i in range(100))], "pk string")
    kept = lookup.validate_foreign_keys(facts, "key", reference, "pk", broadcast_bytes=500)
    assert sorted(r["n"] for r in kept.collect()) == [1, 3, 4]
    assert "_salt" not in _plan(kept) and "_orphan" in _plan(kept)


def test_missing_parents_are_used(spark):
    orders = spark.createDataFrame([("o1", "a", "p"), ("o2", "b", None), ("o3", None, "q"), ("o4", "a", "q")], "order_id string, customer_id string, product_id string")
    tables = {"customers": spark.createDataFrame([("a",)], "customer_id string"), "products": spark.createDataFrame([("p",)], "product_id string")}
    missing = silver.missing_parents(orders, tables)
    assert sorted(map(tuple, missing.collect())) == [("customer_id", "b", 1), ("product_id", "q", 2)]
    assert sorted(r["order_id"] for r in silver.valid_orders(orders, tables, missing=missing).collect()) == ["o1"]


def test_as_of_takes_the_version_of_the_day_from_a_line(spark):
    versions = spark.sql("SELECT id, key, CAST(day AS date) AS day FROM VALUES ('a', 1, '2024-01-01'), ('a', 2, '2024-03-01'), ('b', 3, '2024-02-01') AS t(id, key, day)")
    facts = spark.sql("SELECT n, id, CAST(at AS date) AS at FROM VALUES (1, 'a', '2023-01-01'), (2, 'a', '2024-02-29'), (3, 'a', '2024-03-01'), (4, 'a', NULL), (5, 'b', '2024-01-01'), (6, 'c', '2024-01-01'), (7, NULL, '2024-01-01') AS t(n, id, at)")
    for limit in (None, 0):
        found = lookup.as_of_lookup(facts, versions, "id", facts["at"], "id", "day", "key", broadcast_bytes=limit)
        assert {r["n"]: r["key"] for r in found.collect()} == {1: 1, 2: 1, 3: 2, 4: 2, 5: 3, 6: None, 7: None}
        assert "Window" not in _plan(found)


def test_medians_keep_what_they_read(spark, monkeypatch):
    seen, find = [], nulls._find
    monkeypatch.setattr(nulls, "_find", lambda df, *rest: (seen.append((df, df.storageLevel.useDisk)), find(df, *rest)))
    df = spark.range(101).selectExpr("CAST(id AS double) AS v", "id AS other")
    assert nulls.exact_medians(df, ["v"], 5) == {"v": 50.0}
    assert seen[0][1] and seen[0][0].columns == ["v"] and not seen[0][0].storageLevel.useDisk


def test_fact_is_written_once(spark, tmp_path):
    names, write = [], files.layer_store(str(tmp_path), "gold")

    def store(name, df):
        names.append(name)
        return write(name, df)

    fact = spark.sql(
        "SELECT id AS order_key, CAST(id AS string) AS order_id, id AS customer_key, id AS product_key, 20240101 AS date_key, 1 AS quantity, "
        "CAST(IF(id = 1, 1e12, 1) AS decimal(18,2)) AS unit_price, CAST(0 AS decimal(18,2)) AS discount_percent, CAST(0 AS decimal(18,2)) AS discount_amount, "
        "CAST(1 AS decimal(18,2)) AS total_amount, CAST(1 AS decimal(18,2)) AS net_amount, CAST(1 AS decimal(18,2)) AS shipping_cost, 'pix' AS payment_method, "
        "'completed' AS order_status FROM range(3)"
    )
    rejected = files.layer_store(str(tmp_path), "rejected")
    assert sorted(r["order_id"] for r in gold._fitting(fact, store, rejected).collect()) == ["0", "2"]
    assert [r["order_id"] for r in layers.read_table(spark, f"{tmp_path}/rejected/fact_orders").collect()] == ["1"]
    assert names == ["fact_orders"]


def test_no_sieve_for_a_batch_as_large_as_the_index(spark, tmp_path):
    index = KeyIndex(spark, f"{tmp_path}/index", "id", "key", ["month"])
    first = spark.sql("SELECT CAST(id AS string) AS id, id + 1 AS key, 1 AS month FROM range(20)")
    index.record(first)
    batch = spark.sql("SELECT CAST(id AS string) AS id, id AS load FROM range(10, 25)")
    assert "bitmap" not in _plan(index.known(batch, 0))
    found = {r["id"]: (r["key"], r["load"]) for r in index.keyed(batch, 0).collect()}
    assert {k: v[0] for k, v in found.items() if int(k) < 20} == {str(i): i + 1 for i in range(10, 20)}
    assert sorted(v[0] for k, v in found.items() if int(k) >= 20) == [21, 22, 23, 24, 25] and all(v[1] == int(k) for k, v in found.items())


def test_layers_are_written_with_small_tasks(spark, tmp_path):
    first = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before, parallel = spark.conf.getAll.get(session.TASK_BYTES), spark.conf.get(first)
    rows = spark.range(400_000).selectExpr("id % 300000 AS id", "concat(sha2(CAST(id AS string), 512), sha2(CAST(-id AS string), 512)) AS text")
    try:
        spark.conf.set(first, "false")
        kept = files.layer_store(str(tmp_path), "silver")("t", dedup.remove_duplicates(rows, ["id"], order_by=["text"]))
    finally:
        spark.conf.set(first, parallel)
    assert kept.count() == 300_000 and len(kept.inputFiles()) > 2  # 53 MB: one or two tasks by the default
    assert spark.conf.getAll.get(session.TASK_BYTES) == before


def test_a_session_that_asks_for_smaller_tasks_has_them(spark):
    before = spark.conf.getAll.get(session.TASK_BYTES)
    try:
        for asked, used in (("1m", 1 << 20), ("256m", session.LAYER_TASK_BYTES)):
            spark.conf.set(session.TASK_BYTES, asked)
            with session.small_tasks(spark):
                assert int(spark.conf.get(session.TASK_BYTES)) == used
            assert spark.conf.get(session.TASK_BYTES) == asked
    finally:
        spark.conf.unset(session.TASK_BYTES)
        if before is not None:
            spark.conf.set(session.TASK_BYTES, before)


def test_known_ids_are_measured_in_one_pass(spark, tmp_path, monkeypatch):
    index = KeyIndex(spark, str(tmp_path / "index"), "id", "key", ("part",))
    index.record(spark.range(100).selectExpr("CAST(id AS string) AS id", "id AS key", "id % 3 AS part"))
    passes, ids = [], spark.createDataFrame([("1",), ("99",), ("100",), ("1",), (None,)], "id string")
    count = type(ids).count
    monkeypatch.setattr(type(ids), "count", lambda df: passes.append(df.columns) or count(df))
    found = KeyIndex(spark, str(tmp_path / "index"), "id", "key", ("part",), buckets=3).known(ids, broadcast_bytes=0)
    assert passes == [index.entries().columns] and sorted((r["id"], r["key"]) for r in found.collect()) == [("1", 1), ("99", 99)]


def test_reference_beyond_the_driver_is_not_broadcast(spark):
    reference = spark.range(600_000).selectExpr("id AS pk", "id * 2 AS value")  # 19 MB as measured, some 70 MB as a hash table
    facts = spark.createDataFrame([(1, 7), (2, None), (3, -1)], "n int, key bigint")
    found = lookup.left_lookup(facts, reference, "key", "pk", spread_by=["n"])
    assert "_salt" in _plan(found)
    assert {r["n"]: r["value"] for r in found.collect()} == {1: 14, 2: None, 3: None}


def test_missing_parents_are_found_once_for_stored_layers(spark, bronze, tmp_path, monkeypatch):
    write, names = files.layer_store(str(tmp_path), "silver"), []

    def store(name, df):
        names.append(name)
        return write(name, df)

    rows = {}
    for limit in (lookup.BROADCAST_BYTES, 30):  # 30 bytes: one unknown id, neither all customers nor all products
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", limit)
        kept = silver.build_silver(bronze, ORDER_BY, NOW, store=store)["orders"]
        rows[limit] = sorted(map(str, kept.collect()))
    assert len(set(map(tuple, rows.values()))) == 1 and rows[30]
    assert names == ["customers", "products", "orders", "customers", "products", "missing_parents", "orders"]


def _shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for f in glob.glob(f"{folder}/*/shuffle_*")}


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    rows = spark.range(200_000).selectExpr("id % 150000 AS id", "id AS v", "CAST(id % 3 AS int) AS p")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS unshuffled LOCATION '{tmp_path}/db'")
    spark.sql(f"CREATE TABLE unshuffled.t (id BIGINT, v BIGINT, p INT) USING parquet PARTITIONED BY (p) LOCATION '{tmp_path}/db/t/version-0'")
    first = dedup.remove_duplicates(rows, ["id"], order_by=["v"])
    writes = (
        lambda: files.write_layer({"t": first}, str(tmp_path), "silver"),
        lambda: warehouse.load_table(first, "unshuffled.whole", str(tmp_path), "replace"),
        lambda: warehouse.upsert_table_partitions(layers.read_table(spark, f"{tmp_path}/silver/t"), "unshuffled.t", ["id"], ["p"], str(tmp_path)),
        lambda: warehouse.upsert_table_partitions(layers.read_table(spark, f"{tmp_path}/silver/t"), "unshuffled.t", ["id"], ["p"], str(tmp_path)),
        lambda: KeyIndex(spark, f"{tmp_path}/index", "id", "v", ("p",)).record(layers.read_table(spark, f"{tmp_path}/silver/t")),
    )
    for k, write in enumerate(writes):
        before = _shuffle_files(spark)
        write()
        for _ in range(50):
            left = {f for f in _shuffle_files(spark) - before if os.path.getsize(f) > 10_000}  # not those of small collects
            if not left:
                break
            time.sleep(0.2)
        assert not left, k
    assert spark.table("unshuffled.t").count() == 150_000
    spark.sql("DROP DATABASE unshuffled CASCADE")


def test_touched_rows_are_not_shuffled(spark, tmp_path):
    path, key = str(tmp_path / "out"), "spark.sql.autoBroadcastJoinThreshold"
    files.write_partitioned(spark.sql("SELECT id, IF(id % 10 = 9, NULL, id % 10) AS p FROM range(100)"), path, ["p"])
    source = spark.createDataFrame([(3, 3), (9, None)], "id bigint, p bigint")
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        touched = warehouse.touched_rows(spark.read.parquet(path), source, ["p"])
        assert "SortMergeJoin" not in _plan(touched) and sorted(r["id"] for r in touched.collect()) == sorted([*range(3, 100, 10), *range(9, 100, 10)])
    finally:
        spark.conf.set(key, before)


def test_replaced_rows_are_not_shuffled(spark):
    target = spark.createDataFrame([(1, "x", 1), (1, "x", 2), (2, "x", 3), (2, None, 4), (None, "x", 5), (3, "x", 6), (4, "x", 7)], "a int, b string, v int")
    source = spark.createDataFrame([(2, "x", 9), (2, None, 9), (None, "x", 9), (3, "x", 9), (5, "x", 9)], "a int, b string, v int")
    for limit, shuffled in ((None, False), (0, True)):
        stay = merge.untouched_rows(target, source, ["a", "b"], limit)
        assert sorted(r["v"] for r in stay.collect()) == [1, 2, 4, 5, 7] and stay.columns == ["a", "b", "v"]
        assert ("_stays" in _plan(stay)) != shuffled
        assert sorted(map(str, merge.upsert_rows(target, source, ["a", "b"], stay).collect())) == sorted(map(str, merge.upsert_rows(target, source, ["a", "b"]).collect()))


def test_a_later_batch_leaves_no_tables_of_its_steps(spark, bronze, tmp_path):
    for k in range(2):
        medallion.run_medallion(spark, bronze, str(tmp_path / str(k)), ORDER_BY, NOW, {}, "run_steps", effective="2024-06-01")
    assert spark.table("run_steps.fact_orders").count() == layers.read_table(spark, f"{tmp_path}/1/silver/orders").count() > 0
    assert "fact_orders" in os.listdir(f"{tmp_path}/1/gold") and "orders_keyed" not in os.listdir(f"{tmp_path}/1/gold")
    spark.sql("DROP DATABASE run_steps CASCADE")
