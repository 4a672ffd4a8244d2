import glob
import json
import os
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark import session
from tidemark.schemas import CATALOG_PRODUCT, table_schema
from tidemark.sinks import files, warehouse
from tidemark.sources import catalog, delimited, layers

PAIR = table_schema(id="integer", val="string")


def test_csv_with_semicolons(spark, tmp_path):
    path = tmp_path / "test.csv"
    path.write_text("id;val\n1;a\n2;b\n")
    df = delimited.read_csv(spark, str(path), PAIR, expected_columns=["id", "val"])
    assert [r["val"] for r in df.orderBy("id").collect()] == ["a", "b"]
    inferred = delimited.read_csv(spark, str(path))
    assert inferred.dtypes == [("id", "int"), ("val", "string")]


def test_missing_csv_raises_and_missing_columns_warn(spark, tmp_path, caplog):
    with pytest.raises(AnalysisException):
        delimited.read_csv(spark, str(tmp_path / "none.csv"), PAIR)
    path = tmp_path / "one.csv"
    path.write_text("id,val\n1,a\n")
    delimited.read_csv(spark, str(path), PAIR, expected_columns=["id", "price"])
    assert "price" in caplog.text


@pytest.mark.parametrize(
    "content, encoding, delimiter",
    [
        ("a;b\n1;é\n".encode("latin-1"), "ISO-8859-1", ";"),
        ("a\tb\n1\té\n".encode(), "UTF-8", "\t"),
        ('"x;y",b\n1,2\n'.encode(), "UTF-8", ","),
        ("single\n1\n".encode(), "UTF-8", ","),
        ("a,b\n".encode() + b"1,2\n" * 20_000 + "3,ção\n".encode("latin-1"), "ISO-8859-1", ","),
    ],
)
def test_dialects(spark, tmp_path, content, encoding, delimiter):
    (tmp_path / "f.csv").write_bytes(content)
    row = delimited.sniff_csv_dialect(spark, str(tmp_path)).first()
    assert (row["encoding"], row["delimiter"], row["lines"]) == (encoding, delimiter, content.count(b"\n"))


def test_directory_of_mixed_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;val\n1;x\nbad;y;z;w\n")
    (tmp_path / "b.csv").write_bytes("id,val\n3,é\n".encode("latin-1"))
    (tmp_path / "skip.txt").write_text("no")
    df = delimited.read_csv_directory(spark, str(tmp_path), PAIR)
    good = df.filter("_corrupt_record is null").select("id", "val", "source_file").orderBy("id").collect()
    assert [tuple(r) for r in good] == [(1, "x", "a.csv"), (3, "é", "b.csv")]
    assert df.filter("_corrupt_record is not null").first()["_corrupt_record"] == "bad;y;z;w"
    tables = delimited.read_csv_tables(spark, str(tmp_path), {"a": PAIR, "b": PAIR, "c": PAIR})
    assert set(tables) == {"a", "b"}
    with pytest.raises(ValueError):
        delimited.read_csv(spark, str(tmp_path), PAIR, pattern="*.csv")


def test_file_of_ascii_goes_with_the_others(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;val\n")
    (tmp_path / "b.csv").write_bytes("id;val\n1;\x80é\n".encode("latin-1"))
    (tmp_path / "c.csv").write_text("id;val\n2;x\n")
    found = delimited.sniff_csv_dialect(spark, str(tmp_path)).select("encoding", "delimiter").distinct().collect()
    assert [tuple(r) for r in found] == [("ISO-8859-1", ";")]
    assert sorted(r["id"] for r in delimited.read_csv(spark, str(tmp_path), PAIR).collect()) == [1, 2]
    (tmp_path / "d.csv").write_text("id;val\n3;é\n", encoding="utf-8")
    assert {r["encoding"] for r in delimited.sniff_csv_dialect(spark, str(tmp_path)).collect()} == {"UTF-8", "ISO-8859-1"}
    with pytest.raises(ValueError):
        delimited.read_csv(spark, str(tmp_path), PAIR)


def test_csv_values_survive(spark, tmp_path):
    df = spark.createDataFrame([(1, '  say "hi", x '), (2, None), (3, "back\\slash")], PAIR)
    files.write_csv(df, str(tmp_path / "out"))
    back = delimited.read_csv(spark, str(tmp_path / "out"), PAIR, delimiter=",", encoding="UTF-8")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_schema_check_and_profile(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], PAIR)
    assert tuple(delimited.schema_check(df, ["id", "nope"]).first()) == (False, ["nope"], 1)
    assert tuple(delimited.schema_check(df, ["id"]).first()) == (True, [], 1)
    df.coalesce(1).write.parquet(str(tmp_path / "p"))
    row = delimited.file_profile(spark.read.parquet(str(tmp_path / "p"))).first()
    assert row["row_count"] == 1 and row["size_bytes"] > 0 and row["data_types"] == "id int, val string"


def test_product_catalog(spark, tmp_path):
    products = [
        {"id": 1, "title": "Product 1", "price": 10.0, "rating": {"rate": 4.5, "count": 10}},
        {"id": 2, "title": "Product 2", "price": 20.0, "rating": {"rate": 3.8, "count": 5}},
    ]
    (tmp_path / "p.json").write_text(json.dumps(products))
    schema = table_schema(**{f.name: f.dataType for f in CATALOG_PRODUCT.fields if f.name not in ("category", "image")})
    rows = catalog.read_product_catalog(spark, str(tmp_path / "p.json"), schema, multiline=True, now="2024-01-01").orderBy("product_id").collect()
    assert [r["rating"] for r in rows] == [4.5, 3.8]
    first = rows[0].asDict()
    assert str(first.pop("cost_price")) == "6.50"
    assert first == {
        "product_id": "1", "name": "Product 1", "price": 10.0, "description": None, "rating": 4.5, "category": "Uncategorized",
        "stock_quantity": 150, "subcategory": "Uncategorized", "supplier": "FakeStoreAPI", "sku": "API-PRD-1",
        "created_at": "2024-01-01 00:00:00",
    }


def test_categories_and_users(spark):
    df = spark.createDataFrame([('["a","b"]',), ("oops",), (None,)], "v string")
    assert [r[0] for r in catalog.categories(df, "v").collect()] == ["a", "b"]
    users = spark.createDataFrame([('{"id": 1, "address": {"city": "x", "geolocation": {"lat": "1"}}}',)], "v string")
    assert catalog.users(users, "v").first()["address"]["geolocation"]["lat"] == "1"


def test_bronze_products_keep_a_plain_rating(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"product_id": "1", "rating": 4.0}\n')
    assert catalog.read_bronze_products(spark, str(tmp_path / "p.json"), "unused").first()["rating"] == 4.0


def test_object_store(spark, tmp_path):
    df = spark.range(5)
    assert files.write_object_store(df, str(tmp_path / "a"))
    assert files.write_object_store(df, str(tmp_path / "b"), "CSV")
    assert not files.write_object_store(df, str(tmp_path / "c"), "xlsx")
    assert not files.write_object_store(df.limit(0), str(tmp_path / "d"))
    assert not files.verify_write(spark, str(tmp_path / "a"), 6)
    assert files.publish_layer({"n": df}, str(tmp_path), "gold") == {"n": True}
    listed = files.list_dataset_files(spark, str(tmp_path / "gold"), "*.parquet").collect()
    assert all(r["size_bytes"] > 0 for r in listed) and "/gold/n/" in listed[0]["path"]


def test_partitions_keep_rows_without_a_value(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1), (2, None, 1), (3, "a", 2)], "id int, p string, q int")
    files.write_partitioned(df, str(tmp_path / "out"), ["p", "q"])
    assert sorted(os.listdir(tmp_path / "out" / "p=a")) == ["q=1", "q=2"]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, None, 1)], "id int, p string, n int")
    files.write_partitioned(df, path, ["p"])
    untouched = glob.glob(f"{path}/p=a/*.parquet")
    source = spark.createDataFrame([(2, "b", 7), (3, None, 8), (4, "c", 9)], "id int, p string, n int")
    warehouse.upsert_partitions(source, path, ["id"], ["p"])
    assert glob.glob(f"{path}/p=a/*.parquet") == untouched
    back = spark.read.parquet(path).select("id", "p", "n").orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, "a", 1), (2, "b", 7), (3, None, 8), (4, "c", 9)]
    with pytest.raises(ValueError, match="move"):
        warehouse.upsert_partitions(source.withColumn("p", F.lit("z")), path, ["id"], ["p"], check_moves=True)
    with pytest.raises(ValueError, match="repeats"):
        warehouse.upsert_partitions(source.union(source), path, ["id"], ["p"])


def test_warehouse_tables(spark, tmp_path):
    base = str(tmp_path / "wh")
    names = warehouse.create_star_schema(spark, "gold_test", base)
    assert names == warehouse.create_star_schema(spark, "gold_test", base)
    assert warehouse.table_row_count(spark, "gold_test.dim_date") == 0
    day = spark.createDataFrame([(20240101, 2024)], "date_key int, year int")
    for c in spark.table("gold_test.dim_date").schema.fields:
        if c.name not in day.columns:
            day = day.withColumn(c.name, F.lit(None).cast(c.dataType))
    day = warehouse.conformed(day, "dim_date")
    warehouse.load_table(day, "gold_test.dim_date", base)
    warehouse.load_table(day, "gold_test.dim_date", base)
    assert warehouse.table_row_count(spark, "gold_test.dim_date") == 2
    warehouse.load_table(day, "gold_test.dim_date", base, "replace")
    assert warehouse.table_row_count(spark, "gold_test.dim_date") == 1
    with pytest.raises(ValueError):
        warehouse.load_table(day, "gold_test.dim_date", base, "fail")
    query = "SELECT year FROM gold_test.dim_date WHERE date_key = :key"
    assert layers.sql_query(spark, query, {"key": 20240101}).first()[0] == 2024
    later = day.withColumn("year", F.lit(2025)).unionByName(day.withColumn("date_key", F.lit(20240102)))
    warehouse.upsert_table(later, "gold_test.dim_date", ["date_key"], base)
    rows = spark.table("gold_test.dim_date").orderBy("date_key").select("date_key", "year").collect()
    assert [tuple(r) for r in rows] == [(20240101, 2025), (20240102, 2024)]
    assert warehouse.table_row_count(spark, "gold_test.nope") == -1
    assert layers.source_health(spark.table("gold_test.dim_date"))


def test_upsert_prunes_the_target(spark, tmp_path):
    path = str(tmp_path / "out")
    files.write_partitioned(spark.range(100).selectExpr("id", "id % 10 AS p"), path, ["p"])
    source = spark.createDataFrame([(3, 3)], "id bigint, p bigint")
    plan = warehouse.touched_rows(spark.read.parquet(path), source, ["p"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*\(p#\d+ = 3\)", plan)


def test_an_empty_table_keeps_the_filled_one(spark, tmp_path):
    base = str(tmp_path)
    assert files.write_layer({"t": spark.range(5)}, base, "gold") == {"t": 5}
    assert files.write_layer({"t": spark.range(0)}, base, "gold") == {"t": 0}
    table = layers.read_layer(spark, base, "gold", ["t"])["t"]
    assert table.count() == 5 and os.listdir(f"{base}/gold") == ["t"]
    assert len([f for f in os.listdir(f"{base}/gold/t") if f.startswith("version-")]) == 1
    assert files.write_layer({"new": spark.range(0)}, base, "gold") == {"new": 0}
    assert layers.read_table(spark, f"{base}/gold/new").columns == ["id"]
    assert files.written_bytes(table.filter("id > 1")) == 5 * 16


def test_csv_columns_go_by_name(spark, tmp_path, caplog):
    schema = table_schema(id="integer", name="string", phone="string")
    (tmp_path / "a.csv").write_text("city,name,id\nRio,ana,1\n")
    row = delimited.read_csv(spark, str(tmp_path / "a.csv"), schema, expected_columns=["id", "phone"]).first()
    assert tuple(row) == (1, "ana", None) and "phone" in caplog.text
    (tmp_path / "b.csv").write_text("id,name\n2,bo\n")
    both = delimited.read_csv_directory(spark, str(tmp_path), schema).orderBy("id").collect()
    assert [(r["id"], r["name"], r["_corrupt_record"], r["source_file"]) for r in both] == [(1, "ana", None, "a.csv"), (2, "bo", None, "b.csv")]


def test_scratch_is_where_the_session_says(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    path = session.scratch_path(spark, "x")
    assert path.startswith(folder.rstrip("/") if folder else "/")
    assert path != session.scratch_path(spark, "x")


def test_one_broken_file_among_three(spark, tmp_path):
    (tmp_path / "a [1].csv").write_text("id,name\n1,x\n2,y\n")
    (tmp_path / "b.csv").write_text("id,name\n")
    (tmp_path / "c.csv.gz").write_bytes(b"no gzip at all")
    listed = files.list_dataset_files(spark, str(tmp_path))
    found = delimited.profile_files(listed, lambda reader, paths: reader.option("header", True).schema("id int, name string").csv(paths))
    assert {r["file_name"]: (r["row_count"], r["column_count"]) for r in found.collect()} == {"a [1].csv": (2, 2), "b.csv": (0, 2), "c.csv.gz": (-1, 2)}


def test_a_directory_is_read_once_by_each_header(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}, {{a}} b%20.csv").write_text(f"id,name\n{k},x\n")
        (tmp_path / f"{k}-other.csv").write_text(f"name;id\ny;{k}\n")
    df = delimited.read_csv_directory(spark, str(tmp_path), table_schema(id="integer", name="string"))
    assert sorted((r["id"], r["name"]) for r in df.collect()) == [(k, c) for k in range(3) for c in "xy"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") + plan.count("Scan csv") in (2, 4) and "Join" not in plan and plan.count("InMemoryFileIndex(3 paths)") >= 2
