"""Suites over batches: the same results as over the whole table, from states."""

import pytest
from pyspark.sql import functions as F

from tidemark.quality.checks import run_suite
from tidemark.quality.history import SuiteHistory

SUITE = {
    "table_name": "t",
    "checks": {
        "completeness": {"columns": ["id", "v"], "threshold": 0.5},
        "uniqueness": {"columns": ["id", "code"]},
        "ranges": {"v": [0, 10]},
        "allowed_values": {"kind": ["a", "b"]},
        "freshness": {"column": "day", "max_age_hours": 24},
    },
}
ROWS = [
    (1, 5.0, "a", "2024-01-01 00:00:00", "x"), (2, 50.0, "z9", "2024-01-02 00:00:00", "y"), (3, None, None, None, None),
    (4, -1.0, "z1", "2024-02-01 00:00:00", "x"), (4, float("nan"), "b", "2024-02-02 00:00:00", "w"), (None, 1.0, "z2", "2024-02-02 00:00:00", None),
    (5, 2.0, "z3", "2024-03-01 00:00:00", "w"), (1, 3.0, "z4", "2024-01-09 00:00:00", "v"), (6, 4.0, "z5", "2024-03-03 00:00:00", "u"),
]


def test_three_batches_equal_the_whole(spark, tmp_path):
    table = spark.createDataFrame(ROWS, "id int, v double, kind string, day string, code string").withColumn("day", F.col("day").cast("timestamp"))
    batches = [spark.createDataFrame(table.collect()[k : k + 3], table.schema) for k in (0, 3, 6)]
    kept = SuiteHistory(spark, str(tmp_path / "states"), SUITE, F.date_format("day", "yyyy-MM"))
    for number, batch in enumerate(batches):
        kept.add(batch, number)
    kept.add(batches[2], 2)  # again, as after a failure
    now = "2024-03-04 00:00:00"
    want = {r["check_name"]: r.asDict() for r in run_suite(table, SUITE, now).collect()}
    got = {r["check_name"]: r.asDict() for r in kept.results(batches[0], now).collect()}
    assert got == want and want["uniqueness_id"]["violations"] == 2 and want["allowed_values_kind"]["sample"] == ["z1", "z2", "z3", "z4", "z5"]
    files = kept.results(batches[0], now).inputFiles()
    assert files and all("/states/" in f and "/rows/" not in f for f in files)


@pytest.mark.parametrize("checks", [{}, {"completeness": {"columns": ["absent", "v"]}}])
def test_suites_without_uniqueness(spark, tmp_path, checks):
    table = spark.createDataFrame([(1, 2.0)], "id int, v double")
    suite = {"table_name": "t", "checks": checks}
    kept = SuiteHistory(spark, str(tmp_path / "states"), suite, F.lit("all"))
    kept.add(table, 0)
    now = "2024-01-01 00:00:00"
    assert kept.results(table, now).collect() == run_suite(table, suite, now).collect()


def test_small_states_are_written_by_spark_alone(spark, tmp_path, monkeypatch):
    table = spark.createDataFrame(ROWS, "id int, v double, kind string, day string, code string").withColumn("day", F.col("day").cast("timestamp")).localCheckpoint()
    kept = SuiteHistory(spark, str(tmp_path / "states"), SUITE, F.date_format("day", "yyyy-MM"))
    made = []
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: made.append(a))
    kept.add(table.filter("id < 4"), 0)
    kept.add(table.filter("id >= 4 OR id IS NULL"), 1)
    assert not made and kept._values("id").last_key() == 1
    counted = spark.read.parquet(f"{kept.path}/unique").groupBy("column_name").agg(F.sum("total_rows"), F.sum("filled"), F.sum("different"))
    assert sorted(map(tuple, counted.collect())) == [("code", 9, 7, 5), ("id", 9, 8, 6)]
