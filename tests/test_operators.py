import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup, filters, keys, lookup, merge, nulls, sieve


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_remove_future_dates(spark):
    df = spark.createDataFrame([("2024-05-15",), ("2024-06-15",), ("2024-05-30",), (None,), ("soon",)], "date string")
    kept = filters.remove_future_dates(df, "date", "2024-06-01")
    assert kept.count() == 4
    assert kept.filter("date > '2024-06-01'").isEmpty()
    assert filters.remove_future_dates(df, "absent").count() == 5


def test_priced_products(spark):
    some = spark.createDataFrame([(1.0,), (-1.0,), (0.0,), (None,)], "price double")
    assert [r[0] for r in filters.priced_products(some).collect()] == [1.0]
    none = some.filter("price is null or price <= 0")
    assert filters.priced_products(none).count() == 3


@pytest.fixture
def letters(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "e"), (None, "f")], "id int, val string")


def test_dedup_keeps_the_first(letters):
    assert rows(dedup.remove_duplicates(letters, ["id"], order_by=["val"]).select("val"), "val") == [("a",), ("b",), ("d",), ("e",)]


def test_dedup_keeps_the_last(letters):
    last = dedup.remove_duplicates(letters, ["id"], "last", ["val"])
    assert rows(last.select("val"), "val") == [("a",), ("c",), ("d",), ("f",)]


def test_dedup_keeps_none(letters):
    assert rows(dedup.remove_duplicates(letters, ["id"], False), "val") == [(1, "a"), (3, "d")]


def test_dedup_is_idempotent(letters):
    once = dedup.remove_duplicates(letters, ["id"], order_by=["val"])
    assert rows(dedup.remove_duplicates(once, ["id"], order_by=["val"]), "val") == rows(once, "val")


def test_dedup_whole_rows_and_bad_arguments(letters):
    assert dedup.remove_duplicates(letters.union(letters)).count() == 6
    assert dedup.remove_duplicates(letters.union(letters), keep=False).count() == 0
    with pytest.raises(ValueError):
        dedup.remove_duplicates(letters, ["id"])
    with pytest.raises(ValueError):
        dedup.remove_duplicates(letters, ["id"], "middle", ["val"])


def test_dedup_reduces_a_hot_key_before_the_shuffle(spark, letters):
    plan = plan_of(dedup.remove_duplicates(letters, ["id"], order_by=["val"]))
    partial, exchange = plan.index("Partial", plan.index("WindowGroupLimit")), plan.index("Exchange")
    assert plan.index("Final") < exchange < partial  # printed from the result down to the scan


def plan_of(df):
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_handle_nulls(spark):
    df = spark.createDataFrame(
        [(1.0, "a", None, 1), (None, None, True, 1), (3.0, "c", None, None), (8.0, "c", False, 2)],
        "x double, s string, b boolean, n int",
    )
    filled = nulls.handle_nulls(
        df, {"x": "fill_median", "s": "fill_value:missing", "b": "fill_value:YES", "n": "fill_mode", "absent": "drop"}
    )
    assert rows(filled, "x") == [
        (1.0, "a", True, 1), (3.0, "missing", True, 1), (3.0, "c", True, 1), (8.0, "c", False, 2),
    ]
    assert nulls.handle_nulls(df, {"x": "fill_mean"}).agg(F.sum("x")).first()[0] == 16.0
    assert nulls.handle_nulls(df, {"x": "drop"}).count() == 3
    assert rows(nulls.handle_nulls(df, {"n": "fill_value:7"}).select("n"), "n") == [(1,), (1,), (2,), (7,)]


def test_fills_without_any_value_change_nothing(spark):
    df = spark.createDataFrame([(None, None)], "x double, s string")
    filled = nulls.handle_nulls(df, {"x": "fill_median", "s": "fill_mode"})
    assert rows(filled, "x") == [(None, None)]


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",), (None,), (None,), (None,)], "s string")
    assert nulls.smallest_mode(df, "s").first()[0] == "a"


@pytest.mark.parametrize("kind", ["uniform", "skewed", "constant", "two", "ties_at_the_middle"])
@pytest.mark.parametrize("size", [1, 2, 9_999, 10_000])
def test_exact_median_by_brackets(spark, kind, size):
    source = random.Random(size)
    pick = {
        "uniform": lambda: source.uniform(-5, 5),
        "skewed": lambda: 0.0 if source.random() < 0.34 else source.expovariate(0.001),
        "constant": lambda: 4.0,
        "two": lambda: source.choice([1.0, 2.0]),
        "ties_at_the_middle": lambda: source.choice([1.0, 2.0, 2.0, 3.0, source.random() * 4]),
    }[kind]
    numbers = [pick() for _ in range(size)]
    df = spark.createDataFrame([(n,) for n in numbers] + [(None,)], "v double")
    assert nulls.exact_median(df, "v", finish_rows=20) == pytest.approx(statistics.median(numbers), rel=1e-12)


@pytest.fixture
def skewed(spark):
    """A third of the rows with one key, a third without a key, and many small keys."""
    return spark.range(30_000).select(
        "id",
        F.expr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE concat('k', id % 500) END").alias("key"),
    )


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_foreign_keys(spark, skewed, broadcast_bytes):
    reference = spark.createDataFrame([("hot",), ("hot",), (None,)] + [(f"k{i}",) for i in range(0, 500, 2)], "pk string")
    kept = lookup.validate_foreign_keys(skewed, "key", reference, "pk", broadcast_bytes)
    expected = skewed.filter("key IS NULL OR key = 'hot' OR cast(substr(key, 2) AS int) % 2 = 0")
    assert kept.columns == ["id", "key"]
    assert kept.count() == expected.count()
    assert kept.exceptAll(expected).isEmpty()
    assert lookup.validate_foreign_keys(skewed, "absent", reference, "pk").count() == 30_000


def test_a_hot_key_is_spread_over_tasks(spark, skewed):
    reference = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(500)], "pk string, value int")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = lookup.left_lookup(skewed, reference, "key", "pk", broadcast_bytes=0)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 30_000
        assert max(sizes) < 2 * 30_000 / 8
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_equal_rows_of_a_hot_key_are_spread(spark):
    facts = spark.range(40_000).selectExpr("'hot' AS key", "1 AS amount").unionByName(spark.range(4_000).selectExpr("CAST(NULL AS STRING) AS key", "1 AS amount"))
    reference = spark.createDataFrame([("hot", 1)], "pk string, value int")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = lookup.left_lookup(facts, reference, "key", "pk", broadcast_bytes=0).cache()
        sizes = [r["count"] for r in joined.filter("key IS NOT NULL").groupBy(F.spark_partition_id()).count().collect()]
        assert joined.filter("value IS NULL").count() == 4_000 and sum(sizes) == 40_000
        assert max(sizes) < 3 * 40_000 / 16
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_hot_keys_are_found(skewed):
    found = {r[0] for r in lookup.hot_keys(skewed, "key", 0.01).collect()}
    assert "hot" in found and len(found) <= 100


def test_known_ids_keep_their_keys(spark):
    known = spark.createDataFrame([(7, "a"), (3, "b"), (-1, "unknown")], "key bigint, id string")
    batch = spark.createDataFrame([("b",), ("c",), ("d",)], "id string")
    found = {r["id"]: r["key"] for r in keys.kept_keys(batch, known, "key", "id").collect()}
    assert found["b"] == 3 and sorted((found["c"], found["d"])) == [8, 9]


def test_medians_of_several_columns_take_the_passes_of_one(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(rng.gauss(0, 9), rng.randrange(1000) if rng.random() < 0.8 else None, None, rng.choice([1.5, float("nan")])) for _ in range(3001)]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double").withColumn("e", F.col("b").cast("decimal(10,2)")).cache()
    passes = []
    agg = type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *columns: (passes.append(len(columns)), agg(self, *columns))[1])
    alone = nulls.exact_medians(df, ["b"], finish_rows=20)
    one, passes[:] = len(passes), []
    found = nulls.exact_medians(df, ["a", "b", "c", "d", "e"], finish_rows=20)
    b = [r[1] for r in rows if r[1] is not None]
    assert found["a"] == pytest.approx(statistics.median(r[0] for r in rows)) and found["b"] == alone["b"] == statistics.median(b)
    assert (found["c"], found["d"], float(found["e"])) == (None, 1.5, statistics.median(b))
    assert len(passes) <= one + 2
    filled = nulls.handle_nulls(df, {"b": "fill_median", "c": "drop", "e": "fill_median"})  # c is always missing: nothing is left for e
    assert filled.count() == 0 and nulls.handle_nulls(df, {"b": "fill_median", "e": "fill_median"}).filter("b IS NULL OR e IS NULL").isEmpty()


def test_median_of_decimals_is_a_decimal(spark):
    df = spark.createDataFrame([("1.10",), ("2.25",), (None,), ("90071992547409.93",), ("3.00",)], "t string").selectExpr("CAST(t AS DECIMAL(18,2)) AS v")
    filled = nulls.handle_nulls(df, {"v": "fill_median"})
    assert filled.dtypes == df.dtypes and sorted(str(r[0]) for r in filled.collect()) == ["1.10", "2.25", "2.63", "3.00", "90071992547409.93"]


def test_orphans_are_counted_per_key(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "fk string")
    reference = spark.createDataFrame([("b",)], "pk string")
    assert rows(lookup.orphan_rows(df, "fk", reference, "pk"), "fk") == [("a", 2)]


def test_surrogate_keys_are_dense_and_repeatable(spark):
    ids = spark.range(0, 5000, 7).select(F.concat(F.lit("x"), "id").alias("id"))
    first = keys.surrogate_key(ids.repartition(3), "key", ["id"], start=10)
    again = keys.surrogate_key(ids.repartition(5), "key", ["id"], start=10)
    assert sorted(r["key"] for r in first.collect()) == list(range(11, 11 + ids.count()))
    assert first.exceptAll(again).isEmpty()


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, s string, x double")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "id int, s string")
    merged = merge.upsert_rows(target, source, ["id"])
    assert rows(merged, "id") == [(1, "a", 1.0), (2, "B", 2.0), (3, "C", None)]
    assert rows(merge.upsert_rows(merged, source, ["id"]), "id") == rows(merged, "id")
    with pytest.raises(ValueError):
        dedup.require_unique(source.union(source), ["id"], "source")


def test_history(spark):
    dimension = spark.createDataFrame(
        [(1, "c-777", "SP", "2024-01-01", "9999-12-31", True), (2, "c-1", None, "2024-01-01", "9999-12-31", True),
         (3, "gone", "AC", "2024-01-01", "9999-12-31", True)],
        "customer_key bigint, customer_id string, state string, valid_from string, valid_to string, is_current boolean",
    ).withColumns({c: F.col(c).cast("date") for c in ("valid_from", "valid_to")})

    def merged(df, incoming, day):
        new = spark.createDataFrame(incoming, "customer_id string, state string")
        return merge.scd2_merge(df, new, "customer_id", ["state"], day, "customer_key")

    first = merged(dimension, [("c-777", "RJ"), ("c-1", None), ("c-2", "BA")], "2025-06-01")
    keyed = {(r["customer_id"], str(r["valid_from"]), str(r["valid_to"]), r["is_current"], r["state"]) for r in first.collect()}
    assert keyed == {
        ("c-777", "2024-01-01", "2025-05-31", False, "SP"),
        ("c-777", "2025-06-01", "9999-12-31", True, "RJ"),
        ("c-1", "2024-01-01", "9999-12-31", True, None),
        ("gone", "2024-01-01", "9999-12-31", True, "AC"),
        ("c-2", "2025-06-01", "9999-12-31", True, "BA"),
    }
    assert sorted(r["customer_key"] for r in first.collect()) == [1, 2, 3, 4, 5]
    same = merged(first, [("c-777", "RJ"), ("c-1", None), ("c-2", "BA")], "2025-07-01")
    assert same.exceptAll(first).isEmpty() and same.count() == 5
    third = merged(first, [("c-777", "SP")], "2025-08-01")
    current = third.filter("is_current").groupBy("customer_id").count().filter("count > 1")
    assert current.isEmpty()
    again = merged(third, [("c-777", "MG")], "2025-08-01")
    assert {(r["state"], r["customer_key"]) for r in again.filter("customer_id = 'c-777' AND is_current").collect()} == {
        ("MG", third.filter("customer_id = 'c-777' AND is_current").first()["customer_key"])
    }
    assert again.count() == third.count() and again.filter("valid_from > valid_to").isEmpty()
    with pytest.raises(ValueError, match="repeats"):
        merged(first, [("c-1", "A"), ("c-1", "B")], "2026-01-01")
    late = merged(first, [("c-777", "A"), ("c-1", None), ("c-2", "BA")], "2025-05-01")  # before the version of June; the others say nothing new
    states = [(r["state"], str(r["valid_from"]), str(r["valid_to"]), r["is_current"]) for r in late.filter("customer_id = 'c-777'").orderBy("valid_from").collect()]
    assert states == [("SP", "2024-01-01", "2025-04-30", False), ("A", "2025-05-01", "2025-05-31", False), ("RJ", "2025-06-01", "9999-12-31", True)]
    assert late.count() == 6 and sorted(r["customer_key"] for r in late.collect()) == [1, 2, 3, 4, 5, 6]
    spans = third.alias("a").join(third.alias("b"), F.expr(
        "a.customer_id = b.customer_id AND a.customer_key < b.customer_key AND a.valid_from <= b.valid_to AND b.valid_from <= a.valid_to"))
    assert spans.isEmpty()


def test_shuffled_changes_give_the_history_of_sorted_ones(spark):
    rng = random.Random(1)
    kinds = "id string, v string, day string"
    changes = [(f"c{i}", rng.choice("ABC"), f"2024-0{m}-1{i % 10}") for i in range(12) for m in range(1, 8) if rng.random() < 0.6]
    empty = spark.createDataFrame([(-1, "unknown", None, "1900-01-01", "9999-12-31", True)], "k bigint, id string, v string, valid_from string, valid_to string, is_current boolean")
    empty = empty.withColumns({c: F.col(c).cast("date") for c in ("valid_from", "valid_to")})

    def history(batches):
        dimension = empty
        for batch in batches:
            incoming = spark.createDataFrame(batch, kinds)
            merged = merge.scd2_merge(dimension, incoming, "id", ["v"], F.col("day").cast("date"), "k")
            dimension = spark.createDataFrame(merged.collect(), empty.schema)
        return dimension.collect()

    def periods(rows):
        return sorted((r["id"], r["v"] or "", r["valid_from"], r["valid_to"], r["is_current"]) for r in rows)

    whole = history([sorted(changes, key=lambda c: c[2])])
    mixed = rng.sample(changes, len(changes))
    parts = history([mixed[:10], mixed[10:25], mixed[25:]])
    assert periods(parts) == periods(whole) and len(whole) == len(changes) + 1
    assert sorted(r["k"] for r in parts) == [-1, *range(1, len(changes) + 1)]  # an unknown member alone does not make 0 a key
    for i in {c[0] for c in changes}:
        own = sorted((r for r in parts if r["id"] == i), key=lambda r: r["valid_from"])
        assert [r["is_current"] for r in own] == [False] * (len(own) - 1) + [True]
        assert all((b["valid_from"] - a["valid_to"]).days == 1 for a, b in zip(own, own[1:], strict=False))


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_as_of_lookup(spark, broadcast_bytes):
    versions = spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-03-01", 2), ("b", "2024-02-01", 3)], "vid string, day string, k bigint")
    versions = versions.withColumn("day", F.col("day").cast("date"))
    facts = spark.createDataFrame(
        [(1, "a", "2024-02-28 10:00:00"), (2, "a", "2024-03-01 00:00:00"), (3, "a", "2020-01-01 00:00:00"), (4, "a", None), (5, "b", "2030-01-01 00:00:00"),
         (6, None, "2024-01-01 00:00:00"), (7, "x", None), (8, "a", "2024-02-28 10:00:00")], "n int, id string, at string",
    ).withColumn("at", F.col("at").cast("timestamp"))
    found = lookup.as_of_lookup(facts, versions, "id", F.col("at"), "vid", "day", "k", broadcast_bytes, hot_from=facts)
    assert found.columns == ["n", "id", "at", "k"]
    assert [r["k"] for r in found.orderBy("n").collect()] == [1, 2, 1, 2, 3, None, None, 1]


def test_many_versions_cost_their_number_not_a_product(spark):
    """Ten thousand versions and as many facts of one key: no operator makes more rows than versions and facts together."""
    versions = spark.range(10_000).selectExpr("'a' AS vid", "date_add(date'1990-01-01', CAST(id AS INT)) AS day", "id AS k")
    facts = spark.range(10_000).selectExpr("id AS n", "'a' AS id", "date_add(date'1990-01-01', CAST(id AS INT)) AS at")
    found = lookup.as_of_lookup(facts, versions, "id", F.col("at"), "vid", "day", "k")
    assert found.filter("k = n").count() == 10_000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Window" in plan


def test_sieves(spark):
    blocks = sieve.blocks_for(3000)
    ids = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"))
    whole = sieve.sieve(ids, "k", blocks)
    parts = sieve.with_keys(sieve.sieve(ids.filter("length(k) < 4"), "k", blocks), ids.filter("length(k) >= 4"), "k")
    assert sorted((r["block"], bytes(r["bits"])) for r in whole.collect()) == sorted((r["block"], bytes(r["bits"])) for r in parts.collect())
    assert 0 < sieve.fill(whole) < 0.5
    asked = spark.range(9000).selectExpr("CASE WHEN id = 8999 THEN NULL ELSE concat('k', id) END AS k", "id")
    for limit in (None, 0):
        passed = {r["id"] for r in sieve.sifted(asked, "k", parts, limit).collect()}
        assert set(range(3000)) <= passed and 8999 in passed and len(passed) < 3000 + 100
    with pytest.raises(ValueError, match="sizes"):
        sieve.n_blocks(whole.unionByName(sieve.sieve(ids, "k", blocks + 1)))


@pytest.mark.parametrize("limit", [None, 0])
def test_foreign_keys_of_the_batch_and_of_earlier_ones(spark, limit):
    orders = spark.createDataFrame([("d", "c1"), ("e", "c2"), ("f", "c9"), ("g", None)], "id string, key string")
    batch, stored = spark.createDataFrame([("c2",)], "pk string"), spark.createDataFrame([("c1",), ("c3",)], "pk string")
    kept = lookup.validate_foreign_keys(orders, "key", batch, "pk", limit, stored=stored, sieve=sieve.sieve(stored, "pk", 1))
    assert sorted(r["id"] for r in kept.collect()) == ["d", "e", "g"]
