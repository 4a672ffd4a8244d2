import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, labels, money, text
from tidemark.operators import cleaning as c


def test_standardize_strings(values):
    change = lambda df: c.standardize_strings(df, ["v", "absent"])
    assert values("string", ["  HELLO ", "world  ", "Test", None], change) == ["hello", "world", "test", None]
    assert values("string", ["\t A \r\n"], change) == ["a"]


def test_normalize_names(values):
    names = [" joão silva ", "MARIA oliveira", None, "o'brien", "T-SHIRT", "abc1def", "x\ty"]
    expected = ["João Silva", "Maria Oliveira", None, "O'Brien", "T-Shirt", "Abc1Def", "X\tY"]
    assert values("string", names, lambda df: c.normalize_names(df, ["v"])) == expected
    assert [n if n is None else n.strip().title() for n in names] == expected


def test_clean_email(values):
    given = [" TEST@domain.com  ", "invalid-email", "valid@domain.co.uk", None, "joão@x.com", "a@b.c\n"]
    expected = ["test@domain.com", None, "valid@domain.co.uk", None, None, "a@b.c"]
    assert values("string", given, lambda df: c.clean_email(df, "v")) == expected


def test_fix_negative_values(values):
    given = [-10.5, 20.0, -5.0, None]
    assert values("double", given, lambda df: c.fix_negative_values(df, ["v"])) == [10.5, 20.0, 5.0, None]
    assert values("double", given, lambda df: c.fix_negative_values(df, ["v"], "zero")) == [0.0, 20.0, 0.0, None]
    assert values("double", given, lambda df: c.fix_negative_values(df, ["v"], "other")) == given


def test_round_currency(values):
    assert values("double", [10.555, 20.1234, 5.0], lambda df: c.round_currency(df, ["v"])) == [10.56, 20.12, 5.0]


def test_parse_dates(values):
    parsed = values("string", ["2024-05-15 10:00:00", "soon", None, "2024-05-15"], lambda df: c.parse_dates(df, ["v"]))
    assert [str(p) for p in parsed] == ["2024-05-15 10:00:00", "None", "None", "2024-05-15 00:00:00"]
    formatted = values("string", ["15/05/2024", "2024-05-15"], lambda df: c.parse_dates(df, ["v"], "dd/MM/yyyy"))
    assert [str(p) for p in formatted] == ["2024-05-15 00:00:00", "None"]
    several = values("string", ["15/05/2024", "2024-05-15", "15.05.24 07:30", "x", None], lambda df: c.parse_dates(df, ["v"], ["dd/MM/yyyy", None, "dd.MM.yy HH:mm"]))
    assert [None if v is None else str(v) for v in several] == ["2024-05-15 00:00:00", "2024-05-15 00:00:00", "2024-05-15 07:30:00", None, None]


def test_nan_to_null(values):
    assert values("double", [float("nan"), 1.0, None], c.nan_to_null) == [None, 1.0, None]


def test_mask_tax_id(values):
    given = ["12345678901", "123.456.789-01", "12 345", None]
    expected = ["123.456.789-01", "123.456.789-01", "12345", None]
    assert values("string", given, lambda df: c.mask_tax_id(df, "v")) == expected


@pytest.mark.parametrize(
    "price, cost, expected",
    [("100", "50", "50.00"), ("100", "100", "70.00"), ("100", "0", "70.00"), ("100", "-1", "70.00"), ("0.01", "5", "0.01")],
)
def test_plausible_cost(spark, price, cost, expected):
    row = spark.range(1).select(
        money.plausible_cost(F.lit(price).cast(money.MONEY), F.lit(cost).cast(money.MONEY)).alias("v")
    )
    assert str(row.first()["v"]) == expected


def test_line_amounts(spark):
    columns = [F.lit(2), F.lit("1200.00").cast("decimal(10,2)"), F.lit("10.00").cast("decimal(5,2)")]
    row = spark.range(1).select(money.line_total(*columns).alias("t"), money.line_discount(*columns).alias("d")).first()
    assert (str(row["t"]), str(row["d"])) == ("2160.00", "240.00")


def test_price_range_bounds_are_inclusive(spark):
    prices = spark.createDataFrame([(50.0,), (50.01,), (250.0,), (1000.0,), (1000.01,)], "p double")
    bands = [r[0] for r in prices.orderBy("p").select(money.price_range(F.col("p"))).collect()]
    assert bands == ["Budget", "Mid-Range", "Mid-Range", "Premium", "Luxury"]


def test_margin_of_a_free_product_is_zero(spark):
    row = spark.sql("SELECT 0.00BD AS p, 1.00BD AS c").select(money.margin_percent(F.col("p"), F.col("c")))
    assert row.first()[0] == 0.0


def test_labels(values):
    assert values("string", [" SHIPPED", "odd", None], lambda df: df.withColumn("v", labels.order_status(F.col("v")))) == [
        "shipped", "pending", "pending",
    ]
    assert values("string", ["B2B ", None], lambda df: df.withColumn("v", labels.segment(F.col("v")))) == ["b2b", "b2c"]


def test_date_functions(spark):
    row = spark.sql("SELECT date'2024-12-25' AS d, timestamp'2024-12-25 12:00:00' AS t").select(
        dates.date_key(F.col("d")), dates.is_holiday(F.col("d")), dates.age_hours(F.col("t"), dates.as_moment("2024-12-26 00:30:00"))
    ).first()
    assert list(row) == [20241225, True, 12.5]


def test_white_space_is_what_python_strips():
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_cleaning_also_runs_on_a_stream(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([(" A ", "x@Y.com")], "name string, email string").write.parquet(source)
    stream = spark.readStream.schema("name string, email string").parquet(source)
    cleaned = c.clean_email(c.standardize_strings(stream, ["name"]), "email")
    query = cleaned.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
    query.awaitTermination(60)
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [("a", "x@y.com")]
