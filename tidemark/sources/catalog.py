"""JSON documents of a product catalogue service: products, categories, users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tidemark import schemas
from tidemark.functions.dates import as_moment
from tidemark.functions.money import to_money
from tidemark.operators.cleaning import nan_to_null
from tidemark.sources.delimited import read_csv

# What a product gets when the catalogue has no such column.
DEFAULT_STOCK = 150
DEFAULT_CATEGORY = "Uncategorized"
DEFAULT_SUPPLIER = "FakeStoreAPI"
SKU_PREFIX = "API-PRD-"
COST_SHARE = "0.65"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def flat_rating(df: DataFrame) -> DataFrame:
    """``rating {rate, count}`` becomes the rate; a plain number stays."""
    if "rating" in df.columns and isinstance(df.schema["rating"].dataType, T.StructType):
        return df.withColumn("rating", F.col("rating.rate"))
    return df


def catalog_products(df: DataFrame, now=None) -> DataFrame:
    """Catalogue records in the shape of the product table, absent columns filled in."""
    df = flat_rating(df).withColumnsRenamed({"id": "product_id", "title": "name"})
    df = df.withColumn("product_id", F.col("product_id").cast("string"))
    if "category" not in df.columns:
        df = df.withColumn("category", F.lit(DEFAULT_CATEGORY))
    share = F.lit(COST_SHARE).cast("decimal(2,2)")
    defaults = {
        "cost_price": to_money(F.col("price").cast("decimal(18,6)") * share),
        "stock_quantity": F.lit(DEFAULT_STOCK),
        "subcategory": F.col("category"),
        "supplier": F.lit(DEFAULT_SUPPLIER),
        "sku": F.concat(F.lit(SKU_PREFIX), F.col("product_id")),
        "created_at": F.date_format(as_moment(now), TIMESTAMP_FORMAT),
    }
    return df.withColumns({name: value for name, value in defaults.items() if name not in df.columns})


def read_product_catalog(
    spark: SparkSession, path: str, schema: T.StructType = schemas.CATALOG_PRODUCT, multiline: bool = False, now=None
) -> DataFrame:
    """JSON Lines by default, which splits; ``multiline`` for files that hold one array."""
    return nan_to_null(catalog_products(spark.read.schema(schema).json(path, multiLine=multiline), now))


def categories(df: DataFrame, column: str) -> DataFrame:
    """One row per category of a column of JSON string lists; unreadable text gives none."""
    return df.select(F.explode(F.from_json(F.col(column), "array<string>")).alias("category"))


def users(df: DataFrame, column: str, schema: T.StructType = schemas.CATALOG_USER) -> DataFrame:
    """A column of JSON user records as nested columns, unflattened."""
    return df.select(F.from_json(F.col(column), schema).alias("_user")).select("_user.*")


def read_users(spark: SparkSession, path: str, schema: T.StructType = schemas.CATALOG_USER) -> DataFrame:
    return spark.read.schema(schema).json(path)


# The rating as text: a nested one is then the text of a JSON object.
_ANY_RATING = T.StructType([f if f.name != "rating" else T.StructField("rating", T.StringType()) for f in schemas.BRONZE["products"].fields])


def read_bronze_products(spark: SparkSession, json_path: str, csv_path: str, multiline: bool = False) -> DataFrame:
    """The catalogue if it was fetched, else the CSV extract, in the types of the product table.

    Both forms carry ``rating``: it is flattened where it is nested.
    """
    try:
        raw = spark.read.schema(_ANY_RATING).json(json_path, multiLine=multiline)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return read_csv(spark, csv_path, schemas.BRONZE["products"])
    rate = F.coalesce(F.get_json_object("rating", "$.rate"), F.col("rating")).try_cast("double")
    return nan_to_null(raw.withColumn("rating", rate))
