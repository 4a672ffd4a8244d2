"""Tables of a layer that was written earlier, and SQL over them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def table_path(base: str, layer: str, name: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{name}"


# The file that names the version of a table that counts.
POINTER = "_CURRENT"


def current_path(spark: SparkSession, path: str) -> str:
    """The folder that the table's pointer names, or ``path`` itself where there is none."""
    jvm = spark._jvm
    pointer = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{POINTER}")
    system = pointer.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(pointer):
        return path
    stream = system.open(pointer)
    try:
        return f"{path.rstrip('/')}/{jvm.org.apache.commons.io.IOUtils.toString(stream, 'UTF-8').strip()}"
    finally:
        stream.close()


def read_table(spark: SparkSession, path: str, data_format: str = "parquet", **options: str) -> DataFrame:
    """The current version of a table that was written in versions, or any folder of files."""
    return spark.read.format(data_format).options(**options).load(current_path(spark, path))


def read_layer(spark: SparkSession, base: str, layer: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: read_table(spark, table_path(base, layer, name)) for name in names}


def sql_query(
    spark: SparkSession, query: str, params: Mapping[str, object] | None = None, **tables: DataFrame
) -> DataFrame:
    """SQL with named parameters (``:name``) over catalogue tables or, as ``{name}``, over DataFrames."""
    return spark.sql(query, args=dict(params or {}), **tables)


def read_jdbc_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """The result of a query that an external database runs."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def source_health(df: DataFrame) -> bool:
    """Whether a source answers with a row, or with none; a limit of no rows would be planned away."""
    try:
        df.limit(1).collect()
    except Exception:
        return False
    return True
