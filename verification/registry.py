"""Registration of queries with the SQL that must give the same result."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verification.tables_sql import TABLES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def case(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; its SQL may name the derived tables of ``tables_sql``."""

    def register(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: portable(query(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = with_tables(sql)
        return query

    return register


def portable(df: DataFrame) -> DataFrame:
    """Types that compare alike everywhere: decimals as doubles, dates and times as text, lists joined."""

    def plain(field: T.StructField):
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DecimalType):
            c = c.cast("double")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(c, "|")
        return c.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def with_tables(sql: str) -> str:
    """Put the derived tables a statement needs in front of it, in the order they depend on each other."""
    needed: set[str] = set()
    waiting = [sql]
    while waiting:
        text = waiting.pop()
        for name, body in TABLES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                waiting.append(body)
    if not needed:
        return sql
    parts = ",\n".join(f"{name} AS ({body})" for name, body in TABLES.items() if name in needed)
    return f"WITH {parts}\n{sql}"
