"""A suite over all batches of a table that reads the new batch alone.

What a suite measures (rows, filled values, values out of bounds, extremes, the latest time, samples of invalid values) is kept per batch and
period, a row each, and can be merged: counts by sum, extremes by minimum and maximum, samples by the first few distinct values of all. Uniqueness
needs the values themselves: they lie in a :class:`~tidemark.operators.key_index.KeyIndex`, of which a batch reads the hash buckets that its
values fall into.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import as_moment
from tidemark.operators.key_index import KeyIndex
from tidemark.quality.checks import SAMPLE_SIZE, _Plan, add_suite
from tidemark.sinks.files import write_layer
from tidemark.sources.layers import read_table, table_path


class _Batch(_Plan):
    """Notes what the suite wants of the batch instead of reading it."""

    def __post_init__(self) -> None:
        super().__post_init__()
        self.unique: list[str] = []
        self.bad: dict[str, Column] = {}

    def distinct(self, column: str) -> DataFrame:
        self.unique.append(column)
        return super().distinct(column)

    def invalid(self, column: str, bad: Column) -> DataFrame:
        self.bad[column] = bad
        return super().invalid(column, bad)


class _Merged(_Plan):
    """The same suite over the states."""

    states: DataFrame
    values: DataFrame

    def distinct(self, column: str) -> DataFrame:
        own = self.values.filter(F.col("column_name") == column)
        return own.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total_rows", "filled", "different")])

    def invalid(self, column: str, bad: Column) -> DataFrame:
        name = f"sample_{column}"
        few = self.states.select(F.explode(name).alias("v")).distinct().orderBy("v").limit(SAMPLE_SIZE)
        return few.agg(F.array_sort(F.collect_list("v")).alias("sample"))

    def stats(self) -> DataFrame:
        return self.states.agg(F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"), *self.merges)


@dataclass
class SuiteHistory:
    """The states of ``suite`` under ``path``, for a table of ``schema`` whose rows belong to the period ``period``."""

    spark: SparkSession
    path: str
    suite: Mapping
    period: Column

    def _values(self, column: str) -> KeyIndex:
        return KeyIndex(self.spark, f"{self.path}/values_{column}", "value", "seen", ("batch",))

    def add(self, batch: DataFrame, number: int) -> None:
        """Take in batch ``number``: its rows are new ones, not corrections of earlier rows. Numbers rise; the last one may be added again, after a
        failure for instance, and counts once. ``batch`` is read a few times and should be a written table."""
        plan = _Batch(batch, self.suite["table_name"], as_moment(None))
        add_suite(plan, self.suite)
        counted = [self._counted(batch, plan.present(column), column, number) for column in dict.fromkeys(plan.unique)]
        measures = [F.count(F.lit(1)).alias("total_rows"), *plan.measures]
        states = batch.groupBy(self.period.alias("period")).agg(*measures)
        for column, bad in plan.bad.items():
            states = states.join(self._first_bad(batch, column, bad), F.col("period").eqNullSafe(F.col("_of")), "left").drop("_of")
        states.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/states/batch={number}")
        if counted:
            kinds = {"column_name": "string", "total_rows": "bigint", "filled": "bigint", "different": "bigint"}
            rows = [F.struct(*[F.lit(v).cast(k).alias(c) for v, (c, k) in zip(values, kinds.items(), strict=True)]) for values in counted]
            self.spark.range(1, numPartitions=1).select(F.inline(F.array(*rows))).write.mode("overwrite").parquet(f"{self.path}/unique/batch={number}")

    def _first_bad(self, batch: DataFrame, column: str, bad: Column) -> DataFrame:
        """The first few distinct invalid values of each period."""
        own = batch.filter(bad).select(self.period.alias("_of"), F.col(column).alias("v")).distinct()
        place = F.row_number().over(Window.partitionBy("_of").orderBy("v"))
        few = own.withColumn("place", place).filter(F.col("place") <= SAMPLE_SIZE)
        return few.groupBy("_of").agg(F.array_sort(F.collect_list("v")).cast("array<string>").alias(f"sample_{column}"))

    def _counted(self, batch: DataFrame, value: Column, column: str, number: int) -> tuple[str, int, int, int]:
        """The column's rows, filled values and values that no earlier batch had, which are recorded."""
        index, given = self._values(column), batch.select(value.cast("string").alias("value"))
        filled = given.agg(F.count(F.lit(1)).alias("total_rows"), F.count("value").alias("filled"))
        own = given.filter("value IS NOT NULL").distinct()
        if index.exists():
            earlier = index.known(own).filter(F.exists("_places", lambda p: p["batch"] < number)).select("value")
            own = own.join(earlier, "value", "left_anti")
        new = own.select("value", F.lit(1).cast("bigint").alias("seen"), F.lit(number).alias("batch"))
        total, present = filled.first()
        different = write_layer({column: new}, self.path, "new_values")[column]
        if different:
            index.record(read_table(self.spark, table_path(self.path, "new_values", column)))
        return column, total, present, different

    def results(self, schema: DataFrame, now=None) -> DataFrame:
        """What :func:`~tidemark.quality.checks.run_suite` would give for all batches together; ``schema`` is a table with their columns, which is not read."""
        plan = _Merged(schema, self.suite["table_name"], as_moment(now))
        plan.states = self.spark.read.parquet(f"{self.path}/states")
        if self.suite.get("checks", {}).get("uniqueness"):
            plan.values = self.spark.read.parquet(f"{self.path}/unique")
        add_suite(plan, self.suite)
        return plan.run()
