"""Quality checks as one result row each.

A suite is one query. Everything that needs no shuffle (counts, bounds, latest date) is computed for
all columns in a single pass that ends in one row. A uniqueness check and a sample of invalid values
are each an aggregate over their own column only, taken into that row as scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import age_hours, as_moment
from tidemark.schemas import table_schema

RESULT = table_schema(
    check_name="string", table_name="string", column_name="string", passed="boolean", total_rows="long",
    checked_rows="long", violations="long", actual="double", threshold="double", min_allowed="double",
    max_allowed="double", actual_min="double", actual_max="double", sample=T.ArrayType(T.StringType()),
    error="string", checked_at="timestamp",
)

KINDS = {f.name: f.dataType.simpleString() for f in RESULT.fields}

SAMPLE_SIZE = 5


@dataclass
class _Plan:
    """What a suite adds to the common pass, and the rows made from it."""

    df: DataFrame
    table: str
    now: Column
    measures: list[Column] = field(default_factory=list)
    merges: list[Column] = field(default_factory=list)
    rows: list[Column] = field(default_factory=list)

    def measure(self, value: Column, merge: Callable[[Column], Column] = F.sum) -> Column:
        """A column of the common pass; ``merge`` brings the values of parts of the table together."""
        name = f"m{len(self.measures)}"
        self.measures.append(value.alias(name))
        self.merges.append(merge(F.col(name)).alias(name))
        return F.col(name)

    def distinct(self, column: str) -> DataFrame:
        """One row: ``total_rows``, ``filled`` and ``different`` values of a column."""
        return self.df.select(self.present(column).alias("v")).agg(
            F.count(F.lit(1)).alias("total_rows"), F.count("v").alias("filled"), F.count_distinct("v").alias("different")
        )

    def invalid(self, column: str, bad: Column) -> DataFrame:
        """One row: a ``sample`` of the values for which ``bad`` holds."""
        return distinct_sample(self.df.filter(bad), column)

    def present(self, column: str) -> Column:
        """The column with NaN as NULL."""
        c = F.col(column)
        is_float = isinstance(self.df.schema[column].dataType, (T.DoubleType, T.FloatType))
        return F.nanvl(c, F.lit(None)) if is_float else c

    def __post_init__(self) -> None:
        # Made once per suite: a check fills in a few fields and shares the others.
        self.shared = {name: F.lit(None).cast(kind).alias(name) for name, kind in KINDS.items()}
        self.shared["table_name"] = F.lit(self.table).alias("table_name")
        self.shared["total_rows"] = F.col("total_rows")
        self.shared["checked_at"] = self.now.cast("timestamp").alias("checked_at")

    def row(self, check: str, column: str | None, passed: Column, **values: Column) -> Column:
        """A result as a struct, over columns among which is ``total_rows``."""
        values = {"check_name": F.lit(check), "column_name": F.lit(column), "passed": passed, **values}
        own = {name: value.cast(KINDS[name]).alias(name) for name, value in values.items()}
        return F.struct(*[own.get(name, self.shared[name]) for name in KINDS])

    def result(self, check: str, column: str | None, passed: Column, **values: Column) -> None:
        self.rows.append(self.row(check, column, passed, **values))

    def absent(self, check: str, column: str) -> None:
        self.result(check, column, F.lit(False), error=F.lit("no such column"))

    def stats(self) -> DataFrame:
        return self.df.agg(F.count(F.lit(1)).alias("total_rows"), *self.measures)

    def run(self) -> DataFrame:
        spark = self.df.sparkSession
        if not self.rows:
            return spark.createDataFrame([], RESULT)
        results = self.stats().select(F.inline(F.array(*self.rows)))
        # An empty table gives no result, except that it cannot be fresh.
        return results.filter((F.col("total_rows") > 0) | (F.col("check_name") == "freshness"))


def _completeness(plan: _Plan, columns: Sequence[str], threshold: float) -> None:
    for column in columns:
        if column not in plan.df.columns:
            plan.absent("completeness", column)
            continue
        filled, total = plan.measure(F.count(plan.present(column))), F.col("total_rows")
        share = filled.cast("double") / F.nullif(total, F.lit(0)).cast("double")
        plan.result(
            f"completeness_{column}",
            column,
            share >= F.lit(float(threshold)),
            checked_rows=filled,
            violations=total - filled,
            actual=F.round(share * 100, 2),
            threshold=F.lit(round(threshold * 100, 2)),
        )


def _uniqueness(plan: _Plan, columns: Sequence[str]) -> None:
    for column in columns:
        if column not in plan.df.columns:
            plan.absent("uniqueness", column)
            continue
        filled, repeated = F.col("filled"), F.col("filled") - F.col("different")
        share = repeated.cast("double") / F.nullif(filled, F.lit(0)).cast("double")
        result = plan.row(
            f"uniqueness_{column}",
            column,
            repeated == 0,
            checked_rows=filled,
            violations=repeated,
            actual=F.coalesce(F.round(share * 100, 2), F.lit(0.0)),
        )
        # The whole result is one scalar, so that the subquery is planned once.
        plan.rows.append(plan.distinct(column).select(result.alias("result")).scalar())


def _ranges(plan: _Plan, bounds: Mapping[str, Sequence[float]]) -> None:
    for column, (low, high) in bounds.items():
        if column not in plan.df.columns:
            continue
        c = plan.present(column)
        outside = plan.measure(F.count_if((c < F.lit(low)) | (c > F.lit(high))))
        plan.result(
            f"range_{column}",
            column,
            outside == 0,
            violations=outside,
            min_allowed=F.lit(low),
            max_allowed=F.lit(high),
            actual_min=plan.measure(F.min(c), F.min),
            actual_max=plan.measure(F.max(c), F.max),
        )


def _allowed_values(plan: _Plan, vocabularies: Mapping[str, Sequence]) -> None:
    for column, allowed in vocabularies.items():
        if column not in plan.df.columns:
            continue
        bad = F.col(column).isNotNull() & ~F.col(column).isin(*allowed)
        invalid = plan.measure(F.count_if(bad))
        plan.result(
            f"allowed_values_{column}",
            column,
            invalid == 0,
            violations=invalid,
            sample=plan.invalid(column, bad).scalar(),
        )


def distinct_sample(df: DataFrame, column: str, size: int = SAMPLE_SIZE) -> DataFrame:
    """One row: the first few distinct values in order, as text. Only ``size`` values per task travel."""
    few = df.select(F.col(column).alias("v")).dropna().distinct().orderBy("v").limit(size)
    return few.agg(F.array_sort(F.collect_list(F.col("v"))).cast("array<string>").alias("sample"))


def _freshness(plan: _Plan, column: str | None, max_age_hours: float) -> None:
    if column not in plan.df.columns:
        plan.result("freshness", column, F.lit(False), error=F.lit("no time to judge by"))
        return
    latest = plan.measure(F.max(F.col(column).cast("timestamp")), F.max)
    age = age_hours(latest, plan.now)
    plan.result(
        "freshness",
        column,
        F.coalesce(age <= F.lit(float(max_age_hours)), F.lit(False)),
        actual=F.round(age, 2),
        threshold=F.lit(max_age_hours),
        error=F.when(latest.isNull(), "no time to judge by"),
    )


def check_completeness(df, table: str, columns: Sequence[str], threshold: float = 0.98, now=None) -> DataFrame:
    """Share of values that are not missing, at least ``threshold``; a missing column fails."""
    plan = _Plan(df, table, as_moment(now))
    _completeness(plan, columns, threshold)
    return plan.run()


def check_uniqueness(df, table: str, columns: Sequence[str], now=None) -> DataFrame:
    """No value occurs twice; missing values do not count."""
    plan = _Plan(df, table, as_moment(now))
    _uniqueness(plan, columns)
    return plan.run()


def check_value_ranges(df, table: str, bounds: Mapping[str, Sequence[float]], now=None) -> DataFrame:
    """Values within [low, high]; missing values pass and missing columns are skipped."""
    plan = _Plan(df, table, as_moment(now))
    _ranges(plan, bounds)
    return plan.run()


def check_allowed_values(df, table: str, vocabularies: Mapping[str, Sequence], now=None) -> DataFrame:
    """Values from a list; missing values pass and missing columns are skipped."""
    plan = _Plan(df, table, as_moment(now))
    _allowed_values(plan, vocabularies)
    return plan.run()


def check_freshness(df, table: str, column: str, max_age_hours: float = 24, now=None) -> DataFrame:
    """The latest date is at most ``max_age_hours`` old."""
    plan = _Plan(df, table, as_moment(now))
    _freshness(plan, column, max_age_hours)
    return plan.run()


def run_suite(df: DataFrame, suite: Mapping, now=None) -> DataFrame:
    """All checks of a suite as one query."""
    plan = _Plan(df, suite["table_name"], as_moment(now))
    add_suite(plan, suite)
    return plan.run()


def add_suite(plan: _Plan, suite: Mapping) -> None:
    checks = suite.get("checks", {})
    if "completeness" in checks:
        wanted = checks["completeness"]
        _completeness(plan, wanted.get("columns", []), wanted.get("threshold", 0.98))
    if "uniqueness" in checks:
        _uniqueness(plan, checks["uniqueness"].get("columns", []))
    _ranges(plan, checks.get("ranges", {}))
    _allowed_values(plan, checks.get("allowed_values", {}))
    if "freshness" in checks:
        wanted = checks["freshness"]
        _freshness(plan, wanted.get("column"), wanted.get("max_age_hours", 24))


def check_min_date(df: DataFrame, table: str, column: str, earliest: str, now=None) -> DataFrame:
    """No date lies before ``earliest``; missing dates pass."""
    plan = _Plan(df, table, as_moment(now))
    before = plan.measure(F.count_if(F.col(column) < F.lit(earliest).cast("date")))
    plan.result(f"min_date_{column}", column, before == 0, violations=before)
    return plan.run()
