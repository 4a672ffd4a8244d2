"""Missing values, one strategy per column: drop, fill_mean, fill_median, fill_mode, fill_value:X."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def handle_nulls(df: DataFrame, strategies: Mapping[str, str], finish_rows: int = 100_000) -> DataFrame:
    """Apply the strategies in their order, so a later statistic sees the rows an earlier one left.

    Medians between two drops are of the same rows and are found together. A decimal column keeps its type under ``fill_median``;
    ``finish_rows`` is that of ``exact_medians``.
    """
    wanted = {c: s for c, s in strategies.items() if c in df.columns}
    medians: dict = {}
    for at, (column, strategy) in enumerate(wanted.items()):
        if strategy == "drop":
            df, medians = df.dropna(subset=[column]), {}
        elif strategy == "fill_mean":
            df = _fill(df, column, df.agg(F.avg(column)).scalar())
        elif strategy == "fill_median":
            if column not in medians:
                until_drop = itertools.takewhile(lambda c: wanted[c] != "drop", list(wanted)[at:])
                medians = exact_medians(df, [c for c in until_drop if wanted[c] == "fill_median"], finish_rows)
            median, kind = F.lit(medians[column]), df.schema[column].dataType
            df = _fill(df, column, F.round(median, kind.scale).cast(kind) if isinstance(kind, T.DecimalType) else median)
        elif strategy == "fill_mode":
            df = _fill(df, column, smallest_mode(df, column).scalar())
        elif strategy.startswith("fill_value:"):
            df = _fill(df, column, _typed_literal(df, column, strategy.split(":", 1)[1]))
    return df


def _fill(df: DataFrame, column: str, value: Column) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), value))


def _typed_literal(df: DataFrame, column: str, text: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.BooleanType):
        return F.lit(text.lower() in ("true", "1", "yes"))
    return F.lit(text).cast(kind)


def smallest_mode(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value, the smallest on a tie; one row, or none when all are NULL.

    Counting is a partial aggregate and the choice a top-1, where ``mode()`` would hold every distinct
    value in one buffer.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.col("_n").desc(), F.col(column).asc()).limit(1).select(column)


def exact_median(df: DataFrame, column: str, finish_rows: int = 100_000) -> float | Decimal | None:
    return exact_medians(df, [column], finish_rows)[column]


@dataclass
class _Search:
    """Where the middle ranks of a column are sought: strictly between ``above`` and ``under``, with ``below`` values before."""

    v: Column
    present: Column
    exact: bool
    rows: int = 0
    below: int = 0
    above: object = None
    under: object = None
    margin: float = 0.0005
    bracket: Sequence | None = None
    wanted: list[int] = field(default_factory=list)
    found: dict = field(default_factory=dict)

    def inside(self) -> Column:
        bounds = self.present
        if self.above is not None:
            bounds = bounds & (self.v > F.lit(self.above))
        return bounds if self.under is None else bounds & (self.v < F.lit(self.under))

    def open_ranks(self) -> list[int]:
        return [r for r in self.wanted if r not in self.found]

    def sketch(self) -> Column:
        """Bounds around the open ranks, from a quantile sketch of the values inside."""
        ranks = self.open_ranks()
        shares = [0.5 - self.margin, 0.5 + self.margin]
        if self.wanted:
            low, high = (ranks[0] - self.below) / self.rows, (ranks[-1] - self.below + 1) / self.rows
            shares = [max(low - self.margin, 0.0), min(high + self.margin, 1.0)]
        return F.percentile_approx(F.when(self.inside(), self.v), shares, 10_000)

    def counts(self) -> Column:
        """How many values inside are below and up to each bound."""
        low, high = (F.lit(b) for b in self.bracket)
        held = self.inside()
        return F.struct(*[F.count_if(held & test).alias(n) for n, test in (("a", self.v < low), ("b", self.v <= low), ("c", self.v < high), ("d", self.v <= high))])

    def narrow(self, under_low: int, to_low: int, under_high: int, to_high: int) -> None:
        """Take the ranks that the bounds hold and go on strictly between them; wider bounds next time if they missed."""
        (low, high), ranks = self.bracket, self.open_ranks()
        self.bracket = None
        if ranks[0] - self.below < under_low or ranks[-1] - self.below >= to_high:
            self.margin *= 4
            return
        for rank in ranks:
            if rank - self.below < to_low:
                self.found[rank] = low
            elif rank - self.below >= under_high:
                self.found[rank] = high
        self.above, self.under = low, high
        self.below, self.rows = self.below + to_low, under_high - to_low

    def median(self):
        if not self.wanted:
            return None
        total = sum(self.found[r] for r in self.wanted)
        return total / (Decimal(len(self.wanted)) if self.exact else len(self.wanted))


def exact_medians(df: DataFrame, columns: Sequence[str], finish_rows: int = 100_000) -> dict[str, float | Decimal | None]:
    """The exact medians of several columns, in as many passes as one of them takes and without bringing a column together anywhere.

    ``median()`` keeps every distinct value in one buffer. Here a quantile sketch brackets the middle rank of each column, exact counts say how
    many values lie below the bracket, and only those strictly inside matter in the next round: about one in a thousand. Each pass serves all
    columns and returns one row to the driver; the last one ranks at most ``finish_rows`` rows of each. Values are compared in the
    column's own type; the result is a decimal for decimals. NULL and NaN do not count; without values there is no median.
    """
    searches = {}
    for c in columns:
        v, kind = F.col(c), df.schema[c].dataType
        floating = isinstance(kind, (T.FloatType, T.DoubleType))
        searches[c] = _Search(v, v.isNotNull() & ~F.isnan(v) if floating else v.isNotNull(), isinstance(kind, T.DecimalType))
    if not searches:
        return {}
    # Rounds read the columns alone, from the executors' disks, and do not repeat what made them.
    df = df.select(*searches).persist(StorageLevel.DISK_ONLY)
    try:
        _find(df, list(searches.values()), finish_rows)
    finally:
        df.unpersist()
    return {c: s.median() for c, s in searches.items()}


def _find(df: DataFrame, every: Sequence[_Search], finish_rows: int) -> None:
    """Find the middle ranks of all columns."""
    first = df.agg(*[F.struct(F.count_if(s.present).alias("n"), s.sketch().alias("q")).alias(f"s{k}") for k, s in enumerate(every)]).first()
    for s, (n, bracket) in zip(every, first, strict=True):
        s.rows, s.bracket = n, bracket
        s.wanted = sorted({(n - 1) // 2, n // 2}) if n else []
    while wide := [s for s in every if s.open_ranks() and s.rows > finish_rows]:
        if unknown := [s for s in wide if s.bracket is None]:
            for s, q in zip(unknown, df.agg(*[s.sketch().alias(f"s{k}") for k, s in enumerate(unknown)]).first(), strict=True):
                s.bracket = q
        for s, counts in zip(wide, df.agg(*[s.counts().alias(f"s{k}") for k, s in enumerate(wide)]).first(), strict=True):
            s.narrow(*counts)
    if narrow := [s for s in every if s.open_ranks()]:
        _ranked(df, narrow)


def _ranked(df: DataFrame, searches: Sequence[_Search]) -> None:
    """Find the open ranks of columns that have few values inside, by a running count of each column's distinct ones."""
    values = [f"v{k}" for k in range(len(searches))]
    rows = []
    for k, s in enumerate(searches):
        own = [F.when(s.inside(), s.v).alias(n) if j == k else F.when(F.lit(False), searches[j].v).alias(n) for j, n in enumerate(values)]
        rows.append(F.when(s.inside(), F.struct(F.lit(k).alias("k"), *own)))
    counts = df.select(F.inline(F.array_compact(F.array(*rows)))).groupBy("k", *values).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("k").orderBy(*values).rowsBetween(Window.unboundedPreceding, 0))
    hit = F.lit(False)
    for k, s in enumerate(searches):
        for rank in s.open_ranks():
            place = rank - s.below
            hit = hit | ((F.col("k") == k) & (F.col("upto") > place) & (F.col("upto") - F.col("n") <= place))
    for row in counts.withColumn("upto", upto).filter(hit).collect():
        s = searches[row["k"]]
        for rank in s.open_ranks():
            if row["upto"] - row["n"] <= rank - s.below < row["upto"]:
                s.found[rank] = row[f"v{row['k']}"]
