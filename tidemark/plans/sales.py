"""Questions asked of the star schema. The fact is reduced to one row per day or method before any join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Label of sales on no day of the calendar.
UNKNOWN_DAY = "unknown"


def _per_day(fact: DataFrame) -> DataFrame:
    return fact.groupBy("date_key").agg(F.sum("total_amount").alias("total_amount"), F.count(F.lit(1)).alias("lines"))


def _with_calendar(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Both sides have at most one row per day, so neither the join nor what follows can grow."""
    return _per_day(fact).join(days, "date_key")


def holiday_revenue(fact: DataFrame, days: DataFrame) -> DataFrame:
    return _with_calendar(fact, days).groupBy("is_holiday").agg(F.sum("total_amount").alias("total_amount"))


def sales_by_calendar(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Sales per year, month, quarter, weekday and holiday in one result; ``grain`` names the level.

    Sales on days that the calendar lacks are labelled as such, so that every level adds up to the fact.
    """
    daily = _per_day(fact).join(days, "date_key", "left")
    year, month, quarter = F.col("year"), F.col("month"), F.col("quarter")
    grains = {
        "year": year.cast("string"),
        "month": F.when(year.isNotNull(), F.format_string("%d-%02d", year, month)),
        "quarter": F.when(year.isNotNull(), F.format_string("%d-Q%d", year, quarter)),
        "weekday": F.col("day_name"),
        "holiday": F.col("is_holiday").cast("string"),
    }
    cells = [F.struct(F.lit(g).alias("grain"), F.coalesce(label, F.lit(UNKNOWN_DAY)).alias("label")) for g, label in grains.items()]
    return (
        daily.select("total_amount", "lines", F.inline(F.array(*cells)))
        .groupBy("grain", "label")
        .agg(F.sum("total_amount").alias("total_amount"), F.sum("lines").alias("lines"))
    )


def payment_method_top_avg(fact: DataFrame) -> DataFrame:
    """The payment method with the highest mean sale; the name decides a tie."""
    means = fact.groupBy("payment_method").agg(F.avg("total_amount").alias("mean_sale"))
    return means.orderBy(F.col("mean_sale").desc(), "payment_method").limit(1)
