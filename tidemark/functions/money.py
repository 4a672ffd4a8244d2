"""Money as decimals: one rounding at the end, half up, the same on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for values that are wrong, so that the checks see them; the gold tables are narrower.
MONEY = "decimal(18,2)"
PERCENT = "decimal(18,2)"

# Upper bounds (inclusive) of the price bands, cheapest first, and the band above them.
PRICE_BANDS = ((50, "Budget"), (250, "Mid-Range"), (1000, "Premium"))
TOP_BAND = "Luxury"

# Fixed value: share of the price taken as cost when the recorded cost is implausible.
FALLBACK_COST_SHARE = "0.70"


def to_money(c: Column, target: str = MONEY) -> Column:
    """Cast to a wide decimal first: a double is then rounded as it prints, not as it is stored. NULL if not even that fits."""
    return F.round(c.try_cast("decimal(28,6)"), 2).try_cast(target)


def rounded(c: Column, decimals: int, is_decimal: bool) -> Column:
    """Decimals round half up. Doubles round half to even after scaling, as vectorised array rounding does."""
    if is_decimal:
        return F.round(c, decimals)
    scale = F.lit(10.0**decimals)
    return F.rint(c * scale) / scale


def plausible_cost(price: Column, cost: Column) -> Column:
    """Cost must lie above zero and below the price; otherwise it becomes a share of the price."""
    fallback = F.round(price * F.lit(FALLBACK_COST_SHARE).cast("decimal(2,2)"), 2).cast(MONEY)
    return F.when((cost >= price) | (cost <= 0), fallback).otherwise(cost)


def _percent_of_line(quantity: Column, unit_price: Column, percent: Column) -> Column:
    gross = quantity.cast("decimal(10,0)") * unit_price.cast(MONEY)
    return (F.try_multiply(gross, percent) / F.lit(100).cast("decimal(3,0)")).try_cast(MONEY)


def line_total(quantity: Column, unit_price: Column, discount_percent: Column) -> Column:
    """What the customer pays; a NULL operand gives NULL."""
    return _percent_of_line(quantity, unit_price, F.lit(100).cast(PERCENT) - discount_percent)


def line_discount(quantity: Column, unit_price: Column, discount_percent: Column) -> Column:
    return _percent_of_line(quantity, unit_price, discount_percent)


def margin_percent(price: Column, cost: Column) -> Column:
    share = (price - cost).cast("double") / price.cast("double") * 100
    return F.when(price > 0, F.round(share, 2)).otherwise(F.lit(0.0))


def price_range(price: Column) -> Column:
    bands = F.when(price <= PRICE_BANDS[0][0], PRICE_BANDS[0][1])
    for upper, name in PRICE_BANDS[1:]:
        bands = bands.when(price <= upper, name)
    return bands.otherwise(TOP_BAND)
