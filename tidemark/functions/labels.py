"""Closed vocabularies."""

from __future__ import annotations

from pyspark.sql import Column

from pyspark.sql import functions as F

from tidemark.functions.text import standardized

# The accepted order states, customer segments and payment methods, and their defaults.
ORDER_STATUSES = ("completed", "pending", "shipped", "cancelled", "returned")
DEFAULT_STATUS = "pending"
SEGMENTS = ("b2c", "b2b", "premium", "enterprise")
DEFAULT_SEGMENT = "b2c"
PAYMENT_METHODS = ("credit_card", "debit_card", "pix", "boleto", "wallet")


def _one_of(c: Column, accepted: tuple[str, ...], default: str) -> Column:
    cleaned = standardized(c)
    return F.when(cleaned.isin(*accepted), cleaned).otherwise(default)


def order_status(c: Column) -> Column:
    return _one_of(c, ORDER_STATUSES, DEFAULT_STATUS)


def segment(c: Column) -> Column:
    return _one_of(c, SEGMENTS, DEFAULT_SEGMENT)
