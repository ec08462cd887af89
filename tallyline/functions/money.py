"""Exact money and ratio expressions. Nothing here goes through floating point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(20,2)"


def as_price(column: Column) -> Column:
    """A price with all its digits: it is classified and multiplied before anything is rounded."""
    return column.cast("decimal(18,8)")


def stored_price(column: Column) -> Column:
    """A price as the fact stores it."""
    return column.cast("decimal(12,4)")


def line_value(quantity: Column, price: Column) -> Column:
    """Unrounded quantity x price."""
    return quantity * as_price(price)


def line_revenue(quantity: Column, price: Column) -> Column:
    """Quantity x price rounded half up to pennies."""
    return F.round(line_value(quantity, price), 2).cast("decimal(14,2)")


def ratio(numerator: Column, denominator: Column, digits: int, scale: int = 1) -> Column:
    """``scale * numerator / denominator`` rounded half up, null over zero or null.

    Both sides become DECIMAL(20,2), which leaves at least 14 fractional digits in the
    quotient before the only rounding step.
    """
    top = numerator.cast(EXACT) * F.lit(scale)
    return F.round(top / F.nullif(denominator.cast(EXACT), F.lit(0).cast(EXACT)), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return ratio(part, whole, digits, scale=100)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Plain quotient, null where the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def or_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0).cast("decimal(24,2)"))
