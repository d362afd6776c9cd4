"""Money arithmetic: exact decimals, division that yields NULL on zero, and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schemas import CENT_TOLERANCE, MONEY, MONEY_SUM

# Wide enough for sums over 100 TB of lines, narrow enough that a quotient keeps 16 decimals.
_AMOUNT = "decimal(22,2)"
_COUNT = "decimal(14,0)"


def subtotal(price: Column, quantity: Column) -> Column:
    return F.round(price * quantity, 2).cast(MONEY)


def cart_total(items: Column) -> Column:
    """Sum of the subtotals of an array of {quantity, unit_price} items."""
    zero = F.lit(0).cast("decimal(20,2)")
    return F.aggregate(
        items,
        zero,
        lambda total, i: (total + i["unit_price"] * i["quantity"]).cast("decimal(20,2)"),
    )


def in_cents(amount: Column) -> Column:
    """Exact whole cents of an amount with two decimals."""
    return (amount * 100).cast("bigint")


def from_cents(cents: Column, kind: T.DecimalType = MONEY_SUM) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(kind)


def total(cents: str) -> Column:
    """Sum of a cents column as money. Adding 64-bit integers takes a third of the time of adding
    decimals too wide for one, is just as exact, and fails rather than wraps on overflow."""
    return from_cents(F.sum(cents))


def units(quantity: Column) -> Column:
    return F.sum(quantity).cast("bigint")


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL for a denominator of zero. CASE rather than NULLIF, which plans as an extra projection
    and so keeps a sort below it from becoming a top-N."""
    return numerator / F.when(denominator != 0, denominator)


def per_unit(amount: Column, count: Column, scale: int = 2) -> Column:
    """Amount per counted thing, NULL when nothing was counted, rounded half away from zero."""
    quotient = safe_divide(amount.cast(_AMOUNT), count.cast(_COUNT))
    return F.round(quotient, scale).cast(f"decimal(20,{scale})")


def percent_of(part: Column, whole: Column, scale: int = 1) -> Column:
    """part / whole * 100, NULL when the whole is zero."""
    quotient = safe_divide(part.cast(_AMOUNT) * F.lit(100).cast("decimal(3,0)"), whole.cast(_AMOUNT))
    return F.round(quotient, scale).cast(f"decimal(20,{scale})")


def differs(left: Column, right: Column, tolerance: str = CENT_TOLERANCE) -> Column:
    return F.abs(left - right) > F.lit(tolerance).cast("decimal(10,2)")


def currency_text(amount: Column) -> Column:
    return F.concat(
        F.when(amount < 0, "-").otherwise(""), F.lit("$"), F.format_number(F.abs(amount), 2)
    )


def percent_text(percent: Column, scale: int = 1) -> Column:
    return F.concat(F.format_number(percent, scale), F.lit("%"))


def thousands_text(count: Column) -> Column:
    return F.format_number(count, 0)
