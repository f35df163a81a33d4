"""Exact money arithmetic in integer cents.

Monetary columns carry two decimals. Summing them as DECIMAL is exact but
slow (Spark widens the sum buffer past 18 digits and falls back to
BigDecimal); summing doubles is fast but order-dependent. Integer cents are
both: ``cents()`` recovers the exact cent count of a 2-decimal double, sums
run on longs (ANSI mode raises on overflow instead of wrapping), and the
result is divided once at the end — the same double a DECIMAL sum would give.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.util import as_col


def cents(c) -> Column:
    """Exact cent count of a value with at most two decimals (sign-aware rounding)."""
    x = as_col(c) * 100
    return F.when(x >= 0, F.floor(x + 0.5)).otherwise(-F.floor(-x + 0.5)).cast("long")


def from_cents(c, scale: int = 2) -> Column:
    return as_col(c).cast("double") / F.lit(10 ** scale)


def _half_up_div(num: Column, den: Column) -> Column:
    """round(num / den) half away from zero for longs (den > 0), exactly.

    Quotient and remainder are integers throughout, so sums past 2^53 stay exact
    and nothing is doubled that could overflow.
    """
    a = F.abs(num)
    q = F.call_function("div", a, den)
    rest = F.pmod(a, den)
    q = q + F.when(rest >= den - rest, 1).otherwise(0)
    return F.when(num < 0, -q).otherwise(q)


def net_amount(price, discount) -> Column:
    """price * (1 - discount) rounded half-up to cents, exactly."""
    raw = cents(price) * (F.lit(100) - cents(discount))  # units of 1/10000
    return from_cents(_half_up_div(raw, F.lit(100)))


def money_sum(c) -> Column:
    """Exact sum of a 2-decimal column, returned as double."""
    return from_cents(F.sum(cents(c)))


def exact_mean(total_cents, n, scale: int = 2) -> Column:
    """A sum of cents (a long) over a count, rounded half-up to ``scale`` decimals; null without rows."""
    if scale < 2:
        raise ValueError("scale must be >= 2")
    return F.when(as_col(n) > 0, from_cents(_half_up_div(as_col(total_cents) * F.lit(10 ** (scale - 2)), as_col(n)), scale))


def money_mean(c, scale: int = 2) -> Column:
    """Exact mean of a 2-decimal column rounded half-up to ``scale`` decimals."""
    return exact_mean(F.sum(cents(c)), F.count(as_col(c)), scale)
