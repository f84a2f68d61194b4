"""Exact two-decimal arithmetic.

Spark rounds a decimal quotient to its result scale first and to two places
second, so a plain ``round(avg(x), 2)`` can be one cent off.  Here the
rounding is done once, on integers, half away from zero.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_HUNDREDTH = Decimal("0.01")


def _div(numerator: Column, denominator: Column) -> Column:
    return F.call_function("div", numerator, denominator)


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` to two places; 0.00 where ``whole`` is zero.

    Both are non-negative counts.
    """
    part, whole = part.cast("bigint"), whole.cast("bigint")
    hundredths = _div(part * 20000 + whole, F.nullif(whole * 2, F.lit(0).cast("bigint")))
    return (F.coalesce(hundredths, F.lit(0)).cast("decimal(12,0)") * F.lit(_HUNDREDTH)).cast("decimal(9,2)")


def mean_to_cents(total: Column, n: Column) -> Column:
    """``total / n`` to two places for a decimal total; 0.00 where ``n`` is zero."""
    cents = F.abs(total.cast("decimal(30,2)") * 100).cast("decimal(32,0)")
    count = n.cast("decimal(18,0)")
    magnitude = _div(cents * 2 + count, F.nullif(count * 2, F.lit(0).cast("decimal(20,0)")))
    signed = F.when(total < 0, -magnitude).otherwise(magnitude)
    return (F.coalesce(signed, F.lit(0)).cast("decimal(18,0)") * F.lit(_HUNDREDTH)).cast("decimal(18,2)")
