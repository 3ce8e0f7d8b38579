"""Exact half-even rounding on integer numerators and denominators.

``avg(decimal)`` rounds to six places first and ``bround`` would then round a
second time, which turns near-ties into false ties.  Working in integer cents
(or tenths of a percent) with quotient and remainder is exact, and the same
formula runs unchanged in DuckDB on ``hugeint``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT38 = "decimal(38,0)"


def half_even_div(num: Column, den: Column) -> Column:
    """round_half_even(num / den) for integral ``num >= 0`` and ``den > 0``.

    The quotient is formed as ``(num - r) / den``, which divides exactly, so no
    64-bit ``div`` overflow is possible for decimal inputs.
    """
    num = num.cast(INT38)
    den = den.cast(INT38)
    r = F.pmod(num, den)
    q = ((num - r) / den).cast(INT38)
    bump = (r * 2 > den) | ((r * 2 == den) & (F.pmod(q, F.lit(2)) == 1))
    return (q + F.when(bump, 1).otherwise(0)).cast(INT38)


def _cents(amount: Column) -> Column:
    return (amount * 100).cast(INT38)


def avg_half_even(total: Column, count: Column) -> Column:
    """Mean of decimal amounts, half-even to 0.01, as ``decimal(38,2)``."""
    q = half_even_div(_cents(total), count)
    return (q / 100).cast("decimal(38,2)")


def share_half_even(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` half-even to 0.1, as ``decimal(5,1)``."""
    tenths = half_even_div(_cents(part) * 1000, _cents(whole))
    return (tenths / 10).cast("decimal(5,1)")
