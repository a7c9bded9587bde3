"""Exact decimal money arithmetic.

``AVG`` on a DECIMAL rounds to scale+4 before any ``ROUND(..., 2)`` can run,
so a mean just below a half-cent can be pushed onto it and then rounded up.
The helpers here keep sums as integral DECIMAL(38,0) amounts in 1e-8
roubles and round quotients half away from zero with an exact floor, as
``ROUND(numeric, 2)`` does. Spark's integral ``div`` returns BIGINT and
wraps on overflow, so it is not used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts in roubles are summed as integers of this many decimal places.
# salary DECIMAL(18,2) x rate DECIMAL(12,6) has exactly 8.
UNIT_DIGITS = 8
UNIT = 10**UNIT_DIGITS

INT38 = "decimal(38,0)"


def to_units(amount: Column) -> Column:
    """An amount of scale <= 8 as an exact integer count of 1e-8 units."""
    return (amount * F.lit(UNIT)).cast(INT38)


def _floor_div_nonneg(n: Column, d: Column) -> Column:
    """floor(n / d) for integral n >= 0, d > 0, exact.

    The decimal quotient is rounded at scale >= 6, so its floor is the true
    floor or one above it; the product test removes the excess.
    """
    q = F.floor(n / d).cast(INT38)
    return F.when(q * d > n, q - F.lit(1)).otherwise(q).cast(INT38)


def round_quotient(num: Column, den: Column, digits: int = 2) -> Column:
    """ROUND(num / den, digits), half away from zero, for integral decimals.

    NULL if either side is NULL; division by zero raises (ANSI), like the
    reference database.
    """
    n = num.cast(INT38)
    d = den.cast(INT38)
    scale = 10**digits
    two_d = F.abs(d) * F.lit(2)
    mag = _floor_div_nonneg(F.abs(n) * F.lit(2 * scale) + F.abs(d), two_d)
    negative = (n < 0) != (d < 0)
    signed = F.when(negative, -mag).otherwise(mag)
    return (signed / F.lit(scale)).cast(f"decimal(38,{digits})")


def avg_from_units(sum_units: Column, count: Column, digits: int = 2) -> Column:
    """ROUND(AVG(x), digits) from SUM(to_units(x)) and COUNT(x)."""
    return F.when(count > 0, round_quotient(sum_units, count.cast(INT38) * F.lit(UNIT), digits))


def ratio(avg_rounded: Column, max_amount: Column, digits: int = 2) -> Column:
    """ROUND(avg / max, digits) for a rounded average and an amount of scale <= 8."""
    return round_quotient(to_units(avg_rounded), to_units(max_amount), digits)
