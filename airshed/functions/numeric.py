"""Numeric helpers shared by every mart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rounding goes through a fixed-point decimal so that a half-way value is decided
# on its decimal digits, not on the binary double: round2(1.005) == 1.01, and two
# engines that sum in a different order still agree on the rounded result.
ROUND_DECIMAL = "decimal(28,10)"
WHOLE = 2.0**53  # doubles from here on have no fraction; the decimal holds all below


def round_dp(c: Column | str, places: int) -> Column:
    """ROUND(x, places), half away from zero on the decimal value; NULL stays NULL. A double
    of 2**53 or more in magnitude is a whole number already and stays as it is."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.abs(c) < WHOLE, F.round(c.cast(ROUND_DECIMAL), places).cast("double")).otherwise(c.cast("double"))


def round2(c: Column | str) -> Column:
    """ROUND(x, 2), the rounding used throughout the marts."""
    return round_dp(c, 2)


def ratio(num: Column, den: Column) -> Column:
    """num / NULLIF(den, 0): NULL instead of a divide-by-zero error (ANSI mode)."""
    return num.cast("double") / F.nullif(den, F.lit(0)).cast("double")


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN 1 ELSE 0 END as bigint; a NULL condition gives 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def count_when(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END): rows where cond is true."""
    return F.count(F.when(cond, F.lit(1)))


def percentage(part: Column | str, total: Column | str) -> Column:
    """round(part / NULLIF(total, 0) * 100, 2)."""
    p = F.col(part) if isinstance(part, str) else part
    t = F.col(total) if isinstance(total, str) else total
    return round2(ratio(p, t) * F.lit(100.0))
