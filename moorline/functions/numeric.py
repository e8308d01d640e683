"""Exact numeric helpers (money means, safe division, half-even rounding)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean_cents(sum_cents: str, n: str) -> Column:
    """Mean of money amounts given the column names of their sum in cents and their
    count: one double division, not rounded; NULL when the count is 0 or NULL."""
    return F.expr(f"CASE WHEN {n} > 0 THEN CAST({sum_cents} AS DOUBLE) / ({n} * 100.0D) END")


def round_half_even_binary(num: Column, den: int) -> Column:
    """The quotient of a non-negative integer column and ``den`` (a multiple of 20) as
    a double, rounded to one decimal by the exact value of that double: the nearer
    tenth, the even one if the double lies exactly between two.

    Only quotients half-way between two tenths need the exact value: scaled by a power
    of two the double is an integer, which is compared with the half-way point."""
    tenth = den // 10
    low = F.expr("0").cast("bigint") + F.floor(num / F.lit(tenth)).cast("bigint")
    rest = num - low * tenth
    d = num.cast("double") / F.lit(float(den))
    bits = F.when(d < 32, F.lit(2.0 ** 57)).otherwise(F.lit(2.0 ** 47))
    exact = (d * bits).cast("bigint").cast("decimal(38,0)") * F.lit(20)
    middle = (low * 2 + 1).cast("decimal(19,0)") * bits.cast("decimal(18,0)")
    up = F.when(rest * 2 != tenth, rest * 2 > tenth).otherwise(
        (exact > middle) | ((exact == middle) & (low % 2 == 1)))
    return (low + up.cast("bigint")) / F.lit(10.0)


def safe_div(a: Column, b: Column) -> Column:
    """a / b, NULL when b is 0 or NULL."""
    return a / F.nullif(b, F.lit(0))


def bround_pct(x: Column, places: int = 1) -> Column:
    """Percentage (x * 100) rounded half-to-even like numpy."""
    return F.bround(x * 100, places)
