"""Exact half-up rounding to four decimals.

Rounding a double average depends on summation order and on the binary value of
ties. These helpers divide integers or decimals instead, so a result is the same
under any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numbers of events lie below this. It keeps every average exact: its ten-thousandths fit a bigint.
NUMBER_LIMIT = 1e14


def _int_div(numerator: Column, denominator: Column) -> Column:
    return F.call_function("div", numerator, denominator)


def ratio4(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator for two INT columns, half-up at 4 dp, null where the divisor is 0.

    Both must be non-negative. 2^31 * 20000 fits a bigint, so it stays in long arithmetic.
    """
    top = numerator.cast("bigint") * F.lit(20000).cast("bigint") + denominator.cast("bigint")
    bottom = denominator.cast("bigint") * F.lit(2).cast("bigint")
    return F.when(denominator != 0, _int_div(top, bottom) / F.lit(10000.0))


def quotient4(total: Column, count: Column) -> Column:
    """total / count of aggregated non-negative values, half-up at 4 dp, null where count is 0.

    Works on decimals: a sum of 100 TB of volumes times 20000 would leave the bigint range. The
    quotient must stay below 9e14, as that of numbers below `NUMBER_LIMIT` does; others raise.
    """
    top = total.cast("decimal(32,10)") * F.lit(20000) + count
    return F.when(count != 0, _int_div(top, count * 2) / F.lit(10000.0))


def mean4(value: Column) -> Column:
    """Average of a non-negative numeric column below `NUMBER_LIMIT`, half-up at 4 dp.

    Exact for up to 10 decimals. Larger numbers are set aside by the validation; here they raise.
    """
    part = value.cast("decimal(24,10)")
    return quotient4(F.sum(part), F.count(part))
