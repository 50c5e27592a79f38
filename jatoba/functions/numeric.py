"""Arithmetic where Spark and the source notebooks differ.

``+``, ``-``, ``*`` and the comparison and logical operators need no helper: use
the Column operators.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jatoba.functions import exact


def true_divide(a: Column, b: Column, strict: bool = True) -> Column:
    """``a / b`` as double; division by zero raises, or gives NULL when not strict."""
    failed = F.raise_error(F.lit("division by zero")) if strict else F.lit(None)
    return F.when(b == 0, failed.cast("double")).otherwise(F.try_divide(a, b))


def floor_mod(a: Column, b: Column) -> Column:
    """Remainder with the sign of the divisor (Spark's ``%`` takes the dividend's)."""
    rest = a % b
    return F.when((rest != 0) & ((rest < 0) != (b < 0)), rest + b).otherwise(rest)


def floor_div(a: Column, b: Column) -> Column:
    """Integer quotient rounded towards minus infinity, exact over the bigint range."""
    quotient = F.call_function("div", a, b)
    rest = a % b
    return F.when((rest != 0) & ((rest < 0) != (b < 0)), quotient - 1).otherwise(quotient)


def floor_div_float(a: Column, b: Column) -> Column:
    """Floored quotient of doubles, taken from the exact remainder so that 1.0 // 0.1 is 9."""
    return F.round((a - floor_mod(a, b)) / b, 0)


def int_power(base: Column, exponent: Column) -> Column:
    """Power of two integers, exact as bigint; one that has no room there raises, as does a negative exponent.

    :func:`exact.power_text` gives the digits of longer ones.
    """
    base, exponent = base.cast("bigint"), exponent.cast("bigint")
    # With |base| > 1 the result has no room from exponent 64 on, so no longer product is formed.
    steps = F.sequence(F.lit(1).cast("bigint"), F.least(exponent, F.lit(64).cast("bigint")))
    product = F.aggregate(steps, F.lit(1).cast("bigint"), lambda so_far, _: F.try_multiply(so_far, base))
    even = F.pmod(exponent, F.lit(2)) == 0
    result = (
        F.when(exponent == 0, F.lit(1).cast("bigint"))
        .when(base.isin(0, 1), base)
        .when(base == -1, F.when(even, -base).otherwise(base))
        .when(exponent > 0, product)
    )
    failed = F.raise_error(F.lit("power out of range")).cast("bigint")
    return F.when(base.isNotNull() & exponent.isNotNull() & ((exponent < 0) | result.isNull()), failed).otherwise(result)


def square_root(x: Column, strict: bool = True) -> Column:
    """Square root; a negative input raises, or gives NULL when not strict."""
    failed = F.raise_error(F.lit("square root of a negative number")) if strict else F.lit(None)
    return F.when(x < 0, failed).otherwise(F.sqrt(x))


def two_decimals(x: Column) -> Column:
    """Text with two decimals, by the exact value of the double and halves to even; NULL stays NULL."""
    return exact.fixed(x, 2)
