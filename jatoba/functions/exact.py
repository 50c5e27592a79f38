"""The exact value of a double, integers without a bound, and the bytes of a point.

A double is an integer times a power of two. Both are found here by column arithmetic that loses nothing, so
that ``round`` and ``%.nf`` can round the value that is there and not the digits it is shown with. Integers
beyond 64 bits are arrays of six-digit limbs, the least first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(38,0)"
MOST_DECIMALS = 15
LIMB = 10**6
LIMB_DIGITS = 6
MOST_DIGITS = 100_000
"""Digits of the longest power that is worked out."""


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _bits(n: Column) -> Column:
    """Two to the power of 0 to 62."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n.cast("int"))


def scaled(x: Column) -> Column:
    """``struct<m bigint, e int>`` with ``|x| = m * 2 ** e`` exactly, for a finite double; ``m`` is below 2 ** 55.

    The logarithm may be off by one, so one bit more than the 53 is taken; below 2 ** -400 the
    number is first scaled up, since the power that brings it there would overflow.
    """
    size = F.abs(x.cast("double"))
    lift = F.when(size < F.lit(2.0**-400), F.lit(700)).otherwise(F.lit(0))

    def parts(lifted: Column) -> Column:
        return _let(
            F.struct(lifted.alias("value"), F.floor(F.log2(lifted)).cast("int").alias("k")),
            lambda s: F.struct(
                (s["value"] * F.pow(F.lit(2.0), F.lit(53) - s["k"])).cast("bigint").alias("m"),
                (s["k"] - F.lit(53) - lift).alias("e"),
            ),
        )

    zero = F.struct(F.lit(0).cast("bigint").alias("m"), F.lit(0).alias("e"))
    return F.when(size == 0, zero).otherwise(parts(size * F.pow(F.lit(2.0), lift)))


def _negative(x: Column) -> Column:
    return x.cast("double").cast("string").startswith("-")


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def _rounded(x: Column, decimals: int) -> Column:
    """``struct<whole decimal(38,0), part bigint>``: ``|x|`` at so many decimals, halves to even; for ``|x|`` below 2 ** 62."""
    unit = 10**decimals

    def split(s: Column) -> Column:
        k = -s["e"]
        whole = F.when(k > 62, F.lit(0).cast("bigint")).when(k > 0, F.call_function("shiftright", s["m"], k)).otherwise(
            F.call_function("shiftleft", s["m"], s["e"])
        )
        rest = F.when(k > 62, s["m"]).when(k > 0, s["m"].bitwiseAND(_bits(k) - 1)).otherwise(F.lit(0).cast("bigint"))
        return F.struct(whole.alias("whole"), rest.alias("rest"), k.alias("k"))

    def part(s: Column) -> Column:
        # Beyond 2 ** -126 nothing is left at MOST_DECIMALS decimals.
        power = _bits(F.least(s["k"], F.lit(42))).cast(WIDE)
        for more in (42, 84):
            power = (power * _bits(F.greatest(F.lit(0), F.least(s["k"] - more, F.lit(42)))).cast(WIDE)).cast(WIDE)
        return _let(
            F.struct((s["rest"].cast(WIDE) * F.lit(unit).cast("decimal(16,0)")).cast(WIDE).alias("a"), power.alias("b")),
            lambda t: _let(
                F.struct(F.call_function("div", t["a"], t["b"]).alias("q"), (t["a"] % t["b"]).cast(WIDE).alias("r"), t["b"].alias("b")),
                lambda u: u["q"]
                + F.when((u["r"] > u["b"] - u["r"]) | ((u["r"] == u["b"] - u["r"]) & (u["q"] % 2 == 1)), F.lit(1)).otherwise(F.lit(0)),
            ),
        )

    def carried(s: Column) -> Column:
        fraction = F.when((s["k"] > 0) & (s["k"] <= 126), part(s)).otherwise(F.lit(0).cast("bigint"))
        if decimals == 0:
            # The one before the point decides which of two halves is even.
            tie = (s["k"] > 0) & (s["k"] <= 62) & (s["rest"] == _bits(s["k"] - 1)) & (s["whole"] % 2 == 1)
            up = F.when(tie, F.lit(1).cast("bigint")).otherwise(fraction)
            return F.struct((s["whole"] + up).alias("whole"), F.lit(0).cast("bigint").alias("part"))
        return _let(
            fraction,
            lambda q: F.struct(
                (s["whole"] + F.when(q == unit, 1).otherwise(0)).alias("whole"), F.when(q == unit, 0).otherwise(q).alias("part")
            ),
        )

    return _let(_let(scaled(x), split), carried)


def fixed(x: Column, decimals: int = 2) -> Column:
    """Text with so many decimals, as ``%.nf`` of the double's exact value, halves to even; ``nan``, ``inf`` and ``-inf`` as they are."""
    _check(decimals)
    size, sign = F.abs(x), F.when(_negative(x), F.lit("-")).otherwise(F.lit(""))

    def shown(s: Column) -> Column:
        part = F.concat(F.lit("."), F.lpad(s["part"].cast("string"), decimals, "0")) if decimals else F.lit("")
        return F.concat(sign, s["whole"].cast("string"), part)

    def large(s: Column) -> Column:
        return F.concat(sign, limbs_text(_doubled(limbs(s["m"]), s["e"])), F.lit("." + "0" * decimals if decimals else ""))

    # Away from the middle between two results, by far more than the error of the product, shown digits and exact value agree.
    moved = size * F.lit(10.0**decimals)
    plain = (moved < F.lit(1e9)) & (F.abs(moved - F.floor(moved) - F.lit(0.5)) > F.lit(1e-6))
    text = (
        F.when(plain, F.format_string(f"%.{decimals}f", x.cast("double")))
        .when(size < F.lit(2.0**62), _let(_rounded(x, decimals), shown))
        .otherwise(_let(scaled(x), large))
    )
    endless = F.when(F.isnan(x), F.lit("nan")).otherwise(F.concat(sign, F.lit("inf")))
    return F.when(x.isNotNull(), F.when(_finite(x), text).otherwise(endless))


def round_exact(x: Column, decimals: int = 0) -> Column:
    """``round(x, n)`` of the double's exact value, halves to even, as the double nearest to the result."""
    _check(decimals)
    near = F.abs(x) < F.lit(2.0**53)
    return F.when(near, fixed(x, decimals).cast("double")).otherwise(x.cast("double"))


def _check(decimals: int) -> None:
    if not 0 <= decimals <= MOST_DECIMALS:
        raise ValueError(f"0 to {MOST_DECIMALS} decimals")


def limbs(n: Column) -> Column:
    """A bigint that is not negative as limbs."""
    text = n.cast("string")
    padded = F.lpad(text, 24, "0")
    every = F.array(*[F.substring(padded, start, LIMB_DIGITS).cast("bigint") for start in (19, 13, 7, 1)])
    return _trimmed(every)


def _trimmed(digits: Column) -> Column:
    """Without the zeros in front, but for one."""
    used = F.aggregate(digits, F.struct(F.lit(0).alias("at"), F.lit(1).alias("used")), lambda s, x: F.struct(
        (s["at"] + 1).alias("at"), F.when(x != 0, s["at"] + 1).otherwise(s["used"]).alias("used")), lambda s: s["used"])
    return F.slice(digits, F.lit(1), used)


def limbs_text(digits: Column) -> Column:
    """The decimal digits of limbs."""
    first = F.element_at(digits, -1).cast("string")
    rest = F.transform(F.reverse(F.slice(digits, F.lit(1), F.size(digits) - 1)), lambda x: F.lpad(x.cast("string"), LIMB_DIGITS, "0"))
    return F.concat(first, F.array_join(rest, ""))


def _carried(sums: Column) -> Column:
    """Limbs from sums of products, each of them far below 2 ** 63."""
    nothing = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("carry"))

    def go(s: Column, x: Column) -> Column:
        return _let(
            x + s["carry"],
            lambda v: F.struct(F.concat(s["out"], F.array(v % LIMB)).alias("out"), F.call_function("div", v, F.lit(LIMB)).alias("carry")),
        )

    # What is carried beyond the last sum has at most three limbs.
    return _trimmed(F.aggregate(F.concat(sums, F.array(*[F.lit(0).cast("bigint")] * 3)), nothing, go, lambda s: s["out"]))


def multiplied(a: Column, b: Column) -> Column:
    """The product of two numbers in limbs."""

    def sums(s: Column) -> Column:
        a, b = s["a"], s["b"]

        def place(k: Column) -> Column:
            terms = F.sequence(F.greatest(F.lit(0), k - F.size(b) + 1), F.least(k, F.size(a) - 1))
            return F.aggregate(terms, F.lit(0).cast("bigint"), lambda so_far, i: so_far + F.get(a, i) * F.get(b, k - i))

        return _carried(F.transform(F.sequence(F.lit(0), F.size(a) + F.size(b) - 2), place))

    return _let(F.struct(a.alias("a"), b.alias("b")), sums)


def _doubled(digits: Column, times: Column) -> Column:
    """Limbs times a power of two, eighteen bits a step."""
    steps = F.when(times > 0, F.sequence(F.lit(0), times - 1, F.lit(18))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(
        steps, digits, lambda so_far, done: _carried(F.transform(so_far, lambda x: x * _bits(F.least(F.lit(18), times - done))))
    )


SHORT_DIGITS = 37
"""Digits up to which a power is surely within a decimal."""


def _short_power(size: Column, exponent: Column) -> Column:
    """A power of at most SHORT_DIGITS digits, from three factors that doubles hold exactly; NULL if a factor is too large for that.

    ``pow`` of two integers is exact wherever the result is a double.
    """
    thirds = [F.call_function("div", exponent + more, F.lit(3).cast("bigint")) for more in (2, 1, 0)]
    first, second, third = (F.pow(size.cast("double"), n).cast("bigint").cast("decimal(16,0)") for n in thirds)
    near = F.pow(size.cast("double"), thirds[0]) < F.lit(2.0**53)
    return F.when(near, (first * second * third).cast("string"))


def power_text(base: Column, exponent: Column) -> Column:
    """The digits of an integer power, however many; a negative exponent, or more than MOST_DIGITS digits, raises.

    Powers within a decimal are a product of decimals, longer ones are squared in limbs.
    """
    base, exponent = base.cast("bigint"), exponent.cast("bigint")
    size = limbs(F.abs(base.cast("decimal(20,0)")))
    bits = F.bin(exponent)
    digits = F.transform(F.sequence(F.lit(1), F.length(bits)), lambda i: F.substr(bits, i, F.lit(1)) == "1")

    def go(so_far: Column, one: Column) -> Column:
        return _let(multiplied(so_far, so_far), lambda square: F.when(one, multiplied(square, size)).otherwise(square))

    one = F.array(F.lit(1).cast("bigint"))
    raised = limbs_text(F.aggregate(digits, one, go))
    sign = F.when((base < 0) & (exponent % 2 == 1), F.lit("-")).otherwise(F.lit(""))
    length = exponent.cast("double") * F.log10(F.greatest(F.abs(base.cast("double")), F.lit(1.0)))
    short = F.when(length < SHORT_DIGITS, _short_power(F.abs(base.cast("double")), exponent))
    failed = F.raise_error(F.lit("power out of range")).cast("string")
    result = (
        F.when((exponent < 0) | (length > MOST_DIGITS), failed)
        .when(base.isin(0, 1, -1), F.when((base == 0) & (exponent > 0), F.lit("0")).otherwise(F.concat(sign, F.lit("1"))))
        .otherwise(F.concat(sign, F.coalesce(short, raised)))
    )
    return F.when(base.isNotNull() & exponent.isNotNull(), result)


def double_bits(x: Column) -> Column:
    """The 64 bits of a double as a bigint; any NaN has the usual one's."""
    return F.when(x.isNotNull(), _of_java("Double", "doubleToLongBits", x.cast("double")).cast("bigint"))


def _of_java(kind: str, method: str, value: Column) -> Column:
    """The text of a number's static method; the value must not be NULL."""
    return F.java_method(F.lit(f"java.lang.{kind}"), F.lit(method), value)


def _swapped(bits: Column) -> Column:
    """A bigint with its bytes in reverse."""
    return _of_java("Long", "reverseBytes", bits).cast("bigint")


def point_wkb(x: Column, y: Column) -> Column:
    """The 21 bytes of a point in well-known binary, little-endian; NULL if either is NULL."""

    def little_endian(c: Column) -> Column:
        return F.lpad(F.hex(_swapped(double_bits(c))), 16, "0")

    whole = F.when(x.isNotNull() & y.isNotNull(), F.concat(F.lit("0101000000"), little_endian(x), little_endian(y)))
    return F.unhex(whole)


def point_of_wkb(wkb: Column) -> Column:
    """``struct<x double, y double>`` of such bytes; other bytes raise."""

    def number(start: int) -> Column:
        bits = F.conv(F.hex(F.substring(wkb, start, 8)), 16, -10).cast("bigint")
        return _of_java("Double", "longBitsToDouble", _swapped(bits)).cast("double")

    good = (F.octet_length(wkb) == 21) & (F.hex(F.substring(wkb, 1, 5)) == "0101000000")
    failed = F.raise_error(F.lit("not a point")).cast("struct<x: double, y: double>")
    return F.when(wkb.isNotNull(), F.when(good, F.struct(number(6).alias("x"), number(14).alias("y"))).otherwise(failed))
