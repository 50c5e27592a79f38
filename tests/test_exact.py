"""Exact values of doubles, long integers and point bytes against the interpreter's own."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from jatoba.functions import exact, geo

EDGES = [
    0.0, -0.0, 2.675, 0.125, 1.005, -0.125, 0.375, -0.375, 0.005, 0.015, 0.025, 1e-5, 0.5, 1.5, 2.5, -2.5, 0.994999, 0.995, 99.995, 999.9999,
    5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 2.0**52, 2.0**53, 2.0**53 + 2, 2.0**61 + 512, 2.0**62, 2.0**63, 2.0**64,
    4503599627370495.5, 4503599627370497.5, 1e15 + 0.5, 1e15 + 0.25, 123456789.125, 1e22, 1e23, 1e-23, 180.0, -180.0, 1 / 3, math.pi, 2.0**-400, 2.0**-1000,
]


def doubles(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        x = (
            struct.unpack("<d", rng.randbytes(8))[0], rng.uniform(-1000, 1000), rng.randrange(-(10**6), 10**6) / 1000,
            rng.randrange(-(10**5), 10**5) / 8, rng.uniform(-1, 1) * 2.0 ** rng.randrange(-80, 80), rng.randrange(-(10**7), 10**7) / 2**rng.randrange(20),
        )[k % 6]
        out.append(x if math.isfinite(x) else 0.5)
    return out


def rows(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


@pytest.mark.parametrize("decimals", [0, 1, 2, 6, 15])
def test_rounding_is_that_of_the_exact_value(spark, decimals):
    frame = rows(spark, EDGES + doubles(60_000 if decimals == 2 else 6000, decimals)).select(
        "x", exact.fixed(F.col("x"), decimals).alias("text"), exact.round_exact(F.col("x"), decimals).alias("rounded")
    )
    for x, text, rounded in frame.collect():
        assert text == f"{x:.{decimals}f}", x
        want = float(round(x, decimals))
        assert rounded == want and math.copysign(1, rounded) == math.copysign(1, want), x


def test_odd_doubles_and_bounds(spark):
    frame = spark.createDataFrame([(None,), (math.nan,), (math.inf,), (-math.inf,)], "x double")
    assert [r[0] for r in frame.select(exact.fixed(F.col("x"))).collect()] == [None, "nan", "inf", "-inf"]
    back = [r[0] for r in frame.select(exact.round_exact(F.col("x"), 2)).collect()]
    assert back[0] is None and math.isnan(back[1]) and back[2:] == [math.inf, -math.inf]
    with pytest.raises(ValueError):
        exact.fixed(F.col("x"), 16)


def test_powers_of_two_are_exact(spark):
    frame = spark.range(-1074, 1024).select("id", F.pow(F.lit(2.0), F.col("id")).alias("p"))
    assert all(p == 2.0**n for n, p in frame.collect())


def test_powers_of_integers(spark):
    rng = random.Random(5)
    pairs = [(3, 60), (-7, 41), (0, 0), (0, 5), (1, 10**9), (-1, 10**9 + 1), (-1, 10**18), (2, 63), (2, 64), (-2, 63), (10, 300), (999_999, 40), (-(2**63), 3), (2**63 - 1, 7), (7, 1)]
    pairs += [(rng.randrange(-(10**rng.randrange(1, 18)), 10**5), rng.randrange(0, 40)) for _ in range(200)]
    frame = spark.createDataFrame([*pairs, (None, 2), (2, None)], "b bigint, e bigint")
    for b, e, text in frame.select("b", "e", exact.power_text(F.col("b"), F.col("e"))).collect():
        assert text == (None if b is None or e is None else str(b**e) if abs(b) > 1 else str((b or 0) ** (e % 2 + 2 if e else 0)))
    for b, e in ((2, -1), (3, 10**7)):
        with pytest.raises(Exception, match="out of range"):
            spark.createDataFrame([(b, e)], "b bigint, e bigint").select(exact.power_text(F.col("b"), F.col("e"))).collect()


def test_powers_within_a_decimal_need_no_limbs(spark, monkeypatch):
    monkeypatch.setattr(exact, "multiplied", lambda a, b: F.raise_error(F.lit("limbs")).cast("array<bigint>"))
    pairs = [(b, e) for b in (*range(-12, 13), 997, 46341, -999_999, 2**31, 94_906_265) for e in range(60) if len(str(abs(b) ** e)) < 37]
    pairs = [(b, e) for b, e in pairs if abs(b) ** -(-e // 3) < 2**53]
    frame = spark.createDataFrame(pairs, "b bigint, e bigint")
    for b, e, text in frame.select("b", "e", exact.power_text(F.col("b"), F.col("e"))).collect():
        assert text == str(b**e), (b, e)


def test_point_bytes(spark):
    values = EDGES + doubles(3000, 9)
    pairs = list(zip(values, reversed(values))) + [(math.inf, -math.inf), (None, 1.0), (1.0, None)]
    frame = spark.createDataFrame(pairs, "x double, y double")
    made = frame.select("x", "y", exact.point_wkb(F.col("x"), F.col("y")).alias("wkb"))
    for x, y, wkb, back in made.select("x", "y", "wkb", exact.point_of_wkb(F.col("wkb"))).collect():
        if x is None or y is None:
            assert wkb is None and back is None
        else:
            assert bytes(wkb) == struct.pack("<BIdd", 1, 1, x, y)
            assert struct.pack("<dd", *back) == struct.pack("<dd", x, y)
    with pytest.raises(Exception, match="not a point"):
        spark.sql("select X'00' w").select(exact.point_of_wkb(F.col("w"))).collect()
    nan = spark.sql("select double('nan') x").select(exact.double_bits(F.col("x"))).first()[0]
    assert nan == 0x7FF8 << 48
    located = spark.sql("select decimal(-46.6) x, decimal(-23.5) y").select(geo.point(F.col("x"), F.col("y")).alias("p"))
    assert located.select(exact.point_wkb(F.col("p.x"), F.col("p.y"))).first()[0]


def test_points_are_made_without_interpreted_lambdas(spark):
    frame = spark.createDataFrame([(1.5, -2.0)], "x double, y double")
    made = frame.select(exact.point_wkb(F.col("x"), F.col("y")).alias("wkb"), exact.double_bits(F.col("x")))
    assert "lambda" not in made._jdf.queryExecution().optimizedPlan().toString()
