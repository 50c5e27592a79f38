"""Scalar goldens: every literal with its expected value, and the boundary rows."""

import math
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from jatoba.functions import conditions as cond
from jatoba.functions import convert as conv
from jatoba.functions import geo
from jatoba.functions import numeric as num


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def values(spark, rows, schema, column):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"n int, {schema}")
    return [r["v"] for r in frame.select("n", column.alias("v")).orderBy("n").collect()]


L = F.lit


@pytest.mark.parametrize(
    "column, expected",
    [
        (L(5.887) + L(7.15), 13.036999999999999),
        (num.two_decimals(L(5.887) + L(7.15)), "13.04"),
        (L(154.587) - L(10.548), 144.039),
        (num.two_decimals(L(154.587) - L(10.548)), "144.04"),
        (L(3.57) * L(3), 10.709999999999999),
        (F.round(L(3.57) * L(3), 2), 10.71),
        ((L(2) + L(2)) * (L(2) + L(2)), 16),
        (num.true_divide(L(3), L(2)), 1.5),
        (num.two_decimals(num.true_divide(L(3), L(2))), "1.50"),
        (num.floor_mod(L(10), L(3)), 1),
        (num.floor_div(L(10), L(3)), 3),
        (num.int_power(L(3), L(2)), 9),
        (num.square_root(L(144)), 12.0),
        (conv.to_int(num.square_root(L(144))), 12),
        (L(3) == L(3.0), True),
        (L("verde") == L("Verde"), False),
        (L(3) != L(3.0), False),
        (L(3) > L(2), True),
        (L(3) >= L(3), True),
        (L(2) < L(2), False),
        (L(2) <= L(2), True),
        ((L(3) >= 2) & (L(3) != 2) & (L(3) < 4), True),
        ((L(3) >= 2) | (L(3) == 2) | (L(3) > 4), True),
        ((L(1) >= 2) | (L(3) == 2) | (L(3) > 4), False),
        (conv.to_float(L(10)), 10.0),
        (conv.to_text(L(10)), "10"),
        (conv.to_int(L(10.5)), 10),
        (conv.to_int(L(-10.5)), -10),
        (conv.type_name(conv.to_float(L(10))), "double"),
        (num.floor_div(L(-10), L(3)), -4),
        (num.floor_mod(L(-10), L(3)), 2),
        (num.floor_mod(L(7), L(-3)), -2),
        (num.floor_div(L(7), L(-3)), -3),
        (num.floor_div(L(-7), L(-3)), 2),
        (num.floor_mod(L(-7), L(-3)), -1),
        (num.floor_div_float(L(1.0), L(0.1)), 9.0),
        (num.two_decimals(L(None).cast("double")), None),
        (num.true_divide(L(1), L(0), strict=False), None),
        (num.square_root(L(-1.0), strict=False), None),
        (conv.parse_int(L(" 42 ")), 42),
        (conv.parse_int(L("70.5"), strict=False), None),
        (conv.parse_float(L("70.5")), 70.5),
        (conv.parse_timestamp(L("2023-10-10T10:00:00.000-03:00")), datetime(2023, 10, 10, 10)),
        (conv.parse_timestamp(L("2023-13-45"), strict=False), None),
    ],
)
def test_scalar(spark, column, expected):
    got = value(spark, column)
    assert got == expected and type(got) is type(expected)


@pytest.mark.parametrize(
    "column",
    [
        num.true_divide(L(1), L(0)),
        num.square_root(L(-1.0)),
        conv.parse_int(L("70.5")),
        conv.parse_int(L("abc")),
        conv.parse_float(L("70.5f")),
        conv.parse_float(L("1d")),
        conv.parse_float(L("0x1p3")),
        conv.parse_numeric(L("-23.5.1")),
        conv.parse_timestamp(L("2023-13-45")),
        conv.parse_timestamp(L("2023")),
        geo.latitude(L("-2x,5")),
        geo.longitude(L("-23.5,-4y")),
        num.int_power(L(3), L(40)),
        num.int_power(L(2), L(63)),
        num.int_power(L(2), L(-1)),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_raises_in_any_session(spark, column, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception):
            value(spark, column)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_powers_are_exact(spark):
    rows = [(3, 39), (3, 34), (-3, 39), (2, 62), (-2, 63), (10, 18), (7, 0), (0, 0), (0, 5), (1, 10**12), (-1, 10**12 + 1), (-1, 10**12)]
    got = values(spark, rows, "a bigint, b bigint", num.int_power(F.col("a"), F.col("b")))
    assert got == [1 if a == 1 else (1 if b % 2 == 0 else -1) if a == -1 else a**b for a, b in rows]
    assert value(spark, num.int_power(L(None).cast("bigint"), L(2))) is None


def test_floats_as_text(spark):
    texts = ["70.5f", "1d", "1.D", "0x1p3", "inf", "-Infinity", "NaN", " 1e3 ", ".5", "5."]
    got = values(spark, [(t,) for t in texts], "t string", conv.parse_float(F.col("t"), strict=False))
    assert got[:4] == [None] * 4 and got[4:6] == [math.inf, -math.inf] and math.isnan(got[6]) and got[7:] == [1000.0, 0.5, 5.0]


def test_long_longitudes_are_read_whole(spark):
    assert value(spark, F.length(geo.longitude_text(L("-1,5" + "0" * 20_000)))) == 20_001


def test_floor_pair_matches_plain_operators(spark):
    pairs = [(a, b) for a in (-13, -1, 0, 5, 2**53 + 1, -(2**62)) for b in (-7, -1, 2, 10)]
    a, b = F.col("a"), F.col("b")
    assert values(spark, pairs, "a bigint, b bigint", num.floor_div(a, b)) == [x // y for x, y in pairs]
    assert values(spark, pairs, "a bigint, b bigint", num.floor_mod(a, b)) == [x % y for x, y in pairs]
    floats = [(a, b) for a in (-7.5, 7.5, 1.0, 0.3) for b in (-2.0, 0.1, 2.0)]
    assert values(spark, floats, "a double, b double", num.floor_mod(a, b)) == [x % y for x, y in floats]
    assert values(spark, floats, "a double, b double", num.floor_div_float(a, b)) == [x // y for x, y in floats]


NAN = float("nan")


def test_grade_bands(spark):
    rows = [(x,) for x in (100.0, 90.0, 89.99, 80.0, 70.0, 69.99, 0.0, -1.0, 100.01, None, NAN)]
    first = values(spark, rows, "x double", cond.grade_band(F.col("x")))
    assert first == [f"Sua nota é {g}!" for g in "AABBCDDDD"] + [None, None]
    second = values(spark, rows, "x double", cond.grade_band_validated(F.col("x")))
    invalid = "Favor inserir uma nota valida!"
    assert second == [f"Seu conceito é {g}!" for g in "AABBCDD"] + [invalid, invalid, None, None]


def test_age_sign_and_weather(spark):
    ages = values(spark, [(18,), (17,), (None,)], "x int", cond.age_flag(F.col("x")))
    assert ages == ["Você é maior de idade!", "Você é menor de idade!", None]
    signs = values(spark, [(0.1,), (0.0,), (-1.0,), (None,), (NAN,)], "x double", cond.sign_class(F.col("x")))
    plus, minus = "O número informado é positivo", "O número informado é negativo"
    assert signs == [plus, minus, minus, None, None]
    weather = [("ensolarado",), ("Ensolarado",), ("chuva",)]
    assert values(spark, weather, "x string", cond.is_sunny(F.col("x"))) == [True, False, False]
    assert values(spark, weather, "x string", cond.is_sunny(F.col("x"), any_case=True)) == [True, True, False]


def test_bmi(spark):
    rows = [("Ana", w, h) for w, h in [(51, 1.65), (50, 1.8), (70, 1.75), (90, 1.75), (130, 1.7), (0, 1.7), (-1, 1.7)]]
    bmi = cond.bmi(F.col("w"), F.col("h"))
    classes = values(spark, rows, "n1 string, w int, h double", cond.bmi_class(bmi))
    assert classes == [
        "Seu peso está normal.", "Você está abaixo do peso.", "Seu peso está normal.", "Você está com sobrepeso.",
        "Você esta obeso", "Você morreu!", "Você morreu!",
    ]
    texts = values(spark, rows, "n1 string, w int, h double", cond.bmi_text(F.col("n1"), bmi))
    assert texts == [f"Ana, seu IMC é: {w / h**2:.2f}" for _, w, h in rows]
    edges = values(spark, [(18.5,), (25.0,), (40.0,), (None,), (NAN,)], "x double", cond.bmi_class(F.col("x")))
    assert edges == ["Seu peso está normal.", "Você está com sobrepeso.", "Você esta obeso", None, None]


def test_approval(spark):
    rows = [(75, 60.0), (75, 59.9), (75, 101.0), (74, 100.0), (101, 100.0), (None, 80.0), (80, NAN)]
    got = values(spark, rows, "f int, g double", cond.approval(F.col("f"), F.col("g")))
    grade, attendance = "Reprovado por nota", "Reprovado por frequencia"
    assert got == ["Aprovado", grade, grade, attendance, attendance, None, None]


# (register, coordinate, full, latitude text, longitude text, latitude, longitude, status)
COORDINATES = [
    ("SP, -23.5,-46.6", "z", "-23.5,-46.6", "-23.5", "-46.6", -23.5, -46.6, "ok"),
    ("no comma", "-23.5,-46.6", "-23.5,-46.6", "-23.5", "-46.6", -23.5, -46.6, "ok"),
    (None, "-23.5,-46.6", None, None, None, None, None, "missing"),
    ("a,b", "q", "a,b", None, None, None, None, "missing"),
    ("x", "Lat -23.5,-46.6", "Lat -23.5,-46.6", "-23.5-46.", "-46.6", None, -46.6, "bad_latitude"),
    ("x", "-23.5", "-23.5", "", "-23.5", None, -23.5, "bad_latitude"),
    ("x", "23.5,-46.6", "23.5,-46.6", "-46.6", "-46.6", -46.6, -46.6, "ok"),
    ("x", "-23.5,-46,6", "-23.5,-46,6", "-23.5", "-46.6", -23.5, -46.6, "ok"),
    ("x", "-23,5,-46,6", "-23,5,-46,6", "-23", "5.-46.6", -23.0, None, "bad_longitude"),
    ("x", "23.5,46.6", "23.5,46.6", None, None, None, None, "missing"),
    ("MT-1,2", "q", "-1,2", "-1", "2", -1.0, 2.0, "ok"),
    ("x", "-23.5, -46.6", "-23.5, -46.6", "-23.5", " -46.6", -23.5, -46.6, "ok"),
    ("x", None, None, None, None, None, None, "missing"),
    ("", "-1.5,-2.5", "-1.5,-2.5", "-1.5", "-2.5", -1.5, -2.5, "ok"),
]


def test_coordinate_cases(spark):
    frame = spark.createDataFrame(
        [(i, *c[:2]) for i, c in enumerate(COORDINATES)], "n int, register string, coordinate string"
    ).withColumn("c", geo.full_coordinate(F.col("register"), F.col("coordinate")))
    c = F.col("c")
    rows = frame.select(
        "n", "c", geo.latitude_text(c), geo.longitude_text(c),
        geo.latitude(c, strict=False).cast("double"), geo.longitude(c, strict=False).cast("double"),
        geo.coordinate_status(c),
    ).orderBy("n").collect()
    assert [tuple(r)[1:] for r in rows] == [c[2:] for c in COORDINATES]


@pytest.mark.parametrize("case, reader", [(4, geo.latitude), (5, geo.latitude), (8, geo.longitude)])
def test_bad_coordinate_raises_when_strict(spark, case, reader):
    with pytest.raises(Exception):
        value(spark, reader(geo.full_coordinate(L(COORDINATES[case][0]), L(COORDINATES[case][1]))))


def test_point(spark):
    x, y = L(Decimal("-46.6")), L(Decimal("-23.5"))
    assert value(spark, geo.point(x, y)).asDict() == {"srid": 4326, "x": -46.6, "y": -23.5}
    assert value(spark, geo.point(L(None).cast("double"), y)) is None
