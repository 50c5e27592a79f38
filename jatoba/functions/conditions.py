"""Ordered conditions: the first true branch wins.

A NULL or NaN input has no label: Spark would send NULL to the default branch and
sorts NaN above every number, so both are caught first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output texts.
ADULT = "Você é maior de idade"
ADULT_ELSE = ("Você é maior de idade!", "Você é menor de idade!")
SUNNY = "ensolarado"
SUNNY_TEXT = "É um bom dia para ir na pracinha"
SIGN = ("O número informado é positivo", "O número informado é negativo")
GRADE_PREFIX = "Sua nota é "
CONCEPT_PREFIX = "Seu conceito é "
GRADE_INVALID = "Favor inserir uma nota valida!"
BMI_PREFIX = ", seu IMC é: "
BMI_DEAD = "Você morreu!"
BMI_LOW = "Você está abaixo do peso."
BMI_NORMAL = "Seu peso está normal."
BMI_HIGH = "Você está com sobrepeso."
BMI_OBESE = "Você esta obeso"
PASSED = "Aprovado"
FAILED_GRADE = "Reprovado por nota"
FAILED_ATTENDANCE = "Reprovado por frequencia"
PASS_MEAN = 7


def ladder(
    inputs: Sequence[Column], branches: Sequence[tuple[Column, Column | str]], default: Column | str
) -> Column:
    """Searched CASE over ``branches`` with a default, NULL when an input is NULL or NaN."""
    unknown = reduce(lambda a, b: a | b, (c.isNull() | F.isnan(c.cast("double")) for c in inputs))
    chain = F.when(unknown, F.lit(None))
    for condition, value in branches:
        chain = chain.when(condition, _value(value))
    return chain.otherwise(_value(default))


def _value(v: Column | str) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def is_adult(age: Column) -> Column:
    return age >= 18


def age_flag(age: Column) -> Column:
    return ladder([age], [(is_adult(age), ADULT_ELSE[0])], ADULT_ELSE[1])


def is_sunny(weather: Column, any_case: bool = False) -> Column:
    return (F.lower(weather) if any_case else weather) == SUNNY


def sign_class(x: Column) -> Column:
    """Zero counts as negative."""
    return ladder([x], [(x > 0, SIGN[0])], SIGN[1])


def grade_band(grade: Column) -> Column:
    """A, B, C by band and D for everything else, also above 100 and below 0."""
    return ladder([grade], _top_bands(grade, GRADE_PREFIX), f"{GRADE_PREFIX}D!")


def grade_band_validated(grade: Column) -> Column:
    """As :func:`grade_band`, with D only for [0, 70) and a message outside [0, 100]."""
    low = ((grade >= 0) & (grade < 70), f"{CONCEPT_PREFIX}D!")
    return ladder([grade], [*_top_bands(grade, CONCEPT_PREFIX), low], GRADE_INVALID)


def _top_bands(grade: Column, prefix: str) -> list[tuple[Column, str]]:
    return [
        (grade.between(90, 100), f"{prefix}A!"),
        ((grade >= 80) & (grade < 90), f"{prefix}B!"),
        ((grade >= 70) & (grade < 80), f"{prefix}C!"),
    ]


def bmi(weight: Column, height: Column) -> Column:
    return weight / F.pow(height, F.lit(2))


def bmi_text(name: Column, value: Column) -> Column:
    return F.concat(name, F.lit(BMI_PREFIX), F.when(value.isNotNull(), F.format_string("%.2f", value)))


def bmi_class(value: Column) -> Column:
    bands = [(value <= 0, BMI_DEAD), (value < 18.5, BMI_LOW), (value < 25, BMI_NORMAL), (value < 40, BMI_HIGH)]
    return ladder([value], bands, BMI_OBESE)


def approval(attendance: Column, grade: Column) -> Column:
    """Attendance decides first; the grade is looked at only inside [75, 100]."""
    by_grade = F.when(grade.between(60, 100), F.lit(PASSED)).otherwise(F.lit(FAILED_GRADE))
    return ladder([attendance, grade], [(attendance.between(75, 100), by_grade)], FAILED_ATTENDANCE)
