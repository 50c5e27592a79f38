"""Free-text coordinates to SRID-4326 points.

The rules follow the source system to the letter, odd cases included: the latitude
uses a position as a length, and every comma after the first becomes a dot.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jatoba.functions.convert import parse_numeric
from jatoba.schemas import SRID


def full_coordinate(rural_register: Column, coordinate: Column) -> Column:
    """The register from its first dash on; a register without comma gives ``coordinate``.

    A NULL register gives NULL: it does not fall back.
    """
    from_dash = F.substr(rural_register, F.instr(rural_register, "-"))
    return F.when(F.instr(rural_register, ",") == 0, coordinate).otherwise(from_dash)


def latitude_text(c: Column) -> Column:
    dash, comma = F.instr(c, "-"), F.instr(c, ",")
    return F.when(dash != 0, F.replace(F.substr(c, dash, comma), F.lit(","), F.lit("")))


def longitude_text(c: Column) -> Column:
    rest = F.substr(c, F.instr(c, ",") + 1)
    return F.when(F.instr(c, "-") != 0, F.replace(rest, F.lit(","), F.lit(".")))


def latitude(c: Column, strict: bool = True) -> Column:
    return parse_numeric(latitude_text(c), strict)


def longitude(c: Column, strict: bool = True) -> Column:
    return parse_numeric(longitude_text(c), strict)


def coordinate_status(c: Column) -> Column:
    """``ok``, ``missing``, ``bad_latitude`` or ``bad_longitude``, to quarantine lenient loads."""
    return (
        F.when(latitude_text(c).isNull(), "missing")
        .when(latitude(c, strict=False).isNull(), "bad_latitude")
        .when(longitude(c, strict=False).isNull(), "bad_longitude")
        .otherwise("ok")
    )


def point(x: Column, y: Column) -> Column:
    """``struct<srid, x, y>`` with x = longitude and y = latitude; NULL if either is NULL."""
    return F.when(
        x.isNotNull() & y.isNotNull(),
        F.struct(F.lit(SRID).alias("srid"), x.cast("double").alias("x"), y.cast("double").alias("y")),
    )
