"""Type conversions. ``strict`` raises on bad text in any session, otherwise bad text is NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = "decimal(38,18)"
"""The source type has no bound: here 20 digits stand before the point, and 18 after it, rounded."""
# What a Java double takes and no other notation does: a type suffix, and hexadecimal digits.
_JAVA_DOUBLE = r"(?i)[0-9.][df]\s*$|x"
_DATED = r"^\s*[+-]?\d{4,}-\d{1,2}-\d{1,2}"


def convert(c: Column, to: str, strict: bool = True, *, good: Column | None = None) -> Column:
    """``c`` as another type; text for which ``good`` does not hold is bad as well."""
    made = c.try_cast(to) if good is None else F.when(good, c.try_cast(to))
    if not strict:
        return made
    failed = F.raise_error(F.concat(F.lit(f"not a {to}: "), c.cast("string"))).cast(to)
    return F.when(c.isNotNull() & made.isNull(), failed).otherwise(made)


def to_float(c: Column) -> Column:
    return c.cast("double")


def to_text(c: Column) -> Column:
    return c.cast("string")


def to_int(c: Column) -> Column:
    """Double to integer, cutting towards zero."""
    return c.cast("bigint")


def parse_int(c: Column, strict: bool = True) -> Column:
    return convert(c, "bigint", strict)


def parse_float(c: Column, strict: bool = True) -> Column:
    return convert(c, "double", strict, good=~c.cast("string").rlike(_JAVA_DOUBLE))


def parse_numeric(c: Column, strict: bool = True) -> Column:
    return convert(c, NUMERIC, strict)


def parse_timestamp(c: Column, strict: bool = True) -> Column:
    """ISO text with a full date to a zone-less timestamp: a written offset is dropped, not applied."""
    return convert(c, "timestamp_ntz", strict, good=c.cast("string").rlike(_DATED))


def type_name(c: Column) -> Column:
    return F.typeof(c)
