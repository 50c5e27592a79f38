"""Arithmetic, comparison, logic and conversion as column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jatoba.functions import convert, exact, numeric
from jatoba.queries.registry import query, table


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice + l_tax AS soma, l_extendedprice - l_quantity AS sub,
       l_discount * 3 AS multi, (l_linenumber + 2) * (l_linenumber + 2) AS paren, l_linenumber / 2 AS div,
       l_extendedprice / nullif(l_linenumber - 1, 0) AS div_lenient
FROM lineitem
""")
def arithmetic_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, number = F.col("l_extendedprice"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        number,
        (price + F.col("l_tax")).alias("soma"),
        (price - F.col("l_quantity")).alias("sub"),
        (F.col("l_discount") * 3).alias("multi"),
        ((number + 2) * (number + 2)).alias("paren"),
        numeric.true_divide(number, F.lit(2)).alias("div"),
        numeric.true_divide(price, number - 1, strict=False).alias("div_lenient"),
    )


@query("""
WITH t AS (SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS n, c_acctbal AS v FROM customer)
SELECT c_custkey, n - 7 * CAST(floor(n / 7) AS BIGINT) AS mod_pos, n + 7 * CAST(floor(n / -7) AS BIGINT) AS mod_neg,
       CAST(floor(n / 7) AS BIGINT) AS div_pos, CAST(floor(n / -7) AS BIGINT) AS div_neg,
       CASE WHEN v % 2.5::DOUBLE < 0 THEN v % 2.5::DOUBLE + 2.5 ELSE v % 2.5::DOUBLE END AS mod_double,
       floor(v / 2.5) AS div_double
FROM t
""")
def floored_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotient and remainder rounded towards minus infinity, with both signs of the divisor."""
    whole, amount = convert.to_int(F.col("c_acctbal")), F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        numeric.floor_mod(whole, F.lit(7)).alias("mod_pos"),
        numeric.floor_mod(whole, F.lit(-7)).alias("mod_neg"),
        numeric.floor_div(whole, F.lit(7)).alias("div_pos"),
        numeric.floor_div(whole, F.lit(-7)).alias("div_neg"),
        numeric.floor_mod(amount, F.lit(2.5)).alias("mod_double"),
        numeric.floor_div_float(amount, F.lit(2.5)).alias("div_double"),
    )


@query("""
SELECT p_partkey, CAST(pow(p_size, 2) AS BIGINT) AS pot, pow(p_retailprice, 2) AS pot_double, sqrt(p_size) AS raiz,
       CAST(trunc(sqrt(p_size)) AS BIGINT) AS raiz_int, round(p_size * CAST(3.57 AS DOUBLE), 2) AS multi,
       printf('%.2f', p_retailprice / 7) AS texto
FROM part
""")
def power_sqrt_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, price = F.col("p_size"), F.col("p_retailprice")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        numeric.int_power(size, F.lit(2)).alias("pot"),
        F.pow(price, F.lit(2)).alias("pot_double"),
        numeric.square_root(size).alias("raiz"),
        convert.to_int(numeric.square_root(size)).alias("raiz_int"),
        exact.round_exact(size * 3.57, 2).alias("multi"),
        numeric.two_decimals(price / 7).alias("texto"),
    )


# Eighths, thousandths and sixteenths: ties by the exact value, ties only by the shown digits, and neither.
_TIES = "l_extendedprice / 1000 AS small, (l_orderkey % 4001 - 2000) / 8.0::DOUBLE AS eighth, (l_orderkey % 20011) / 1000.0::DOUBLE AS shown"


@query(f"""
SELECT l_orderkey, l_linenumber, printf('%.2f', small) AS small_text, printf('%.2f', eighth) AS eighth_text, printf('%.2f', shown) AS shown_text,
       CAST(printf('%.2f', eighth) AS DOUBLE) AS eighth_rounded, CAST(printf('%.1f', shown) AS DOUBLE) AS shown_rounded
FROM (SELECT l_orderkey, l_linenumber, {_TIES} FROM lineitem)
""")
def exact_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounding of doubles that lie on a tie, or seem to."""
    key = F.col("l_orderkey")
    eighth, shown = (key % 4001 - 2000) / F.lit(8.0), (key % 20011) / F.lit(1000.0)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        exact.fixed(F.col("l_extendedprice") / 1000).alias("small_text"),
        numeric.two_decimals(eighth).alias("eighth_text"),
        numeric.two_decimals(shown).alias("shown_text"),
        exact.round_exact(eighth, 2).alias("eighth_rounded"),
        exact.round_exact(shown, 1).alias("shown_rounded"),
    )


@query("""
SELECT o_orderkey, CAST(CAST(list_reduce(list_prepend(CAST(1 AS HUGEINT), list_transform(range(o_orderkey % 38), lambda i: CAST(o_custkey % 19 - 9 AS HUGEINT))),
       lambda a, b: a * b) AS HUGEINT) AS VARCHAR) AS power
FROM orders
""")
def long_powers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer powers of up to 36 digits, most of them beyond 64 bits."""
    base, exponent = F.col("o_custkey") % 19 - 9, F.col("o_orderkey") % 38
    return table(spark, sf_dir, "orders").select("o_orderkey", exact.power_text(base, exponent).alias("power"))


def _reversed_bytes(column: str) -> str:
    text = f"hex(CAST(CAST({column} AS BIT) AS BLOB))"
    return " || ".join(f"substr({text}, {start}, 2)" for start in range(15, 0, -2))


@query(f"""
SELECT c_custkey, '0101000000' || {_reversed_bytes("x")} || {_reversed_bytes("y")} AS wkb, x, y
FROM (SELECT c_custkey, CAST(c_acctbal AS DOUBLE) / 7 AS x, -1 / (CAST(c_custkey AS DOUBLE) + 1) AS y FROM customer)
""")
def point_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points as well-known binary, and back."""
    points = table(spark, sf_dir, "customer").select(
        "c_custkey", exact.point_wkb(F.col("c_acctbal") / 7, F.lit(-1.0) / (F.col("c_custkey") + 1)).alias("wkb")
    )
    back = exact.point_of_wkb(F.col("wkb"))
    return points.select("c_custkey", F.hex("wkb").alias("wkb"), back["x"].alias("x"), back["y"].alias("y"))


@query("""
SELECT l_orderkey, l_linenumber, l_linenumber = l_quantity AS igual, l_linenumber <> l_quantity AS diferente,
       l_returnflag = 'a' AS texto, l_quantity > 25 AS maior, l_quantity >= 25 AS maior_igual, l_quantity < 25 AS menor,
       l_quantity <= 25 AS menor_igual
FROM lineitem
""")
def comparison_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer against double, text with its case, and the four orders."""
    number, quantity = F.col("l_linenumber"), F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        number,
        (number == quantity).alias("igual"),
        (number != quantity).alias("diferente"),
        (F.col("l_returnflag") == "a").alias("texto"),
        (quantity > 25).alias("maior"),
        (quantity >= 25).alias("maior_igual"),
        (quantity < 25).alias("menor"),
        (quantity <= 25).alias("menor_igual"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_quantity >= 2 AND l_quantity <> 3 AND l_quantity < 40 AS e,
       l_tax >= 0.02 AND l_returnflag = 'R' AS e_bool, l_quantity >= 45 OR l_linenumber = 3 OR l_tax > 0.06 AS ou,
       l_quantity = 2 OR l_linestatus = 'O' AS ou_bool
FROM lineitem
""")
def logical_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity, number, tax = F.col("l_quantity"), F.col("l_linenumber"), F.col("l_tax")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        number,
        ((quantity >= 2) & (quantity != 3) & (quantity < 40)).alias("e"),
        ((tax >= 0.02) & (F.col("l_returnflag") == "R")).alias("e_bool"),
        ((quantity >= 45) | (number == 3) | (tax > 0.06)).alias("ou"),
        ((quantity == 2) | (F.col("l_linestatus") == "O")).alias("ou_bool"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_linenumber + 1 AS t, l_quantity - 2 AS z, l_linenumber * 2 AS j,
       (l_linenumber * 2 + 5) % 3 AS b
FROM lineitem
""")
def updated_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column updated step by step."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_linenumber").alias("t"),
        F.col("l_quantity").alias("z"),
        F.col("l_linenumber").alias("j"),
    )
    lines = lines.withColumn("t", F.col("t") + 1).withColumn("z", F.col("z") - 2).withColumn("j", F.col("j") * 2)
    return lines.withColumn("b", F.col("j") + 5).withColumn("b", numeric.floor_mod(F.col("b"), F.lit(3)))


@query("""
SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS DOUBLE) AS para_float, CAST(l_orderkey AS VARCHAR) AS para_texto,
       CAST(trunc(l_quantity * 1.5 - 30.25) AS BIGINT) AS para_int, 'int' AS tipo_antes, 'double' AS tipo_float,
       'string' AS tipo_texto, 'bigint' AS tipo_int
FROM lineitem
""")
def cast_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversions between numbers and text; doubles are cut towards zero, negative ones too."""
    number = F.col("l_linenumber")
    as_float, as_text = convert.to_float(number), convert.to_text(F.col("l_orderkey"))
    as_int = convert.to_int(F.col("l_quantity") * 1.5 - 30.25)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        number,
        as_float.alias("para_float"),
        as_text.alias("para_texto"),
        as_int.alias("para_int"),
        convert.type_name(number).alias("tipo_antes"),
        convert.type_name(as_float).alias("tipo_float"),
        convert.type_name(as_text).alias("tipo_texto"),
        convert.type_name(as_int).alias("tipo_int"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey END AS lenient_int,
       CASE WHEN o_orderkey % 4 < 2 THEN CAST(o_orderkey AS DOUBLE)
            WHEN o_orderkey % 4 = 2 THEN o_orderkey + 0.5::DOUBLE END AS lenient_float,
       o_custkey AS strict_int, CAST(o_custkey AS DOUBLE) AS strict_float
FROM orders
""")
def typed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to numbers: plain, with blanks, with decimals, not a number."""
    text = F.expr("""case o_orderkey % 4 when 0 then cast(o_orderkey as string) when 1 then concat(' ', o_orderkey, ' ')
                     when 2 then concat(o_orderkey, '.5') else concat('n', o_orderkey) end""")
    good = F.concat(F.lit(" "), F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        convert.parse_int(text, strict=False).alias("lenient_int"),
        convert.parse_float(text, strict=False).alias("lenient_float"),
        convert.parse_int(good).alias("strict_int"),
        convert.parse_float(good).alias("strict_float"),
    )
