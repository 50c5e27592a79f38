"""Ordered conditions over the tables. NULL inputs come from key arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jatoba.functions import conditions as cond
from jatoba.queries.registry import query, table


@query(f"""
SELECT p_partkey, p_size, '{cond.ADULT}' AS texto FROM part WHERE p_size >= 18
""")
def adult_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output only where the condition holds."""
    parts = table(spark, sf_dir, "part").where(cond.is_adult(F.col("p_size")))
    return parts.select("p_partkey", "p_size", F.lit(cond.ADULT).alias("texto"))


@query(f"""
SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_size >= 18 THEN '{cond.ADULT_ELSE[0]}'
                       ELSE '{cond.ADULT_ELSE[1]}' END AS texto
FROM part
""")
def age_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = F.when(F.col("p_partkey") % 10 != 0, F.col("p_size"))
    return table(spark, sf_dir, "part").select("p_partkey", cond.age_flag(age).alias("texto"))


@query(f"""
SELECT c_custkey, clima, clima = 'ensolarado' AS exato, '{cond.SUNNY_TEXT}' AS texto
FROM (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'ensolarado' WHEN 'MACHINERY' THEN 'Ensolarado'
             WHEN 'AUTOMOBILE' THEN 'ENSOLARADO' ELSE c_mktsegment END AS clima FROM customer) t
WHERE lower(clima) = 'ensolarado'
""")
def text_normalized_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text equality, raw and lower-cased."""
    weather = F.expr("""case c_mktsegment when 'BUILDING' then 'ensolarado' when 'MACHINERY' then 'Ensolarado'
                        when 'AUTOMOBILE' then 'ENSOLARADO' else c_mktsegment end""")
    rows = table(spark, sf_dir, "customer").select("c_custkey", weather.alias("clima"))
    sunny = rows.where(cond.is_sunny(F.col("clima"), any_case=True))
    return sunny.select(
        "c_custkey", "clima", cond.is_sunny(F.col("clima")).alias("exato"), F.lit(cond.SUNNY_TEXT).alias("texto")
    )


@query(f"""
SELECT c_custkey, CASE WHEN v IS NULL THEN NULL WHEN v > 0 THEN '{cond.SIGN[0]}' ELSE '{cond.SIGN[1]}' END AS texto
FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 0 ELSE c_acctbal END AS v
      FROM customer) t
""")
def sign_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero counts as negative; NULL and NaN have no label."""
    number = F.expr("""case c_custkey % 20 when 0 then null when 10 then double('NaN') when 1 then 0D when 11 then 0D
                       else c_acctbal end""")
    return table(spark, sf_dir, "customer").select("c_custkey", cond.sign_class(number).alias("texto"))


@query("""
SELECT l_orderkey, l_linenumber, n AS nota,
       concat('Sua nota é ', CASE WHEN n >= 90 AND n <= 100 THEN 'A' WHEN n >= 80 AND n < 90 THEN 'B'
                                  WHEN n >= 70 AND n < 80 THEN 'C' ELSE 'D' END, '!') AS texto
FROM (SELECT l_orderkey, l_linenumber, l_quantity * 2.5 - 10 AS n FROM lineitem) t
""")
def grade_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First grade ladder, with all band edges and values outside [0, 100] (which are D)."""
    grade = F.col("l_quantity") * 2.5 - 10
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", grade.alias("nota"), cond.grade_band(grade).alias("texto")
    )


@query(f"""
SELECT l_orderkey, l_linenumber, n AS nota,
       CASE WHEN n IS NULL THEN NULL WHEN n >= 90 AND n <= 100 THEN 'Seu conceito é A!'
            WHEN n >= 80 AND n < 90 THEN 'Seu conceito é B!' WHEN n >= 70 AND n < 80 THEN 'Seu conceito é C!'
            WHEN n >= 0 AND n < 70 THEN 'Seu conceito é D!' ELSE '{cond.GRADE_INVALID}' END AS texto
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 7 THEN l_quantity * 2.5 - 10 END AS n FROM lineitem) t
""")
def grade_band_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second grade ladder: values outside [0, 100] are refused, NULL stays NULL."""
    grade = F.when(F.col("l_linenumber") != 7, F.col("l_quantity") * 2.5 - 10)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", grade.alias("nota"), cond.grade_band_validated(grade).alias("texto")
    )


@query(f"""
SELECT p_partkey, imc, printf('%s{cond.BMI_PREFIX}%.2f', p_name, imc) AS texto,
       CASE WHEN imc <= 0 THEN '{cond.BMI_DEAD}' WHEN imc > 0 AND imc < 18.5 THEN '{cond.BMI_LOW}'
            WHEN imc >= 18.5 AND imc < 25 THEN '{cond.BMI_NORMAL}' WHEN imc >= 25 AND imc < 40 THEN '{cond.BMI_HIGH}'
            ELSE '{cond.BMI_OBESE}' END AS classe
FROM (SELECT p_partkey, p_name, (p_size - 3) / pow(p_retailprice / 1000, 2) AS imc FROM part) t
""")
def bmi_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Body-mass index, its text and its class, also for weights of zero and less."""
    bmi = cond.bmi(F.col("p_size") - 3, F.col("p_retailprice") / 1000)
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        bmi.alias("imc"),
        cond.bmi_text(F.col("p_name"), bmi).alias("texto"),
        cond.bmi_class(bmi).alias("classe"),
    )


@query(f"""
SELECT l_orderkey, l_linenumber, CASE WHEN f IS NULL OR n IS NULL THEN NULL WHEN f >= 75 AND f <= 100 THEN
           CASE WHEN n >= 60 AND n <= 100 THEN '{cond.PASSED}' ELSE '{cond.FAILED_GRADE}' END
       ELSE '{cond.FAILED_ATTENDANCE}' END AS texto
FROM (SELECT l_orderkey, l_linenumber, 55 + l_quantity AS f,
             CASE WHEN l_linenumber <> 7 THEN 54 + l_linenumber * 2 + l_tax * 500 END AS n FROM lineitem) t
""")
def approval_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance first, then the grade; attendance above 100 fails by attendance."""
    attendance = F.col("l_quantity") + 55
    grade = F.when(F.col("l_linenumber") != 7, F.col("l_linenumber") * 2 + 54 + F.col("l_tax") * 500)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", cond.approval(attendance, grade).alias("texto")
    )
