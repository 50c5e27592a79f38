"""Joins, aggregations, coordinates and points."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jatoba.functions import convert, geo
from jatoba.functions.conditions import PASS_MEAN
from jatoba.operators.joins import (
    MIN_HOT_ROWS,
    find_hot_keys,
    lookup_left_join,
    merge_left,
    skew_safe_join,
    sliced_join,
    with_spread,
)
from jatoba.operators.pivot import eav_pivot
from jatoba.plans.gold import map_lookup, task_counts
from jatoba.queries.registry import query, table

AS_OF = datetime(2024, 1, 2, 3, 4, 5)


@query("""
SELECT user_id, max(CASE WHEN event_type = 'signup' THEN props || '#' || event_id END) AS signup,
       max(CASE WHEN event_type = 'purchase' THEN props || '#' || event_id END) AS purchase,
       max(CASE WHEN event_type = 'view' THEN props || '#' || event_id END) AS "view",
       max(CASE WHEN event_type = 'click' THEN props || '#' || event_id END) AS click,
       max(CASE WHEN event_type = 'error' THEN props || '#' || event_id END) AS error,
       max(CASE WHEN event_type = 'refund' THEN props || '#' || event_id END) AS refund,
       TIMESTAMP '2024-01-02 03:04:05' AS dt_log
FROM events GROUP BY user_id
""", name="eav_pivot")
def eav_pivot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows to one row per user; no event has the last label."""
    labels = ["signup", "purchase", "view", "click", "error", "refund"]
    value = F.concat("props", F.lit("#"), F.col("event_id").cast("string"))
    wide = eav_pivot(
        table(spark, sf_dir, "events"), [F.col("user_id")], F.col("event_type"), value, dict(zip(labels, labels))
    )
    return wide.withColumn("dt_log", F.lit(AS_OF.isoformat()).cast("timestamp_ntz"))


@query("""
SELECT event_id, ts AS strict_ts, CASE WHEN event_type <> 'error' THEN ts END AS lenient_ts FROM events
""")
def timestamp_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with an offset to zone-less time; bad text gives NULL when not strict."""
    text = F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("-03:00"))
    damaged = F.when(F.col("event_type") == "error", F.concat(F.lit("at "), text)).otherwise(text)
    return table(spark, sf_dir, "events").select(
        "event_id",
        convert.parse_timestamp(text).alias("strict_ts"),
        convert.parse_timestamp(damaged, strict=False).alias("lenient_ts"),
    )


LOW_MINIMUM = 100
"""Rows from which a key is hot in the queries that show the sliced plans on small tables."""


def _counted(orders: DataFrame, tasks: DataFrame, key: str, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Orders with the number of their tasks, hot keys in slices; ``orders`` only scans."""
    hot = find_hot_keys(orders, key, min_rows=min_hot_rows)[key]
    joined = sliced_join(with_spread(orders) if hot else orders, task_counts(tasks), key, "task_deal_id", left_hot=hot)
    return joined.select(*orders.columns, "qtde_tarefas")


@query("""
SELECT o_orderkey, qtde_tarefas
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS qtde_tarefas FROM lineitem GROUP BY l_orderkey) t
ON o_orderkey = l_orderkey
""")
def task_count_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per key joined to their parents; a parent without rows has NULL, not 0."""
    tasks = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("deal_id"))
    return _counted(table(spark, sf_dir, "orders").select("o_orderkey"), tasks, "o_orderkey")


@query("""
SELECT o_orderkey, deal, qtde_tarefas
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS deal FROM orders)
LEFT JOIN (SELECT CASE WHEN l_partkey % 4 > 0 THEN l_orderkey END AS deal, count(*) AS qtde_tarefas FROM lineitem GROUP BY 1) USING (deal)
""")
def task_count_sliced_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a third of the parents on one key, NULL keys on both sides, and slices."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "case when o_orderkey % 3 = 0 then 1 when o_orderkey % 5 <> 0 then o_orderkey end deal"
    )
    tasks = table(spark, sf_dir, "lineitem").selectExpr("if(l_partkey % 4 > 0, l_orderkey, null) deal_id")
    return _counted(orders, tasks, "deal", LOW_MINIMUM)


@query("""
WITH organizations AS (
    SELECT concat('C', c_custkey) AS company_id, c_name AS name FROM customer
    UNION ALL SELECT concat('S', s_suppkey), s_name FROM supplier
)
SELECT company_id, name, o_orderkey, o_orderstatus
FROM organizations LEFT JOIN orders
ON company_id = CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat('C', o_custkey) END
""")
def organization_deals_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organizations with all their deals, or once with NULL. Hot organizations are sliced."""
    organizations = table(spark, sf_dir, "customer").selectExpr("concat('C', c_custkey) company_id", "c_name name")
    organizations = organizations.unionByName(
        table(spark, sf_dir, "supplier").selectExpr("concat('S', s_suppkey) company_id", "s_name name")
    )
    deals = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "if(o_orderstatus = 'P', null, concat('C', o_custkey)) organization_id"
    )
    joined = skew_safe_join(organizations, deals, "company_id", "organization_id")
    return joined.drop("organization_id")


@query("""
SELECT c_custkey AS id, c_name AS name_x, c_acctbal AS value_x, o_orderpriority AS name_y, o_totalprice AS value_y,
       o_orderkey
FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F'
""")
def left_merge_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left merge of frames that share column names."""
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey id", "c_name name", "c_acctbal value")
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "if(o_orderstatus = 'F', o_custkey, null) id", "o_orderpriority name", "o_totalprice value"
    )
    return merge_left(customer, orders, "id")


@query("""
SELECT id, l.name AS name_x, o_totalprice AS value_x, r.name AS name_y, s_acctbal AS value_y, o_orderkey
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderstatus = 'F' THEN o_custkey % 200 END AS id,
             o_orderpriority AS name, o_totalprice FROM orders) l
LEFT JOIN (SELECT CASE WHEN s_suppkey % 3 > 0 THEN s_suppkey % 40 END AS id, s_name AS name, s_acctbal FROM supplier) r USING (id)
""")
def left_merge_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge with a third of the rows on one key and NULL keys on both sides, in slices."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "case when o_orderkey % 3 = 0 then 1 when o_orderstatus = 'F' then o_custkey % 200 end id",
        "o_orderpriority name", "o_totalprice value",
    )
    supplier = table(spark, sf_dir, "supplier").selectExpr(
        "if(s_suppkey % 3 > 0, s_suppkey % 40, null) id", "s_name name", "s_acctbal value"
    )
    return merge_left(orders, supplier, "id", min_hot_rows=LOW_MINIMUM)


@query("""
SELECT DISTINCT c_mktsegment, c_nationkey, o_orderstatus, o_orderpriority, qtde_tarefas
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
LEFT JOIN (SELECT l_orderkey, count(*) AS qtde_tarefas FROM lineitem GROUP BY l_orderkey) t ON o_orderkey = l_orderkey
""")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct rows above two left joins; NULLs compare equal."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    tasks = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("deal_id"))
    # The counts come to the orders, not to the joined rows, which have no order key where a customer has no order.
    hot = find_hot_keys(orders, "o_custkey")["o_custkey"]
    counted = sliced_join(with_spread(orders) if hot else orders, task_counts(tasks), "o_orderkey", "task_deal_id")
    joined = sliced_join(customer, counted, "c_custkey", "o_custkey", right_hot=hot)
    return joined.select("c_mktsegment", "c_nationkey", "o_orderstatus", "o_orderpriority", "qtde_tarefas").distinct()


# The register and coordinate texts of the coordinate rules' case table, with the key worked in.
REGISTER = """CASE c_custkey % 14
    WHEN 0 THEN concat('SP, -', c_custkey % 90, '.5,-46.6') WHEN 1 THEN 'no comma' WHEN 2 THEN NULL WHEN 3 THEN 'a,b'
    WHEN 10 THEN concat('MT-', c_custkey % 90, ',2') WHEN 13 THEN '' ELSE 'x' END"""
COORDINATE = """CASE c_custkey % 14
    WHEN 0 THEN 'z' WHEN 1 THEN concat('-23.5,-', c_custkey % 180, '.25') WHEN 2 THEN '-23.5,-46.6' WHEN 3 THEN 'q'
    WHEN 4 THEN 'Lat -23.5,-46.6' WHEN 5 THEN '-23.5' WHEN 6 THEN concat('23.5,-', c_custkey % 90)
    WHEN 7 THEN concat('-23.5,-46,', c_custkey % 10) WHEN 8 THEN '-23,5,-46,6' WHEN 9 THEN '23.5,46.6' WHEN 10 THEN 'q'
    WHEN 11 THEN concat('-', c_custkey % 90, '.5, -46.6') WHEN 12 THEN NULL WHEN 13 THEN '-1.5,-2.5' END"""

def coordinate_ctes(source: str) -> str:
    """The coordinate rules by positions and slices, on top of a CTE with the two texts."""
    return f"""
full_texts AS (
    SELECT *, if(contains(registro_rural, ','), registro_rural[greatest(instr(registro_rural, '-'), 1):],
                 if(registro_rural IS NULL, NULL, coordenada)) AS coordenada_completa
    FROM {source}
), places AS (
    SELECT *, instr(coordenada_completa, '-') AS dash, instr(coordenada_completa, ',') AS comma FROM full_texts
), slices AS (
    SELECT * EXCLUDE (dash, comma),
           if(dash > 0, replace(coordenada_completa[dash : dash + comma - 1], ',', ''), NULL) AS lat_text,
           if(dash > 0, replace(coordenada_completa[comma + 1 :], ',', '.'), NULL) AS lon_text
    FROM places
)"""


COORDINATE_SQL = f"""
WITH raw AS (SELECT c_custkey, {REGISTER} AS registro_rural, {COORDINATE} AS coordenada FROM customer),
{coordinate_ctes("raw")}, numbers AS (
    SELECT *, TRY_CAST(lat_text AS DECIMAL(38,18))::DOUBLE AS latitude,
           TRY_CAST(lon_text AS DECIMAL(38,18))::DOUBLE AS longitude
    FROM slices
)
"""


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = F.col("coordenada_completa")
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", F.expr(REGISTER).alias("registro_rural"), F.expr(COORDINATE).alias("coordenada"))
        .withColumn("coordenada_completa", geo.full_coordinate(F.col("registro_rural"), F.col("coordenada")))
        .withColumns({"latitude": geo.latitude(full, strict=False), "longitude": geo.longitude(full, strict=False)})
    )


@query(f"""{COORDINATE_SQL}
SELECT c_custkey, coordenada_completa, lat_text, lon_text, latitude, longitude,
       CASE WHEN lat_text IS NULL THEN 'missing' WHEN latitude IS NULL THEN 'bad_latitude'
            WHEN longitude IS NULL THEN 'bad_longitude' ELSE 'ok' END AS coord_status
FROM numbers
""")
def coordinate_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fourteen kinds of coordinate text, bad ones kept with a status."""
    full = F.col("coordenada_completa")
    return _located(spark, sf_dir).select(
        "c_custkey",
        full,
        geo.latitude_text(full).alias("lat_text"),
        geo.longitude_text(full).alias("lon_text"),
        F.col("latitude").cast("double"),
        F.col("longitude").cast("double"),
        geo.coordinate_status(full).alias("coord_status"),
    )


@query(f"""{COORDINATE_SQL}
SELECT c_custkey, CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 4326 END AS srid,
       CASE WHEN latitude IS NOT NULL THEN longitude END AS x, CASE WHEN longitude IS NOT NULL THEN latitude END AS y
FROM numbers
""")
def point_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRID-4326 points, x = longitude and y = latitude; NULL if either is NULL."""
    point = geo.point(F.col("longitude"), F.col("latitude"))
    return _located(spark, sf_dir).select("c_custkey", point.alias("p")).select("c_custkey", "p.srid", "p.x", "p.y")


@query("""
SELECT c_custkey, k.id_organizacao, hex(CAST(n_name AS BLOB)) AS geom
FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN concat('0', c_nationkey) ELSE CAST(c_nationkey + 5 AS VARCHAR)
             END AS id_organizacao FROM customer) k
LEFT JOIN nation ON k.id_organizacao = CAST(n_nationkey AS VARCHAR)
""")
def key_cast_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text key against integer key: '07' and 7 differ. The geometry passes through as bytes."""
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "if(c_custkey % 5 = 0, concat('0', c_nationkey), cast(c_nationkey + 5 as string)) id_organizacao",
    )
    forest = table(spark, sf_dir, "nation").selectExpr("n_nationkey id_organizacao", "cast(n_name as binary) geom")
    joined = lookup_left_join(customer, map_lookup(forest), "id_organizacao", "map_id")
    return joined.select("c_custkey", "id_organizacao", F.hex("geom").alias("geom"))


@query("""
SELECT l_orderkey, avg(l_quantity) AS media, avg(l_quantity) >= 7 AS passou FROM lineitem GROUP BY l_orderkey
""")
def mean_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean mark per student and whether it reaches 7."""
    means = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.avg("l_quantity").alias("media"))
    return means.withColumn("passou", F.col("media") >= PASS_MEAN)
