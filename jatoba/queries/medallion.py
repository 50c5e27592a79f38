"""The silver and gold jobs over the tables.

Organizations are customers and suppliers (the latter have no deals), deals are orders,
tasks are line items, funnels follow the order priority, the forest map is the nations.
"""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jatoba.operators.publish import RUN, publish, write_member
from jatoba.plans import gold, silver
from jatoba.plans.jobs import run_bronze, run_gold, run_silver
from jatoba.queries.registry import query, spread, table
from jatoba.queries.relational import AS_OF, LOW_MINIMUM, coordinate_ctes
from jatoba.schemas import CAPTURE_FUNNEL, CUSTOM_FIELD_COLUMNS, GOLD, NEGOTIATION_FUNNEL
from jatoba.session import shared_dir, together
from jatoba.sources.tables import Lake


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS company_id, c_name AS name,
       CAST('2023-01-01' AS TIMESTAMP) + to_days(c_nationkey) + to_hours(10) AS created_at,
       CAST('2023-02-01' AS TIMESTAMP) + to_days(c_nationkey) AS updated_at,
       CAST(c_nationkey AS VARCHAR) AS id, greatest(c_mktsegment, c_name) AS cidade, NULL AS car_incra,
       CAST(c_custkey % 100 AS VARCHAR) AS area_util, NULL AS volume_calculado, c_name AS proprietario,
       NULL AS landviewer, CASE WHEN c_custkey % 3 <> 0 THEN concat('MT-', c_custkey % 90, ',2') END AS registro_rural,
       NULL AS google_maps, TIMESTAMP '2024-01-02 03:04:05' AS dt_log, '-1.5,-2.5' AS coordenada
FROM customer
""")
def silver_organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Custom-field rows to one row per organization: repeated, NULL, absent and unknown labels."""
    fields = """array(
        named_struct('label', 'ID', 'value', cast(c_nationkey as string)),
        named_struct('label', 'CIDADE', 'value', c_mktsegment),
        named_struct('label', 'CIDADE', 'value', c_name),
        named_struct('label', 'ÁREA ÚTIL', 'value', cast(c_custkey % 100 as string)),
        named_struct('label', 'VOLUME CALCULADO', 'value', cast(null as string)),
        named_struct('label', 'PROPRIETÁRIO', 'value', c_name),
        named_struct('label', 'REGISTRO RURAL', 'value', if(c_custkey % 3 <> 0, concat('MT-', c_custkey % 90, ',2'), null)),
        named_struct('label', 'COORDENADA', 'value', '-1.5,-2.5'),
        named_struct('label', 'Id', 'value', 'wrong case'),
        named_struct('label', cast(null as string), 'value', 'no label'))"""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    bronze = spread(customer, "c_custkey").select(
        F.expr("cast(c_custkey as string)").alias("id"),
        F.col("c_name").alias("name"),
        F.expr("concat(date_add(date'2023-01-01', c_nationkey), 'T10:00:00.000-03:00')").alias("created_at_x"),
        F.expr("concat(date_add(date'2023-02-01', c_nationkey), 'T00:00:00Z')").alias("updated_at_x"),
        F.expr(f"inline({fields})").alias("custom_field.label", "value"),
    )
    return silver.silver_organizations(bronze, AS_OF)


FUNNEL_SQL = f"""
    SELECT DISTINCT CASE WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN '{CAPTURE_FUNNEL}'
                WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN '{CAPTURE_FUNNEL}'
                ELSE '{NEGOTIATION_FUNNEL}' END AS funnel_name,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS funnel_stage
    FROM orders"""


SILVER_DEALS_SQL = f"""
SELECT concat('D', o_orderkey) AS id, concat('Deal ', o_orderkey) AS name, o_orderdate AS last_activity_at,
       o_orderkey % 10 AS interactions, o_orderstatus = 'F' AS win,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS closed_at,
       concat('C', o_custkey) AS organization_id, concat('Org ', o_custkey) AS organization_name,
       concat('User ', o_custkey % 7) AS user_name, o_orderpriority AS stage_id, lower(o_orderpriority) AS stage_name,
       CASE WHEN o_orderstatus = 'O' THEN 'price' END AS lost_reason, o_orderdate AS created_at,
       o_orderdate + to_days(3) AS updated_at, funnel_name
FROM orders LEFT JOIN ({FUNNEL_SQL}) f ON o_orderpriority = funnel_stage
"""


def _bronze_deals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    iso = "concat(replace(cast({} as string), ' ', 'T'), '-03:00')"
    bronze = orders.select(
        F.expr("concat('D', o_orderkey)").alias("id"),
        F.expr("concat('Deal ', o_orderkey)").alias("name"),
        F.expr(iso.format("o_orderdate")).alias("last_activity_at"),
        F.expr("o_orderkey % 10").alias("interactions"),
        F.expr("o_orderstatus = 'F'").alias("win"),
        F.expr(f"if(o_orderstatus <> 'P', {iso.format('o_orderdate')}, null)").alias("closed_at"),
        F.expr("concat('C', o_custkey)").alias("organization.id"),
        F.expr("concat('Org ', o_custkey)").alias("organization.name"),
        F.expr("concat('User ', o_custkey % 7)").alias("user.name"),
        F.col("o_orderpriority").alias("deal_stage.id"),
        F.lower("o_orderpriority").alias("deal_stage.name"),
        F.expr("if(o_orderstatus = 'O', 'price', null)").alias("deal_lost_reason.name"),
        F.expr(iso.format("o_orderdate")).alias("created_at"),
        F.expr(iso.format("(o_orderdate + interval 3 days)")).alias("updated_at"),
    )
    captured = F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED") | (
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    )
    funnels = orders.select(
        F.when(captured, CAPTURE_FUNNEL).otherwise(NEGOTIATION_FUNNEL).alias("Name"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("DealStage_ID"),
    )
    return bronze, funnels


@query(SILVER_DEALS_SQL)
def silver_deals_funnel_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deals typed and joined to the distinct funnels: one stage in two funnels, one in none."""
    return silver.silver_deals(*_bronze_deals(spark, sf_dir))


@query(SILVER_DEALS_SQL)
def silver_deals_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same when the funnels are too large to broadcast and every stage is hot."""
    return silver.silver_deals(*_bronze_deals(spark, sf_dir), broadcast_bytes=0, min_hot_rows=LOW_MINIMUM)


# Texts that parse, so that the strict load passes: register, fallback, NULLs, no dash, blanks, commas.
REGISTER = """CASE {key} % 7 WHEN 0 THEN concat('SP, -', {key} % 90, '.5,-46.6') WHEN 1 THEN 'no comma' WHEN 2 THEN NULL
    WHEN 3 THEN 'a,b' WHEN 4 THEN concat('MT-', {key} % 90, ',2') ELSE 'x' END"""
COORDINATE = """CASE {key} % 7 WHEN 1 THEN concat('-23.5,-', {key} % 180, '.25') WHEN 5 THEN concat('-7.5, -4,', {key} % 10)
    WHEN 6 THEN NULL ELSE '-23.5,-46.6' END"""

ORGANIZATIONS = """
    SELECT concat('{letter}', {key}) AS company_id, concat('Org ', {nation}, '-', {key} % 50) AS name,
           CASE WHEN {key} % 5 = 0 THEN concat('0', {nation}) WHEN {key} % 11 = 0 THEN NULL
                ELSE concat('', {nation}) END AS id,
           concat('City ', {nation}) AS cidade, 'car' AS car_incra, concat({key} % 100, ' ha') AS area_util,
           concat({key} % 10, ' m3') AS volume_calculado, {name} AS proprietario, CAST(NULL AS STRING) AS landviewer,
           {register} AS registro_rural, 'maps' AS google_maps, {coordinate} AS coordenada
    FROM {source}"""


def _organizations_sql(letter: str, key: str, nation: str, name: str, source: str) -> str:
    return ORGANIZATIONS.format(
        letter=letter, key=key, nation=nation, name=name, source=source,
        register=REGISTER.format(key=key), coordinate=COORDINATE.format(key=key),
    )


CUSTOMER = _organizations_sql("C", "c_custkey", "c_nationkey", "c_mktsegment", "customer")
SUPPLIER = _organizations_sql("S", "s_suppkey", "s_nationkey", "s_name", "supplier")


OWNER = "concat('C', o_custkey)"
HOT_OWNER = "CASE WHEN o_orderkey % 3 = 0 THEN 'C1' ELSE concat('C', o_custkey) END"


def _gold_sql(funnel: str, owner: str = OWNER) -> str:
    return f"""
WITH organizations AS ({CUSTOMER} UNION ALL {SUPPLIER}),
deals AS (
    SELECT concat('D', o_orderkey) AS id, concat('Deal ', o_orderstatus) AS name,
           CASE WHEN o_orderstatus = 'P' AND o_orderkey % 10 = 0 THEN NULL ELSE {owner} END AS organization_id,
           concat('User ', o_custkey % 7) AS user_name, o_orderpriority AS stage_name,
           CASE WHEN o_orderstatus = 'O' THEN 'price' END AS lost_reason,
           CAST(concat(year(o_orderdate), '-01-01') AS TIMESTAMP) AS created_at,
           CAST(concat(year(o_orderdate), '-12-31') AS TIMESTAMP) AS updated_at,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '{NEGOTIATION_FUNNEL}'
                WHEN o_orderpriority <> '5-LOW' THEN '{CAPTURE_FUNNEL}' END AS funnel_name
    FROM orders
), tasks AS (
    SELECT CASE WHEN l_returnflag <> 'A' THEN concat('D', l_orderkey) END AS deal_id FROM lineitem
), counts AS (SELECT deal_id, count(*) AS qtde_tarefas FROM tasks GROUP BY deal_id),
pairs AS (
    SELECT o.* EXCLUDE (company_id, id, name), o.id AS id_organizacao, o.name AS nome_organizacao,
           d.name AS nome_negociacao, user_name AS responsavel, stage_name AS etapa, lost_reason AS motivo_perda,
           created_at AS dt_criacao_negociacao, updated_at AS dt_atualizacao_negociacao, funnel_name AS nome_funil,
           qtde_tarefas, TIMESTAMP '2024-01-02 03:04:05' AS dt_carga
    FROM organizations o LEFT JOIN deals d ON o.company_id = d.organization_id LEFT JOIN counts ON d.id = deal_id
), {coordinate_ctes("pairs")}, base AS (
    SELECT DISTINCT * EXCLUDE (coordenada) FROM slices
), numbers AS (
    SELECT * EXCLUDE (lat_text, lon_text), CAST(lat_text AS DECIMAL(38,18))::DOUBLE AS latitude,
           CAST(lon_text AS DECIMAL(38,18))::DOUBLE AS longitude, lat_text || lon_text IS NOT NULL AS located
    FROM base
)
SELECT numbers.* EXCLUDE (located), if(located, 4326, NULL) AS srid, if(located, longitude, NULL) AS x,
       if(located, latitude, NULL) AS y, hex(n_name::BLOB) AS geom
FROM numbers LEFT JOIN nation ON id_organizacao = CAST(n_nationkey % 20 AS VARCHAR)
WHERE nome_funil = '{funnel}'
"""


def _organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return spark.sql(CUSTOMER.replace("FROM customer", "FROM {t}"), t=customer).unionByName(
        spark.sql(SUPPLIER.replace("FROM supplier", "FROM {t}"), t=supplier)
    )


def _deals(spark: SparkSession, sf_dir: str, owner: str = OWNER) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.expr("concat('D', o_orderkey)").alias("id"),
        F.expr("concat('Deal ', o_orderstatus)").alias("name"),
        F.expr(f"if(o_orderstatus = 'P' AND o_orderkey % 10 = 0, null, {owner})").alias("organization_id"),
        F.expr("concat('User ', o_custkey % 7)").alias("user_name"),
        F.col("o_orderpriority").alias("stage_name"),
        F.expr("if(o_orderstatus = 'O', 'price', null)").alias("lost_reason"),
        F.expr("cast(concat(year(o_orderdate), '-01-01') as timestamp_ntz)").alias("created_at"),
        F.expr("cast(concat(year(o_orderdate), '-12-31') as timestamp_ntz)").alias("updated_at"),
        _funnel(F.col("o_orderpriority")).alias("funnel_name"),
        "o_orderkey",
    )


def _funnel(stage: Column) -> Column:
    return F.when(stage.isin("1-URGENT", "2-HIGH"), NEGOTIATION_FUNNEL).when(stage != "5-LOW", CAPTURE_FUNNEL)


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    deal = "if(l_returnflag <> 'A', concat('D', l_orderkey), null) deal_id"
    return table(spark, sf_dir, "lineitem").selectExpr(deal, "l_orderkey", "l_linenumber", "l_linestatus")


def _forest_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr("n_nationkey % 20 id_organizacao", "cast(n_name as binary) geom")


def _comparable(table: DataFrame) -> DataFrame:
    """Decimals as doubles, the point as three columns, bytes as hex text."""
    return table.withColumns(
        {
            "latitude": F.col("latitude").cast("double"),
            "longitude": F.col("longitude").cast("double"),
            "srid": F.col("ponto.srid"),
            "x": F.col("ponto.x"),
            "y": F.col("ponto.y"),
            "geom": F.hex("geom"),
        }
    ).drop("ponto")


def _gold(spark: SparkSession, sf_dir: str, funnel: str, owner: str = OWNER, low: bool = False) -> DataFrame:
    organizations = _organizations(spark, sf_dir).withColumn("dt_log", F.lit(AS_OF.isoformat()).cast("timestamp_ntz"))
    hot = {"min_hot_rows": LOW_MINIMUM} if low else {}
    base = gold.gold_base(organizations, _deals(spark, sf_dir, owner), _tasks(spark, sf_dir), [funnel], **hot)
    options = {"broadcast_bytes": 0, **hot} if low else {}
    return _comparable(gold.gold_table(base, _forest_map(spark, sf_dir), funnel, **options))


@query(_gold_sql(NEGOTIATION_FUNNEL))
def gold_negotiations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organizations with deals under negotiation, where they are and with how many tasks."""
    return _gold(spark, sf_dir, NEGOTIATION_FUNNEL)


@query(_gold_sql(CAPTURE_FUNNEL))
def gold_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the capture funnel."""
    return _gold(spark, sf_dir, CAPTURE_FUNNEL)


@query(_gold_sql(NEGOTIATION_FUNNEL, HOT_OWNER))
def gold_negotiations_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a third of the deals on one organization, and every join in slices."""
    return _gold(spark, sf_dir, NEGOTIATION_FUNNEL, HOT_OWNER, low=True)


RECORDS = 200
"""Records of a full page."""


def _numbered(rows: DataFrame, stretch: str, *order: str) -> DataFrame:
    """``rows`` numbered from 0 in ``nth``: counted per stretch first, so that no task numbers them all."""
    rows = rows.withColumn("stretch", F.expr(stretch))
    counts = rows.groupBy("stretch").agg(F.count("*").alias("n"))
    before = counts.select(F.col("stretch").alias("of"), (F.sum("n").over(Window.orderBy("stretch")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("stretch").orderBy(*order)) - 1
    return rows.withColumn("inside", inside).join(before, F.col("stretch") == F.col("of")).withColumn("nth", F.col("before") + F.col("inside"))


def _pages(numbered: DataFrame, collection: str, record: str, envelope: bool = True) -> DataFrame:
    """A page log of full pages, the last one short or full."""
    page = F.floor(F.col("nth") / RECORDS).cast("int") + 1 if envelope else F.lit(1)
    body = F.struct(F.col("all").alias(collection)) if envelope else F.col("all")
    return (
        numbered.groupBy(page.alias("page"))
        .agg(F.collect_list(F.expr(record)).alias("all"))
        .select("page", F.lit(200).alias("status"), F.size("all").alias("records"), F.to_json(body).alias("body"))
    )


def _last_number(rows: DataFrame) -> DataFrame:
    """The number of the last page of these records as ``end``, from their count; NULL of none."""
    return rows.agg(F.when(F.count("*") > 0, F.ceil(F.count("*") / RECORDS).cast("int")).alias("end"))


@query(f"""
SELECT 'negotiations' AS gold, * FROM ({_gold_sql(NEGOTIATION_FUNNEL)})
UNION ALL BY NAME SELECT 'captures' AS gold, * FROM ({_gold_sql(CAPTURE_FUNNEL)})
""")
def medallion_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages through all nine jobs to both gold tables.

    Bodies hold 200 records, the last of a collection maybe fewer. An empty page and one with
    a foreign deal come after the deals, and a failed page after the tasks.
    """
    landing, lake_folder = shared_dir(spark, "landing"), shared_dir(spark, "lake")
    fields = ", ".join(
        f"named_struct('value', {column}, 'custom_field', named_struct('label', '{label}'))"
        for label, column in CUSTOM_FIELD_COLUMNS.items()
    )
    organization = f"""named_struct('id', company_id, '_id', company_id, 'name', name,
        'created_at', '2023-10-10T10:00:00.000-03:00', 'updated_at', '2023-10-11T10:00:00.000-03:00',
        'custom_fields', array({fields}))"""
    deal = """named_struct('id', id, 'name', name, 'organization', named_struct('id', organization_id),
        'user', named_struct('name', user_name), 'deal_stage', named_struct('id', stage_name, 'name', stage_name),
        'deal_lost_reason', if(lost_reason is null, null, named_struct('name', lost_reason)),
        'created_at', cast(created_at as string), 'updated_at', cast(updated_at as string))"""
    task = "named_struct('id', concat(l_orderkey, '-', l_linenumber), 'deal_id', deal_id, 'done', l_linestatus = 'F')"
    funnel = "named_struct('name', funnel_name, 'deal_stages', array(named_struct('_id', stage, 'name', stage)))"
    stages = _deals(spark, sf_dir).select(F.col("stage_name").alias("stage"), "funnel_name").distinct().withColumn("nth", F.lit(0))
    all_deals, all_tasks = _deals(spark, sf_dir), _tasks(spark, sf_dir)
    deals = _pages(_numbered(all_deals, "o_orderkey div 1000", "o_orderkey"), "deals", deal)
    tasks = _pages(_numbered(all_tasks, "l_orderkey div 1000", "l_orderkey", "l_linenumber"), "tasks", task)
    after = "inline(array(named_struct('by', 1, 'records', 0, 'body', '{\"deals\": []}'), named_struct('by', 2, 'records', 1, 'body', '{\"deals\": [{\"id\": \"late\"}]}')))"
    late_deals = _last_number(all_deals).selectExpr("end", after).selectExpr("end + by page", "200 status", "records", "body")
    late_failure = _last_number(all_tasks).select(
        (F.col("end") + 1).alias("page"), F.lit(500).alias("status"), F.lit(None).cast("int").alias("records"), F.lit("busy").alias("body")
    )
    organizations = _numbered(_organizations(spark, sf_dir), "pmod(xxhash64(company_id), 64)", "company_id")
    logs = {
        "organizations": _pages(organizations, "organizations", organization),
        "deals": deals.unionByName(late_deals),
        "tasks": tasks.unionByName(late_failure),
        "deal_stages": _pages(stages, "deal_stages", "named_struct('id', stage, 'name', stage)"),
        "deal_pipelines": _pages(stages, "deal_pipelines", funnel, envelope=False),
    }
    together(*[partial(log.write.parquet, f"{landing}/{name}") for name, log in logs.items()])
    lake = Lake(spark, lake_folder, f"lake_{uuid.uuid4().hex}")
    run_bronze(spark, landing, lake, layout="log")
    run_silver(lake, AS_OF)
    run_gold(lake, _forest_map(spark, sf_dir))
    parts = [_comparable(lake.read("gold", g)).withColumn("gold", F.lit(g)) for g in ("negotiations", "captures")]
    return parts[0].unionByName(parts[1])


@query(f"""
SELECT 'negotiations' AS gold, * FROM ({_gold_sql(NEGOTIATION_FUNNEL)})
UNION ALL BY NAME SELECT 'captures' AS gold, * FROM ({_gold_sql(CAPTURE_FUNNEL)})
""")
def gold_published_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both gold tables of one run as readers see them, while a later run has written only one of its own."""
    lake = Lake(spark, shared_dir(spark, "lake"), f"pair_{uuid.uuid4().hex}").create()
    organizations = _organizations(spark, sf_dir).withColumn("dt_log", F.lit(AS_OF.isoformat()).cast("timestamp_ntz"))
    funnels = {"negotiations": NEGOTIATION_FUNNEL, "captures": CAPTURE_FUNNEL}
    base = gold.gold_base(organizations, _deals(spark, sf_dir), _tasks(spark, sf_dir), list(funnels.values())).checkpoint()
    tables = {name: gold.gold_table(base, _forest_map(spark, sf_dir), funnel) for name, funnel in funnels.items()}
    first, second = lake.fresh_folder("gold", RUN), lake.fresh_folder("gold", RUN)
    together(*[partial(write_member, rows, lake, "gold", name, GOLD, first) for name, rows in tables.items()])
    publish(lake, "gold", list(tables), GOLD, first, {"run": "first"})
    write_member(tables["captures"].limit(0), lake, "gold", "captures", GOLD, second)
    parts = [_comparable(lake.read("gold", name)).withColumn("gold", F.lit(name)) for name in tables]
    return parts[0].unionByName(parts[1])
