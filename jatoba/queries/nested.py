"""Page scans and nested records.

The tables stand in for the exports: their rows are written out as JSON and read back
through the declared schemas. Each row is one chunk of a page of the log, so nothing is
collected to build a page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jatoba import schemas
from jatoba.operators.nested import flatten_structs, project, union_by_name
from jatoba.plans.bronze import bronze_deals, bronze_funnels, bronze_organizations, bronze_stages, bronze_tasks
from jatoba.queries.registry import plain_names, query, table
from jatoba.session import shared_dir
from jatoba.sources import pages as source


def parsed(df: DataFrame, body: str, record: str) -> DataFrame:
    return df.select(F.from_json(F.expr(body), record, {"mode": "FAILFAST"}).alias("r")).select("r.*")


@query("""
WITH log AS (
    SELECT 'organizations' AS collection, c_custkey // 200 + 1 AS page, c_acctbal > 9997 AS failed,
           CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer
    UNION ALL
    SELECT 'deals', o_orderkey // 200 + 1, FALSE, CAST(o_orderkey AS VARCHAR), o_orderpriority FROM orders
    UNION ALL
    SELECT 'tasks', event_id // 200 + 1, FALSE, CAST(event_id AS VARCHAR), event_type FROM events WHERE event_id % 4999 <> 4990
), pages AS (
    SELECT collection, page, count(*) AS size, bool_or(failed) AS failed FROM log GROUP BY collection, page
), bounds AS (
    SELECT collection, min(CASE WHEN NOT failed AND size < 200 THEN page END) AS first_short,
           min(CASE WHEN failed THEN page END) AS first_bad
    FROM pages GROUP BY collection
)
SELECT collection, page, id, name FROM log JOIN bounds USING (collection)
WHERE (first_short IS NULL OR page <= first_short) AND (first_bad IS NULL OR page < first_bad)
""")
def paged_collection_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three paged collections: one with failed pages, one of full pages, one with a short page."""
    logs = {
        "organizations": (
            "customer", "c_custkey div 200 + 1", "if(c_acctbal > 9997, 500, 200)",
            "named_struct('id', cast(c_custkey as string), 'name', c_name)", schemas.ORGANIZATION_RECORD, "name",
        ),
        "deals": (
            "orders", "o_orderkey div 200 + 1", "200",
            "named_struct('id', cast(o_orderkey as string), 'name', o_orderpriority)", schemas.DEAL_RECORD, "name",
        ),
        "tasks": (
            "events", "event_id div 200 + 1", "200",
            "if(event_id % 4999 = 4990, null, named_struct('id', cast(event_id as string), 'subject', event_type))",
            schemas.TASK_RECORD, "subject",
        ),
    }
    parts = []
    for collection, (name, page, status, record, schema, title) in logs.items():
        log = table(spark, sf_dir, name).selectExpr(
            f"cast({page} as int) page", f"{status} status",
            f"to_json(named_struct('{collection}', filter(array({record}), x -> x is not null))) body",
        )
        records = source.paged_records(*source.split_page_log(log), collection, schema, whole=False)
        parts.append(records.select(F.lit(collection).alias("collection"), "page", "id", F.col(title).alias("name")))
    return union_by_name(parts)


@query("""
SELECT o_orderkey // 200 + 1 AS page, CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS name
FROM orders WHERE o_orderkey // 200 + 1 < (SELECT max(o_orderkey) // 200 + 1 - 3 FROM orders)
""")
def page_files_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 200 records, a folder each as Spark writes them, and a status file; the fourth page from the end failed."""
    landing = shared_dir(spark, "page-files")
    record = F.expr("named_struct('id', cast(o_orderkey as string), 'name', o_orderpriority)")
    pages = (
        table(spark, sf_dir, "orders")
        .groupBy(F.expr("cast(o_orderkey div 200 + 1 as int)").alias("page"))
        .agg(F.collect_list(record).alias("deals"))
        .select("page", F.to_json(F.struct("deals")).alias("value"))
    )
    pages.write.partitionBy("page").text(f"{landing}/deals")
    failed = F.col("page") == pages.agg(F.max("page") - 3).scalar()
    answers = pages.select("page", F.when(failed, 500).otherwise(200).alias("status"))
    answers.write.option("header", True).csv(f"{landing}/deals_status.csv")
    landed = source.read_page_files(spark, landing, "deals")
    return source.paged_records(*landed, "deals", schemas.DEAL_RECORD, whole=False).select("page", "id", "name")


@query("""
SELECT concat('D', o_orderkey) AS id, concat('Deal ', o_orderkey) AS name,
       CAST(o_orderdate AS VARCHAR) AS last_activity_at, o_orderkey % 10 AS interactions,
       CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS win,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS VARCHAR) END AS closed_at,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS organization_id,
       CASE WHEN o_orderstatus <> 'P' THEN concat('Org ', o_custkey) END AS organization_name,
       concat('User ', o_custkey % 7) AS user_name,
       left(o_orderpriority, 1) AS deal_stage_id, o_orderpriority AS deal_stage_name,
       CASE WHEN o_orderstatus = 'O' THEN 'price' END AS deal_lost_reason_name,
       CAST(o_orderdate AS VARCHAR) AS created_at, CAST(o_orderdate AS VARCHAR) AS updated_at
FROM orders
""")
def flatten_nested_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deal records with nested parents, some missing, to the 14 bronze columns."""
    record = """to_json(named_struct(
        'id', concat('D', o_orderkey), 'name', concat('Deal ', o_orderkey),
        'last_activity_at', cast(o_orderdate as string), 'interactions', o_orderkey % 10,
        'win', case o_orderstatus when 'F' then true when 'O' then false end,
        'closed_at', if(o_orderstatus <> 'P', cast(o_orderdate as string), null),
        'organization', if(o_orderstatus <> 'P',
            named_struct('id', cast(o_custkey as string), 'name', concat('Org ', o_custkey)), null),
        'user', named_struct('name', concat('User ', o_custkey % 7)),
        'deal_stage', named_struct('id', left(o_orderpriority, 1), 'name', o_orderpriority),
        'deal_lost_reason', if(o_orderstatus = 'O', named_struct('name', 'price'), null),
        'created_at', cast(o_orderdate as string), 'updated_at', cast(o_orderdate as string)))"""
    return plain_names(bronze_deals(parsed(table(spark, sf_dir, "orders"), record, schemas.DEAL_RECORD)))


@query("""
SELECT concat('T', event_id) AS id, event_type AS subject, 'call' AS type, NULL AS markup, event_type <> 'error' AS done,
       CASE WHEN event_type = 'view' THEN props END AS notes, concat('D', user_id) AS deal_id, NULL AS done_date,
       CAST(ts AS VARCHAR) AS created_at, CAST(CAST(ts AS DATE) AS VARCHAR) AS date
FROM events
""")
def bronze_tasks_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task pages to the ten bronze columns; fields no record has are NULL. Notes hold quoted text."""
    record = """named_struct('id', concat('T', event_id), 'subject', event_type, 'type', 'call',
        'done', event_type <> 'error', 'notes', if(event_type = 'view', props, null),
        'deal_id', concat('D', user_id), 'created_at', cast(ts as string), 'date', cast(cast(ts as date) as string),
        'unknown', 1)"""
    log = (
        table(spark, sf_dir, "events")
        .groupBy(F.expr("cast(event_id div 200 + 1 as int)").alias("page"))
        .agg(F.collect_list(F.expr(record)).alias("tasks"))
        .select("page", F.lit(200).alias("status"), F.to_json(F.struct("tasks")).alias("body"))
    )
    return bronze_tasks(source.paged_records(*source.split_page_log(log), "tasks", schemas.TASK_RECORD, whole=False))


@query("""
SELECT concat('P', p_partkey) AS id, p_name AS name, CASE WHEN p_size > 25 THEN '2023-01-01' END AS created_at,
       '2023-02-02' AS updated_at
FROM part
""")
def bronze_stages_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages from the single page of their collection, whatever its status."""
    record = """named_struct('id', concat('P', p_partkey), 'name', p_name, 'order', p_size,
        'created_at', if(p_size > 25, '2023-01-01', null), 'updated_at', '2023-02-02')"""
    log = table(spark, sf_dir, "part").selectExpr(
        "1 page", "500 status", f"to_json(named_struct('deal_stages', array({record}))) body"
    )
    pages, _ = source.split_page_log(log)
    return bronze_stages(source.single_page_records(pages, "deal_stages", schemas.STAGE_RECORD))


@query("""
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events
""")
def flatten_json_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON text column to dotted columns."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.from_json("props", "k bigint", {"mode": "FAILFAST"}).alias("props")
    )
    return plain_names(project(flatten_structs(events), ["event_id", "event_type", "props.k"]))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, f.label AS custom_field_label, f.value AS value,
       'c' || c_nationkey AS created_at_x, 'u' || c_nationkey AS updated_at_x
FROM customer LEFT JOIN (
    SELECT c_custkey AS k, 'ID' AS label, CAST(c_nationkey AS VARCHAR) AS value FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT c_custkey, 'CIDADE', c_mktsegment FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT c_custkey, 'PROPRIETÁRIO', '["' || c_name || '",' || c_nationkey || ']'
              FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT c_custkey, NULL, NULL FROM customer WHERE c_acctbal >= 0
) f ON f.k = c_custkey
""")
def eav_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Custom fields to rows: text, array and null values, empty and missing arrays."""
    record = """concat(
        '{"id":"', c_custkey, '","_id":"', c_custkey, '","name":"', c_name,
        '","created_at":"c', c_nationkey, '","updated_at":"u', c_nationkey, '"',
        case when c_acctbal < -500 then '' when c_acctbal < 0 then ',"custom_fields":[]' else concat(
            ',"custom_fields":[{"value":"', c_nationkey, '","created_at":"x","custom_field":{"label":"ID"}},',
            '{"value":"', c_mktsegment, '","custom_field":{"label":"CIDADE"}},',
            '{"value":["', c_name, '",', c_nationkey, '],"custom_field":{"label":"PROPRIETÁRIO"}},',
            '{"value":null,"custom_field":null}]') end, '}')"""
    organizations = parsed(table(spark, sf_dir, "customer"), record, schemas.ORGANIZATION_RECORD)
    return plain_names(bronze_organizations(organizations))


@query("""
SELECT p_brand AS "Name", concat(p_partkey, '-', generate_subscripts(string_split(p_name, ' '), 1)) AS "DealStage_ID",
       unnest(string_split(p_name, ' ')) AS "DealStage_Name"
FROM part WHERE p_type <> 'ECONOMY'
""")
def stage_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funnels with a list of stages to rows; a funnel without the list gives none."""
    stages = """if(p_type = 'ECONOMY', null, transform(split(p_name, ' '), (word, i) ->
        named_struct('_id', concat(p_partkey, '-', i + 1), 'name', word)))"""
    log = table(spark, sf_dir, "part").selectExpr(
        "1 page", "200 status", f"to_json(array(named_struct('name', p_brand, 'deal_stages', {stages}))) body"
    )
    return bronze_funnels(source.single_page_array(*source.split_page_log(log), schemas.FUNNEL_RECORD))


@query("""
SELECT o_orderkey AS id, o_custkey AS who, o_totalprice AS amount, NULL AS kind FROM orders
UNION ALL
SELECT event_id, user_id, NULL, event_type FROM events
UNION ALL
SELECT c_custkey, NULL, c_acctbal, c_mktsegment FROM customer
""", name="union_by_name")
def union_by_name_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bag union of frames with different columns in different order."""
    return union_by_name(
        [
            table(spark, sf_dir, "orders").selectExpr("o_orderkey id", "o_custkey who", "o_totalprice amount"),
            table(spark, sf_dir, "events").selectExpr("event_type kind", "user_id who", "event_id id"),
            table(spark, sf_dir, "customer").selectExpr("c_acctbal amount", "c_custkey id", "c_mktsegment kind"),
        ]
    )
