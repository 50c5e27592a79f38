"""Pages to gold: exact rows for both funnels, one test per trap, plan shapes."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from jatoba import schemas
from jatoba.operators import joins
from jatoba.plans import gold, jobs, silver
from jatoba.sources.tables import Lake
from tests.test_pages import land

AS_OF = datetime(2024, 5, 6, 7, 8, 9)
NEGOTIATION, CAPTURE = schemas.NEGOTIATION_FUNNEL, schemas.CAPTURE_FUNNEL


def organization(oid, name, *fields):
    custom = [{"value": v, "custom_field": {"label": k}} for k, v in fields]
    stamp = "2023-10-10T10:00:00.000-03:00"
    return {"id": oid, "_id": oid, "name": name, "created_at": stamp, "updated_at": stamp, "custom_fields": custom}


def deal(did, oid, stage, name="deal", **more):
    return {
        "id": did, "name": name, "interactions": 1, "win": None, "organization": {"id": oid, "name": "?"},
        "user": {"name": "U"}, "deal_stage": {"id": stage, "name": f"S{stage}"},
        "created_at": "2023-11-01T08:00:00.000-03:00", "updated_at": "2023-11-02T08:00:00.000-03:00", **more,
    }


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("medallion")
    land(root, "organizations", [{"organizations": [
        organization("o1", "Org 1", ("ID", "7"), ("CIDADE", "A"), ("CIDADE", "B"), ("REGISTRO RURAL", "SP, -23.5,-46.6"),
                     ("ÁREA ÚTIL", "12"), ("OTHER", "!")),
        organization("o2", "Org 2", ("ID", "07"), ("REGISTRO RURAL", "x"), ("COORDENADA", "-1.5,-2.5")),
    ]}, {"organizations": [
        organization("o3", "Org 3", ("COORDENADA", "-1.5,-2.5")),
        organization("o4", "No deals", ("ID", "7")),
    ]}, {"organizations": [organization("o5", "Bad place", ("REGISTRO RURAL", "x"), ("COORDENADA", "-1.5"))]}])
    land(root, "deal_pipelines", [[
        {"name": NEGOTIATION, "deal_stages": [{"_id": "n1", "name": "x"}, {"_id": "both", "name": "y"}]},
        {"name": CAPTURE, "deal_stages": [{"_id": "c1", "name": "z"}, {"_id": "both", "name": "y"}]},
        {"name": "Outro", "deal_stages": [{"_id": "other", "name": "w"}]},
        {"name": "Empty"},
    ]])
    land(root, "deal_stages", [{"deal_stages": [{"id": "n1", "name": "x"}]}])
    land(root, "deals", [{"deals": [
        deal("d1", "o1", "n1", "first"), deal("d2", "o1", "both", "second", deal_lost_reason={"name": "price"})]},
        {"deals": [deal("d3", "o2", "c1", "twin"), deal("d4", "o2", "c1", "twin")]},
        {"deals": [deal("d5", "o3", "n1", "nowhere"), deal("d6", "o1", "none", "unknown stage")]},
        {"deals": [deal("d7", "o5", "other", "bad place"), deal("d8", None, "n1", "no org")]},
        {"deals": []},
    ])
    task = [{"id": f"t{i}", "deal_id": d} for i, d in enumerate(["d1", "d1", "d1", "d2", None, None])]
    land(root, "tasks", [{"tasks": task[:2]}, {"tasks": task[2:4]}, {"tasks": task[4:]}, {"tasks": []}])
    made = Lake(spark, str(root / "lake"), "medallion_test")
    jobs.run_bronze(spark, str(root), made, limit=2)
    jobs.run_silver(made, AS_OF)
    return made


@pytest.fixture(scope="module")
def forest_map(spark):
    rows = [(7, bytearray(b"g1")), (7, bytearray(b"g2")), (8, bytearray(b"g3"))]
    return spark.createDataFrame(rows, "id_organizacao bigint, geom binary")


def test_bronze_tables(lake):
    for name, columns in {
        "organizations": schemas.BRONZE_ORGANIZATIONS, "funnels": schemas.BRONZE_FUNNELS,
        "stages": schemas.BRONZE_STAGES, "deals": schemas.BRONZE_DEALS, "tasks": schemas.BRONZE_TASKS,
    }.items():
        assert lake.read("bronze", name).columns == columns
    counts = {n: lake.read("bronze", n).count() for n in ("organizations", "funnels", "deals", "tasks")}
    assert counts == {"organizations": 6 + 3 + 1 + 1 + 2, "funnels": 5, "deals": 8, "tasks": 6}


def test_silver_organizations(lake):
    rows = {r["company_id"]: r for r in lake.read("silver", "organizations").collect()}
    assert sorted(rows) == ["o1", "o2", "o3", "o4", "o5"]
    one = rows["o1"]
    assert (one["id"], one["cidade"], one["area_util"], one["coordenada"]) == ("7", "B", "12", None)
    assert one["created_at"] == datetime(2023, 10, 10, 10) and one["dt_log"] == AS_OF


def test_load_time_defaults_to_now(spark, lake):
    before = spark.sql("select current_timestamp()::timestamp_ntz t").first().t
    loaded = silver.silver_organizations(lake.read("bronze", "organizations")).select("dt_log").distinct().collect()
    after = spark.sql("select current_timestamp()::timestamp_ntz t").first().t
    assert len(loaded) == 1 and before <= loaded[0].dt_log <= after


def test_few_jobs_before_the_action(spark, lake):
    """A lookup is worked out once and measured in one pass; hot keys and row counts come from one pass a side."""
    tracker = spark.sparkContext.statusTracker()
    parts = lake.read("silver", "organizations"), lake.read("silver", "deals"), lake.read("bronze", "tasks")
    for limit, build in (
        (4, lambda: silver.silver_deals(lake.read("bronze", "deals"), lake.read("bronze", "funnels"))),
        (5, lambda: gold.gold_base(*parts, [NEGOTIATION])),
    ):
        spark.sparkContext.setJobGroup(f"jobs-{limit}", "before the action")
        build()
        spark.sparkContext._jsc.clearJobGroup()
        assert len(tracker.getJobIdsForGroup(f"jobs-{limit}")) <= limit


def test_silver_deals(lake):
    rows = sorted((r["id"], str(r["funnel_name"])) for r in lake.read("silver", "deals").collect())
    assert rows == sorted([
        ("d1", NEGOTIATION), ("d2", NEGOTIATION), ("d2", CAPTURE), ("d3", CAPTURE), ("d4", CAPTURE),
        ("d5", NEGOTIATION), ("d6", "None"), ("d7", "Outro"), ("d8", NEGOTIATION),
    ])


def test_gold_tables(spark, lake, forest_map):
    jobs.run_gold(lake, forest_map)
    negotiations = lake.read("gold", "negotiations")
    assert [f.simpleString() for f in negotiations.schema] == [
        f.simpleString() for f in spark.createDataFrame([], schemas.GOLD).schema
    ]

    def brief(table):
        rows = table.select(
            "id_organizacao", "nome_negociacao", "qtde_tarefas", "latitude", "ponto.x", "nome_funil",
            F.decode("geom", "utf-8"), "motivo_perda",
        ).collect()
        return sorted((tuple(r) for r in rows), key=str)

    lat = Decimal("-23.5")
    assert brief(negotiations) == sorted([
        ("7", "first", 3, lat, -46.6, NEGOTIATION, "g1", None),
        ("7", "first", 3, lat, -46.6, NEGOTIATION, "g2", None),
        ("7", "second", 1, lat, -46.6, NEGOTIATION, "g1", "price"),
        ("7", "second", 1, lat, -46.6, NEGOTIATION, "g2", "price"),
        (None, "nowhere", None, None, None, NEGOTIATION, None, None),
    ], key=str)
    assert brief(lake.read("gold", "captures")) == sorted([
        ("7", "second", 1, lat, -46.6, CAPTURE, "g1", "price"),
        ("7", "second", 1, lat, -46.6, CAPTURE, "g2", "price"),
        ("07", "twin", None, Decimal("-1.5"), -2.5, CAPTURE, None, None),
    ], key=str)
    # a second load replaces the rows
    jobs.run_gold(lake, forest_map)
    assert lake.read("gold", "captures").count() == 3


def test_bad_coordinate_fails_only_its_own_load(lake, forest_map):
    parts = lake.read("silver", "organizations"), lake.read("silver", "deals"), lake.read("bronze", "tasks")
    base = gold.gold_base(*parts, ["Outro"])
    with pytest.raises(Exception):
        gold.gold_table(base, forest_map, "Outro").collect()
    row = gold.gold_table(base, forest_map, "Outro", strict=False).collect()[0]
    assert row["latitude"] is None and row["longitude"] == Decimal("-1.5") and row["ponto"] is None
    assert [r["coord_status"] for r in gold.bad_coordinates(base, "Outro").collect()] == ["bad_latitude"]
    assert gold.bad_coordinates(gold.gold_base(*parts, [NEGOTIATION]), NEGOTIATION).count() == 0


@pytest.mark.parametrize("look_alikes", [True, False])
def test_sliced_gold_equals_plain_gold(spark, tmp_path, look_alikes):
    """A third of the deals on one organization, a third copies of one deal, repeated map keys."""
    name = "concat('n', id) name"
    if look_alikes:  # most organizations look the same: their digest is hot, though none of them is
        name = "if(id > 9, 'n9', concat('n', id)) name"
    organizations = spark.range(400 if look_alikes else 40).selectExpr(
        "concat('o', id) company_id", name, "timestamp_ntz'2024-01-01' created_at",
        "timestamp_ntz'2024-01-01' updated_at", "if(id % 4 = 0 or id > 9, null, cast(id % 6 as string)) id", "'c' cidade",
        "'i' car_incra", "'a' area_util", "'v' volume_calculado", "'p' proprietario", "'l' landviewer",
        "'x' registro_rural", "'g' google_maps", "timestamp_ntz'2024-01-01' dt_log", "'-1.5,-2.5' coordenada",
    )
    deals = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'copy', concat('d', id)) id", "if(id % 3 = 0, 'same', concat('n', id % 700)) name",
        "cast(null as timestamp_ntz) last_activity_at", "1L interactions", "true win",
        "cast(null as timestamp_ntz) closed_at",
        "case when id % 3 < 2 then 'o1' when id % 7 = 0 then null else concat('o', id % 50) end organization_id",
        "'on' organization_name", "'u' user_name", "'s' stage_id", "'sn' stage_name", "cast(null as string) lost_reason",
        "timestamp_ntz'2024-01-01' created_at", "timestamp_ntz'2024-01-01' updated_at",
        f"if(id % 11 = 0, null, if(id % 2 = 0, '{NEGOTIATION}', '{CAPTURE}')) funnel_name",
    )
    tasks = spark.range(2000).selectExpr("if(id % 2 = 0, concat('d', id % 900), 'copy') deal_id")
    frames = []
    for name, frame in {"o": organizations, "d": deals, "t": tasks}.items():
        frame.write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
    forest = spark.range(8).selectExpr("id % 5 as id_organizacao", "cast(concat('g', id) as binary) geom")

    plain = gold.gold_table(gold.gold_base(*frames, [NEGOTIATION]), forest, NEGOTIATION)
    base = gold.gold_base(*frames, [NEGOTIATION], min_hot_rows=50)
    analyzed = base._jdf.queryExecution().analyzed().toString()
    assert "_slice" in analyzed and "_slice_copy" in analyzed
    sliced = gold.gold_table(base, forest, NEGOTIATION, broadcast_bytes=0, min_hot_rows=50)
    assert "_slice" in sliced._jdf.queryExecution().analyzed().toString()
    rows = [sorted(map(str, f.collect())) for f in (plain, sliced)]
    assert rows[0] == rows[1] and len(rows[0]) > 200

    # the same by plain joins, with the distinct and the filter last
    counts = frames[2].groupBy("deal_id").agg(F.count("*").alias("qtde_tarefas"))
    o, d = frames[0].alias("o"), frames[1].alias("d")
    joined = o.join(d, F.col("company_id") == F.col("organization_id"), "left").join(
        counts, F.col("d.id") == F.col("deal_id"), "left"
    )
    columns = [F.col(f"o.{c}") for c in frames[0].columns if c not in ("company_id", "created_at", "updated_at")]
    columns += [F.col(f"d.{c}").alias(f"d_{c}") for c in ("name", "user_name", "stage_name", "lost_reason",
                                                         "created_at", "updated_at", "funnel_name")]
    distinct = joined.select(*columns, "qtde_tarefas").distinct()
    mapped = distinct.join(forest, F.col("id") == F.col("id_organizacao").cast("string"), "left")
    kept = mapped.where(F.col("d_funnel_name") == NEGOTIATION)
    ours = sliced.select("id_organizacao", "nome_organizacao", "nome_negociacao", "qtde_tarefas", "geom")
    theirs = kept.select("id", "name", "d_name", "qtde_tarefas", "geom")
    assert sorted(map(repr, map(tuple, ours.collect()))) == sorted(map(repr, map(tuple, theirs.collect())))


@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 0}, {"broadcast_rows": 0, "bloom_bits": 2}])
def test_tasks_of_other_deals_are_held_back(spark, tmp_path, options):
    """Few deals are wanted: what reaches the count is theirs, or little more, and the result is the same."""
    deals = spark.range(5000).selectExpr(
        "concat('d', id) id", "'n' name", "concat('o', id % 9) organization_id", "'u' user_name", "'s' stage_name",
        "'l' lost_reason", "timestamp_ntz'2024-01-01' created_at", "timestamp_ntz'2024-01-01' updated_at",
        f"if(id % 50 = 0, '{NEGOTIATION}', 'Outro') funnel_name",
    )
    organizations = spark.range(9).selectExpr(
        "concat('o', id) company_id", "concat('n', id) name", "'7' id", "'c' cidade", "'i' car_incra", "'a' area_util",
        "'v' volume_calculado", "'p' proprietario", "'l' landviewer", "'x' registro_rural", "'g' google_maps",
        "timestamp_ntz'2024-01-01' dt_log", "'-1.5,-2.5' coordenada",
    )
    tasks = spark.range(40_000).selectExpr("if(id % 9 = 0, null, concat('d', id % 5000)) deal_id")
    base = gold.gold_base(organizations, deals, tasks, [NEGOTIATION], **options)
    wanted = deals.where(F.col("funnel_name") == NEGOTIATION)
    held = joins.semi_reduce(tasks, "deal_id", wanted, "id", **options).count()
    sure = tasks.join(wanted, F.col("deal_id") == F.col("id"), "left_semi").count()
    assert held == sure if not options else sure <= held <= (1.3 * sure if len(options) == 1 else tasks.count())
    counts = tasks.groupBy("deal_id").agg(F.count("*").alias("n"))
    expected = wanted.join(counts, F.col("id") == F.col("deal_id"), "left").select("organization_id", "n").distinct()
    got = base.select(F.regexp_replace("nome_organizacao", "n", "o"), "qtde_tarefas")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_every_digest_of_a_hot_organization_is_sliced(spark):
    keyed = spark.createDataFrame([("hot", "d1"), ("hot", "d2"), ("hot", "d3"), ("cold", "d4"), ("cold", "d1")], "company_id string, digest string")
    found = gold._hot_digests(keyed, joins.HotKeys.of({"hot": 8, None: 4}), joins.HotKeys.of({"d1": 16}))
    assert found.counts() == {"d1": 16, "d2": 8, "d3": 8}


def test_silver_deals_with_a_large_funnel_table(lake):
    bronze, funnels = lake.read("bronze", "deals"), lake.read("bronze", "funnels")
    small = silver.silver_deals(bronze, funnels)
    large = silver.silver_deals(bronze, funnels, broadcast_bytes=0, min_hot_rows=2)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_plans(spark, lake, forest_map):
    deals = silver.silver_deals(lake.read("bronze", "deals"), lake.read("bronze", "funnels"))
    assert "BroadcastHashJoin" in plan_of(deals) and "SortMergeJoin" not in plan_of(deals)
    organizations = silver.silver_organizations(lake.read("bronze", "organizations"), AS_OF)
    assert plan_of(organizations).count("Exchange") == 1
    parts = lake.read("silver", "organizations"), lake.read("silver", "deals"), lake.read("bronze", "tasks")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = gold.gold_base(*parts, [NEGOTIATION])
        plan = plan_of(base)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "funnel_name" in plan[plan.index("PushedFilters") :] and "Inner" in plan and "LeftOuter" in plan
    # deals by deal, counts by deal, deals by organization, digests by organization, rows by digest, places by digest
    assert plan.count("Exchange hashpartitioning") == 6
    # the wanted deals go to the task scan, below the partial count
    assert plan.count("BroadcastExchange") == 1 and "LeftSemi" in plan
    assert plan.index("HashAggregate(keys=[deal_id") < plan.index("LeftSemi")
    # the wide columns cross an exchange once, made distinct by digest; the rows before carry the digest alone
    assert all("car_incra" not in x for x in plan.split("\n") if "HashAggregate" in x and "nome_negociacao" in x)
    assert joins.BROADCAST_BYTES <= 64 * 1024 * 1024


def test_json_layout_matches_the_log(spark, lake, tmp_path):
    body = json.dumps({"tasks": [{"id": "t", "deal_id": "d"}]})
    spark.createDataFrame([(1, 200, body)], "page int, status int, body string").write.parquet(str(tmp_path / "tasks"))
    for name, text in {
        "organizations": '{"organizations": []}', "deals": '{"deals": []}', "deal_stages": '{"deal_stages": []}',
        "deal_pipelines": "[]",
    }.items():
        spark.createDataFrame([(1, 200, text)], "page int, status int, body string").write.parquet(str(tmp_path / name))
    other = Lake(spark, str(tmp_path / "lake"), "medallion_log")
    jobs.run_bronze(spark, str(tmp_path), other, layout="log")
    jobs.run_silver(other, AS_OF)
    assert other.read("bronze", "tasks").count() == 1 and other.read("silver", "deals").count() == 0


def test_organizations_are_pivoted_in_tasks_of_bounded_size(spark, monkeypatch):
    from jatoba.queries import registry

    monkeypatch.setattr(registry, "PART_ROWS", 40)
    table = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select("c_custkey")
    dealt = registry.spread(table, "c_custkey")
    assert dealt.rdd.getNumPartitions() == -(-table.count() // 40) > 1
    assert sorted(dealt.collect()) == sorted(table.collect())
    plan = registry.QUERIES["silver_organizations"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and plan.index("Generate inline") < plan.index("RepartitionByExpression")


@pytest.mark.parametrize("n", [0, 1, 199, 200, 201, 1000])
def test_last_page_number_needs_no_pages(spark, n):
    from jatoba.queries import medallion

    rows = spark.range(n)
    pages = medallion._pages(medallion._numbered(rows, "id div 7", "id"), "all_of_them", "named_struct('id', id)")
    last = medallion._last_number(rows)
    assert last.first() == pages.agg(F.max("page").alias("end")).first()
    assert last.schema["end"].dataType == pages.schema["page"].dataType
    assert "Window" not in last._jdf.queryExecution().optimizedPlan().toString()
