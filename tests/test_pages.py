"""Landed pages: acceptance rule, polymorphic values, both layouts."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jatoba import schemas
from jatoba.operators.nested import flatten_structs
from jatoba.plans import bronze, jobs
from jatoba.sources import pages as source
from jatoba.sources.tables import Lake


def land(root: Path, collection: str, bodies, statuses=None):
    folder = root / collection
    folder.mkdir(parents=True)
    for number, body in enumerate(bodies, start=1):
        (folder / f"page={number}.json").write_text(json.dumps(body, indent=1, ensure_ascii=False), encoding="utf-8")
    if statuses:
        lines = ["page,status", *(f"{n},{s}" for n, s in statuses.items())]
        (root / f"{collection}_status.csv").write_text("\n".join(lines))


def tasks(*ids):
    return {"tasks": [{"id": i, "subject": f"s{i}"} for i in ids]}


CASES = {
    "short_last": ([tasks("a", "b"), tasks("c", "d"), tasks("e")], None, "abcde"),
    "short_middle": ([tasks("a", "b"), tasks("c"), tasks("d", "e")], None, "abc"),
    "failed_middle": ([tasks("a", "b"), {"error": "x"}, tasks("c", "d")], {1: 200, 2: 500, 3: 200}, "ab"),
    "empty_first": ([tasks()], None, ""),
    "empty_last": ([tasks("a", "b"), tasks()], None, "ab"),
    "failed_after_short": ([tasks("a"), tasks("b", "c")], {2: 500}, "a"),
    "all_full": ([tasks("a", "b"), tasks("c", "d")], None, "abcd"),
    "failed_page_not_landed": ([tasks("a", "b")], {1: 200, 2: 500}, "ab"),
}


@pytest.mark.parametrize("case", CASES)
def test_page_acceptance(spark, tmp_path, case):
    bodies, statuses, expected = CASES[case]
    land(tmp_path, "tasks", bodies, statuses)
    files = source.read_page_files(spark, str(tmp_path), "tasks")
    records = source.paged_records(*files, "tasks", schemas.TASK_RECORD, limit=2)
    assert sorted(r["id"] for r in records.collect()) == sorted(expected)

    rows = [(n, (statuses or {}).get(n, 200), json.dumps(b)) for n, b in enumerate(bodies, start=1)]
    rows += [(n, s, None) for n, s in (statuses or {}).items() if n > len(bodies)]
    log = spark.createDataFrame(rows, "page int, status int, body string")
    log.write.parquet(str(tmp_path / "log"))
    counted = log.withColumn("records", F.size(F.from_json("body", "tasks array<struct<id: string>>")["tasks"]))
    counted.write.parquet(str(tmp_path / "counted"))
    for name in ("log", "counted"):
        logged = source.read_page_log(spark, str(tmp_path / name))
        records = source.paged_records(*logged, "tasks", schemas.TASK_RECORD, limit=2)
        assert sorted(r["id"] for r in records.collect()) == sorted(expected)


def test_counted_pages_are_not_read_twice(spark, tmp_path):
    rows = [(1, 200, 1, json.dumps(tasks("a")))]
    spark.createDataFrame(rows, "page int, status int, records int, body string").write.parquet(str(tmp_path / "log"))
    bound = source.last_page(*source.read_page_log(spark, str(tmp_path / "log")), "tasks")
    assert "body" not in bound._jdf.queryExecution().executedPlan().toString()


def test_page_in_chunks(spark):
    rows = [(1, json.dumps(tasks("a"))), (1, json.dumps(tasks("b"))), (2, json.dumps(tasks("c")))]
    pages = spark.createDataFrame(rows, "page int, body string")
    answers = spark.createDataFrame([], "page int, status int")
    records = source.paged_records(pages, answers, "tasks", schemas.TASK_RECORD, limit=2)
    assert sorted(r["id"] for r in records.collect()) == ["a", "b", "c"]


ERROR = {"error": "x"}
BROKEN = {
    "envelope": ([tasks("a", "b"), ERROR, tasks("c", "d")], None),
    "first": ([ERROR], None),
    "status": ([tasks("a", "b"), tasks("c", "d"), tasks("e")], {1: 200, 2: None}),
    "gap": ([tasks("a", "b"), None, tasks("c", "d"), tasks("e")], None),
    "gap_unbounded": ([tasks("a", "b"), None, tasks("c", "d")], None),
    "gap_at_the_start": ([None, tasks("a", "b"), tasks("e")], None),
    "failed_first": ([ERROR, tasks("c", "d")], {1: 404}),
    "failed_alone": ([ERROR], {1: 500}),
    "failed_first_not_landed": ([None, tasks("a")], {1: 500}),
    "first_without_status": ([tasks("a")], {1: None}),
    "gap_before_failure": ([tasks("a", "b"), None, tasks("c", "d")], {4: 500}),
}


def _three_layouts(spark, tmp_path, bodies, statuses):
    for n, body in enumerate(bodies, start=1):
        if body is not None:
            land_one(tmp_path, n, body)
    if statuses:
        lines = ["page,status", *(f"{n},{'' if s is None else s}" for n, s in statuses.items())]
        (tmp_path / "tasks_status.csv").write_text("\n".join(lines))
    yield source.read_page_files(spark, str(tmp_path), "tasks")
    rows = [(n, (statuses or {}).get(n, 200), json.dumps(b), len(b["tasks"]) if "tasks" in b else None) for n, b in enumerate(bodies, start=1) if b is not None]
    rows += [(n, s, None, None) for n, s in (statuses or {}).items() if n > len(bodies)]
    log = spark.createDataFrame(rows, "page int, status int, body string, records int")
    yield source.split_page_log(log.drop("records"))
    yield source.split_page_log(log)


def land_one(root, number, body):
    (root / "tasks").mkdir(exist_ok=True)
    (root / "tasks" / f"page={number}.json").write_text(json.dumps(body))


@pytest.mark.parametrize("case", BROKEN)
def test_broken_exports_stop_the_load(spark, tmp_path, case):
    for pages in _three_layouts(spark, tmp_path, *BROKEN[case]):
        with pytest.raises(Exception, match="no records|are missing|page 1 is missing"):
            source.paged_records(*pages, "tasks", schemas.TASK_RECORD, limit=2).collect()


NUMBERED_WITH_HOLES = {
    "gap_unbounded": ([tasks("a", "b"), None, tasks("c", "d")], None, "abcd"),
    "gap": ([tasks("a", "b"), None, tasks("c", "d"), tasks("e"), tasks("f", "g")], None, "abcde"),
    "gap_at_the_start": ([None, tasks("a", "b"), tasks("e")], None, "abe"),
    "gap_before_failure": ([tasks("a", "b"), None, tasks("c", "d")], {4: 500}, "abcd"),
    "failed_alone": ([ERROR], {1: 500}, ""),
}


@pytest.mark.parametrize("case", NUMBERED_WITH_HOLES)
def test_numbers_with_holes_are_read_if_asked_for(spark, tmp_path, case):
    bodies, statuses, expected = NUMBERED_WITH_HOLES[case]
    for pages in _three_layouts(spark, tmp_path, bodies, statuses):
        records = source.paged_records(*pages, "tasks", schemas.TASK_RECORD, limit=2, whole=False)
        assert sorted(r["id"] for r in records.collect()) == sorted(expected)


@pytest.mark.parametrize("case", ["envelope", "first", "status", "first_without_status"])
def test_broken_pages_stop_a_load_with_holes_too(spark, tmp_path, case):
    for pages in _three_layouts(spark, tmp_path, *BROKEN[case]):
        with pytest.raises(Exception, match="no records"):
            source.paged_records(*pages, "tasks", schemas.TASK_RECORD, limit=2, whole=False).collect()


def test_what_lies_beyond_the_stop_may_be_broken(spark, tmp_path):
    bodies = [tasks("a", "b"), tasks("c"), None, ERROR, tasks("d", "e")]
    for pages in _three_layouts(spark, tmp_path, bodies, {1: 200, 2: 200, 4: None}):
        records = source.paged_records(*pages, "tasks", schemas.TASK_RECORD, limit=2)
        assert sorted(r["id"] for r in records.collect()) == ["a", "b", "c"]


def test_many_blocks_of_pages(spark):
    log = spark.range(1, 5001).selectExpr("cast(id as int) page", "200 status", "if(id = 4500, 1, 2) records", """'{"tasks":[{"id":"x"}]}' body""")
    bound = source.last_page(*source.split_page_log(log), "tasks", 2)
    assert bound.first()[0] == 4500
    with pytest.raises(Exception, match="are missing"):
        source.last_page(*source.split_page_log(log.where("page <> 2047")), "tasks", 2).collect()


def test_unreadable_status_and_missing_single_page(spark, tmp_path):
    land(tmp_path, "tasks", [tasks("a", "b"), tasks("c")])
    (tmp_path / "tasks_status.csv").write_text("page,status\n1,two hundred\n")
    with pytest.raises(Exception):
        source.paged_records(*source.read_page_files(spark, str(tmp_path), "tasks"), "tasks", schemas.TASK_RECORD, limit=2).collect()
    pages = spark.createDataFrame([(1, "{}")], "page int, body string")
    with pytest.raises(Exception, match="no records"):
        source.single_page_records(pages, "deal_stages", schemas.STAGE_RECORD).collect()
    answers = spark.createDataFrame([(1, 200)], "page int, status int")
    with pytest.raises(Exception, match="no records"):
        source.single_page_array(pages.select("page", F.lit(None).cast("string").alias("body")), answers, schemas.FUNNEL_RECORD).collect()


def test_broken_json_fails_the_load(spark):
    pages = spark.createDataFrame([(1, '{"tasks": [{"id": ')], "page int, body string")
    answers = spark.createDataFrame([], "page int, status int")
    with pytest.raises(Exception):
        source.paged_records(pages, answers, "tasks", schemas.TASK_RECORD, limit=2).collect()


def test_acceptance_has_no_join_and_no_driver_loop(spark, tmp_path):
    land(tmp_path, "tasks", [tasks("a", "b")])
    records = source.paged_records(
        *source.read_page_files(spark, str(tmp_path), "tasks"), "tasks", schemas.TASK_RECORD
    )
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("Subquery")[0]


def test_organizations(spark, tmp_path):
    field = {"value": "7", "created_at": "f", "updated_at": "f", "custom_field": {"label": "ID"}}
    body = {
        "organizations": [
            {"id": "1", "_id": "1", "name": "A", "created_at": "c", "updated_at": "u", "custom_fields": [
                field, {**field, "value": ["a", "b"]}, {**field, "value": None}, {"value": "x"}]},
            {"id": "2", "_id": "2", "name": "B", "created_at": "c", "updated_at": "u", "custom_fields": []},
            {"id": "3", "_id": "3", "name": "C"},
        ]
    }
    land(tmp_path, "organizations", [body])
    files = source.read_page_files(spark, str(tmp_path), "organizations")
    records = source.paged_records(*files, "organizations", schemas.ORGANIZATION_RECORD)
    frame = bronze.bronze_organizations(records)
    assert frame.columns == schemas.BRONZE_ORGANIZATIONS
    rows = sorted((tuple(r) for r in frame.collect()), key=str)
    assert rows == sorted(
        [
            ("1", "A", "ID", "7", "c", "u"),
            ("1", "A", "ID", '["a","b"]', "c", "u"),
            ("1", "A", "ID", None, "c", "u"),
            ("1", "A", None, "x", "c", "u"),
            ("2", "B", None, None, "c", "u"),
            ("3", "C", None, None, None, None),
        ],
        key=str,
    )


def test_deals_missing_parents(spark, tmp_path):
    full = {
        "id": "d1", "name": "n", "interactions": 3, "win": True, "organization": {"id": "o", "name": "O"},
        "user": {"name": "U"}, "deal_stage": {"id": "s", "name": "S"}, "deal_lost_reason": {"name": "R"},
    }
    land(tmp_path, "deals", [{"deals": [full, {"id": "d2", "organization": None, "win": None}]}])
    files = source.read_page_files(spark, str(tmp_path), "deals")
    frame = bronze.bronze_deals(source.paged_records(*files, "deals", schemas.DEAL_RECORD))
    assert frame.columns == schemas.BRONZE_DEALS
    rows = {r["id"]: tuple(r) for r in frame.collect()}
    assert rows["d1"] == ("d1", "n", None, 3, True, None, "o", "O", "U", "s", "S", "R", None, None)
    assert rows["d2"] == ("d2", *[None] * 13)


def test_funnels_and_stages(spark, tmp_path):
    funnels = [{"name": "A", "deal_stages": [{"_id": "1", "name": "x"}, {"name": "y"}]}, {"name": "B"},
               {"name": "C", "deal_stages": []}]
    land(tmp_path, "deal_pipelines", [funnels, [{"name": "Z", "deal_stages": [{"_id": "9"}]}]])
    land(tmp_path, "deal_stages", [{"deal_stages": [{"id": "1", "name": "x", "created_at": "c", "more": 1}]}])
    files = source.read_page_files(spark, str(tmp_path), "deal_pipelines")
    rows = bronze.bronze_funnels(source.single_page_array(*files, schemas.FUNNEL_RECORD)).collect()
    assert sorted((tuple(r) for r in rows), key=str) == [("A", "1", "x"), ("A", None, "y")]
    for status in (500, None):
        failed = spark.createDataFrame([(1, status)], "page int, status int")
        with pytest.raises(Exception, match="page 1 is missing"):
            source.single_page_array(files[0], failed, schemas.FUNNEL_RECORD).collect()
    pages, _ = source.read_page_files(spark, str(tmp_path), "deal_stages")
    stages = bronze.bronze_stages(source.single_page_records(pages, "deal_stages", schemas.STAGE_RECORD))
    assert [tuple(r) for r in stages.collect()] == [("1", "x", "c", None)]


def test_flatten_keeps_arrays(spark):
    frame = spark.range(1).select(
        F.expr("named_struct('b', named_struct('c', 1), 'd', array(1, 2))").alias("a"), F.lit(5).alias("e")
    )
    flat = flatten_structs(frame)
    assert flat.columns == ["a.b.c", "a.d", "e"] and tuple(flat.first()) == (1, [1, 2], 5)


def test_an_export_without_a_page_is_an_error(spark, tmp_path):
    """Nothing landed, and only later pages landed, in memory and from files."""
    for rows in ([], [(2, '{"tasks": [], "deal_stages": []}')]):
        made = spark.createDataFrame(rows, "page int, body string")
        made.write.mode("overwrite").parquet(str(tmp_path / "log"))
        answers = spark.createDataFrame([], "page int, status int")
        for pages in (made, spark.read.parquet(str(tmp_path / "log"))):
            for records in (
                source.paged_records(pages, answers, "tasks", schemas.TASK_RECORD),
                source.single_page_records(pages, "deal_stages", schemas.STAGE_RECORD),
                source.single_page_array(pages, answers, schemas.FUNNEL_RECORD),
            ):
                with pytest.raises(Exception, match="page 1 is missing"):
                    records.write.format("noop").mode("overwrite").save()


@pytest.mark.parametrize(
    "layout, collection", [("files", "organizations"), ("files", "deal_pipelines"), ("log", "deals"), ("log", "tasks"), ("log", "deal_pipelines")]
)
def test_a_failed_export_leaves_the_tables(spark, tmp_path, layout, collection):
    bodies = {"organizations": {"organizations": [{"id": "o"}]}, "deal_pipelines": [{"name": "A", "deal_stages": [{"_id": "1"}]}],
              "deal_stages": {"deal_stages": [{"id": "1"}]}, "deals": {"deals": [{"id": "d"}]}, "tasks": tasks("a")}
    lake = Lake(spark, str(tmp_path / "lake"), f"failed_{layout}_{collection}")
    for day, failed in enumerate((None, collection)):
        landing = tmp_path / f"day{day}"
        for name, body in bodies.items():
            status = 500 if name == failed else 200
            if layout == "files":
                land(landing, name, [body], {1: status})
            else:
                log = spark.createDataFrame([(1, status, json.dumps(body))], "page int, status int, body string")
                log.write.parquet(str(landing / name))
        if failed is None:
            jobs.run_bronze(spark, str(landing), lake, layout=layout)
        else:
            with pytest.raises(Exception, match="page 1 is missing"):
                jobs.run_bronze(spark, str(landing), lake, layout=layout)
    assert all(lake.read("bronze", t).count() == 1 for t in ("organizations", "funnels", "stages", "deals", "tasks"))
