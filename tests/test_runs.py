"""Runs that stop on the way: what is finished stays, what is published belongs together."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from jatoba import schemas
from jatoba.operators import publish as publishing
from jatoba.plans import jobs
from jatoba.plans.ledger import Ledger, files_digest, rows_digest
from jatoba.session import exists
from jatoba.sources.tables import Lake
from tests.test_medallion import CAPTURE, NEGOTIATION, deal, organization
from tests.test_pages import land

STEPS = [
    "begin", "bronze organizations", "bronze funnels", "bronze stages", "bronze deals", "bronze tasks", "silver organizations",
    "silver deals", "gold base", "gold folder", "gold negotiations", "gold captures", "gold publication",
]


def landing(root, version="v1"):
    land(root, "organizations", [{"organizations": [organization("o1", f"Org {version}", ("ID", "7"), ("COORDENADA", "-1.5,-2.5"), ("REGISTRO RURAL", "x"))]}])
    land(root, "deal_pipelines", [[{"name": NEGOTIATION, "deal_stages": [{"_id": "n"}]}, {"name": CAPTURE, "deal_stages": [{"_id": "c"}]}]])
    land(root, "deal_stages", [{"deal_stages": [{"id": "n", "name": "x"}]}])
    land(root, "deals", [{"deals": [deal("d1", "o1", "n", version), deal("d2", "o1", "c", version)]}])
    land(root, "tasks", [{"tasks": [{"id": "t1", "deal_id": "d1"}, {"id": "t2", "deal_id": "d1"}]}])
    return str(root)


@pytest.fixture
def forest_map(spark):
    return spark.createDataFrame([(7, bytearray(b"g"))], "id_organizacao bigint, geom binary")


@pytest.fixture
def one_after_the_other(monkeypatch):
    monkeypatch.setattr(jobs, "together", lambda *loads: [load() for load in loads])


class Killed(Exception):
    pass


def pair(lake):
    """What readers see of the two gold tables."""
    return [
        sorted(tuple(r) for r in lake.read("gold", name).select("nome_organizacao", "nome_negociacao", "qtde_tarefas", "dt_carga").collect())
        for name in jobs.GOLD_TABLES
    ]


def kill_after(monkeypatch, step, seen):
    finish = Ledger.finish

    def noted(self, name, digest, output):
        finish(self, name, digest, output)
        seen.append(name)
        if name == step:
            raise Killed(step)

    monkeypatch.setattr(Ledger, "finish", noted)


def test_a_run_goes_on_where_it_was_killed(spark, tmp_path, forest_map, one_after_the_other):
    """Killed after each step in turn: every step is run once, and the result is that of a run in one go."""
    source = landing(tmp_path / "pages")
    whole = Lake(spark, str(tmp_path / "whole"), "runs_whole")
    as_of = datetime(2024, 1, 2)
    jobs.run_all(spark, source, whole, forest_map, "one", as_of=as_of, limit=5)
    lake = Lake(spark, str(tmp_path / "lake"), "runs_killed")
    seen, counted = [], {}
    for step in [*STEPS, None]:
        with pytest.MonkeyPatch.context() as patch:
            kill_after(patch, step, seen)
            if step is None:
                jobs.run_all(spark, source, lake, forest_map, "night", as_of=as_of, limit=5)
            else:
                with pytest.raises(Killed):
                    jobs.run_all(spark, source, lake, forest_map, "night", as_of=as_of if step == "begin" else None, limit=5)
        ledger = Ledger(lake, "night")
        tracker = spark.sparkContext._jsc.sc().statusTracker()
        now = {s: len(tracker.getJobIdsForTag(ledger.tag(s))) for s in STEPS}
        # No job has been added to a step that was finished before.
        assert all(now[s] == n for s, n in counted.items() if s in seen[:-1] and s not in ("gold publication",)), (step, now, counted)
        counted = now
    assert seen == STEPS and sum(counted.values()) > len(STEPS)
    assert pair(lake) == pair(whole) and len(pair(lake)[0]) == len(pair(lake)[1]) == 1
    assert {r["step"].replace("_", " ") for r in Ledger(lake, "night").rows().collect()} == set(STEPS)
    for layer, names in {"bronze": ["organizations", "funnels", "stages", "deals", "tasks"], "silver": ["organizations", "deals"]}.items():
        for name in names:
            a, b = (sorted(map(str, x.read(layer, name).collect())) for x in (lake, whole))
            assert a == b


def test_changed_input_is_loaded_again_and_only_what_follows(spark, tmp_path, forest_map):
    source, lake = tmp_path / "pages", Lake(spark, str(tmp_path / "lake"), "runs_changed")
    landing(source)
    jobs.run_all(spark, str(source), lake, forest_map, "day", limit=5)
    places = {(layer, n): lake.place(layer, n) for layer, n in [("bronze", "organizations"), ("bronze", "deals"), ("silver", "organizations"), ("silver", "deals"), ("gold", "run")]}
    before = pair(lake)
    jobs.run_all(spark, str(source), lake, forest_map, "day", limit=5)
    assert all(lake.place(*key) == place for key, place in places.items())
    (source / "deals" / "page=1.json").write_text(json.dumps({"deals": [deal("d9", "o1", "c", "changed")]}))
    jobs.run_all(spark, str(source), lake, forest_map, "day", limit=5)
    moved = {key for key, place in places.items() if lake.place(*key) != place}
    assert moved == {("bronze", "deals"), ("silver", "deals"), ("gold", "run")}
    assert pair(lake) == [[], [("Org v1", "changed", None, before[0][0][3])]]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Bronze and silver, and a first run of the gold tables."""
    root = tmp_path_factory.mktemp("pair")
    lake = Lake(spark, str(root / "lake"), "runs_pair")
    jobs.run_all(spark, landing(root / "pages"), lake, mapped(spark, "first"), "first", limit=5)
    return lake


def mapped(spark, version):
    return spark.createDataFrame([(7, bytearray(version.encode()))], "id_organizacao bigint, geom binary")


def versions(lake):
    """The map that each of the two tables was made with."""
    return [[bytes(r["geom"]).decode() for r in lake.read("gold", name).collect()] for name in jobs.GOLD_TABLES]


FAULTS = {
    # Where the second run stops: in the tables, between them, before and in the move, after it.
    "negotiations": (jobs, "write_member", lambda args: args[3] == "negotiations"),
    "captures": (jobs, "write_member", lambda args: args[3] == "captures"),
    "manifest": (publishing, "write_text", lambda args: True),
    "move": (publishing, "_move_run", lambda args: True),
    "views": (publishing, "_show", lambda args: True),
}


@pytest.mark.parametrize("case", FAULTS)
def test_readers_see_the_tables_of_one_run(spark, loaded, one_after_the_other, monkeypatch, case):
    module, name, hit = FAULTS[case]
    real, before = getattr(module, name), versions(loaded)
    assert before[0] == before[1] and len(before[0]) == 1

    def stopped(*args, **options):
        if hit(args):
            raise Killed
        return real(*args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(module, name, stopped)
        with pytest.raises(Killed):
            jobs.run_gold(loaded, mapped(spark, case), ledger=Ledger(loaded, case))
    assert versions(loaded) == ([[case], [case]] if case == "views" else before)
    jobs.run_gold(loaded, mapped(spark, case), ledger=Ledger(loaded, case))
    assert versions(loaded) == [[case], [case]]
    manifest = publishing.published(loaded, "gold")
    assert manifest["run"] == case and manifest["tables"] == list(jobs.GOLD_TABLES) and len(manifest["inputs"]) == 3
    shown = [f.simpleString() for f in loaded.read("gold", "captures").schema]
    assert shown == [f.simpleString() for f in spark.createDataFrame([], schemas.GOLD).schema]
    base = Ledger(loaded, case).rows().where("step = 'gold_base'").first()["output"]
    assert not exists(spark, base)


def test_an_incomplete_run_is_not_published(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), "runs_incomplete").create()
    folder = lake.fresh_folder("gold", "run")
    publishing.write_member(spark.range(2), lake, "gold", "a", "id bigint", folder)
    with pytest.raises(RuntimeError, match="b is not complete"):
        publishing.publish(lake, "gold", ["a", "b"], "id bigint", folder)
    # A table of an earlier layout makes way for the view.
    spark.range(9).write.saveAsTable(lake.table("gold", "b"))
    publishing.write_member(spark.range(3), lake, "gold", "b", "id bigint", folder)
    publishing.write_member(spark.range(1), lake, "gold", "b", "id bigint", folder)
    publishing.publish(lake, "gold", ["a", "b"], "id bigint", folder)
    assert lake.read("gold", "a").count() == 2 and lake.read("gold", "b").count() == 1 and lake.read("gold", "b").columns == ["id"]


def test_digests(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("one")
    first = files_digest(spark, str(tmp_path / "in"), str(tmp_path / "missing"))
    assert first == files_digest(spark, str(tmp_path / "in"), str(tmp_path / "missing")) and first[1][1] is None
    (tmp_path / "in" / "b").write_text("two")
    assert files_digest(spark, str(tmp_path / "in"), str(tmp_path / "missing")) != first
    rows = spark.range(50).withColumn("x", F.lit("y"))
    assert rows_digest(rows) == rows_digest(rows.orderBy(F.desc("id"))) != rows_digest(rows.where("id > 0"))
    with pytest.raises(ValueError):
        Ledger(Lake(spark, str(tmp_path), "x"), "a/b")
