"""Random inputs against small plain models."""

import json
import random

import pytest
from pyspark.sql import functions as F

from jatoba import schemas
from jatoba.functions import conditions as cond
from jatoba.functions import geo
from jatoba.operators.pivot import eav_pivot
from jatoba.sources import pages as source


def model_coordinate(register, coordinate):
    """Positions counted from 1, 0 when absent."""
    if register is None:
        return None
    if "," not in register:
        return coordinate
    return register[max(register.find("-"), 0) :]


def model_texts(full):
    if full is None or "-" not in full:
        return None, None
    dash, comma = full.find("-") + 1, full.find(",") + 1
    latitude = full[dash - 1 : dash - 1 + comma].replace(",", "")
    return latitude, full[comma:].replace(",", ".")


def test_coordinates(spark):
    rng = random.Random(7)

    def text():
        if rng.random() < 0.1:
            return None
        return "".join(rng.choice("-,,--.. 0123456789aé") for _ in range(rng.randrange(0, 14)))

    cases = [(i, text(), text()) for i in range(3000)]
    c = geo.full_coordinate(F.col("r"), F.col("k"))
    rows = (
        spark.createDataFrame(cases, "n int, r string, k string")
        .select("n", c.alias("c"))
        .select("n", "c", geo.latitude_text(F.col("c")), geo.longitude_text(F.col("c")))
        .collect()
    )
    assert len(rows) == len(cases)
    for row in rows:
        full = model_coordinate(*cases[row["n"]][1:])
        assert tuple(row)[1:] == (full, *model_texts(full)), cases[row["n"]]


def model_paging(pages, statuses, limit):
    """The loop of a client that asks page after page; without a first page there is nothing to put together."""
    if statuses.get(1, 200) != 200 or 1 not in pages:
        return None
    kept = []
    for number in sorted(set(pages) | set(statuses)):
        if statuses.get(number, 200) != 200:
            break
        kept += pages[number]
        if len(pages[number]) < limit:
            break
    return kept


@pytest.mark.parametrize("seed", range(12))
def test_paging(spark, seed):
    rng, limit = random.Random(seed), 3
    pages, statuses, rows = {}, {}, []
    for number in range(1, rng.randrange(2, 9)):
        size = limit if rng.random() < 0.8 else rng.randrange(0, limit)
        pages[number] = [f"{number}-{i}" for i in range(size)]
        statuses[number] = 200 if rng.random() < 0.85 else 503
        cut = rng.randrange(0, size + 1)
        chunks = [pages[number][:cut], pages[number][cut:]] if rng.random() < 0.5 else [pages[number]]
        for chunk in chunks:
            body = {"tasks": [{"id": i} for i in chunk]} if statuses[number] == 200 else {"error": "busy"}
            rows.append((number, statuses[number], json.dumps(body)))
    rng.shuffle(rows)
    log = spark.createDataFrame(rows, "page int, status int, body string")
    records = source.paged_records(*source.split_page_log(log), "tasks", schemas.TASK_RECORD, limit)
    expected = model_paging(pages, statuses, limit)
    if expected is None:
        with pytest.raises(Exception, match="page 1 is missing"):
            records.collect()
    else:
        assert sorted(r["id"] for r in records.collect()) == sorted(expected)


def test_pivot(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(["a", "b", None]), rng.choice(["ID", "CIDADE", "x", None]), rng.choice(["1", "10", "9", "é", "Z", None]))
        for _ in range(200)
    ]
    frame = spark.createDataFrame(rows, "id string, label string, value string")
    columns = {"ID": "id", "CIDADE": "cidade", "COORDENADA": "coordenada"}
    wide = eav_pivot(frame, [F.col("id").alias("key")], F.col("label"), F.col("value"), columns).collect()
    expected = {}
    for key in {r[0] for r in rows}:
        picked = [[v for k, name, v in rows if k == key and name == label and v is not None] for label in columns]
        expected[key] = [max(values, key=lambda v: v.encode()) if values else None for values in picked]
    assert {r["key"]: list(r)[1:] for r in wide} == expected and len(wide) == len(expected)


def test_grades(spark):
    def model(grade):
        bands = [("A", 90, 100.0000001), ("B", 80, 90), ("C", 70, 80), ("D", 0, 70)]
        letter = next((name for name, low, high in bands if low <= grade < high), None)
        return f"Seu conceito é {letter}!" if letter else "Favor inserir uma nota valida!"

    grades = [x / 4 for x in range(-40, 440)]
    rows = spark.createDataFrame([(g,) for g in grades], "g double").select("g", cond.grade_band_validated(F.col("g")))
    assert all(text == model(grade) for grade, text in rows.collect())
