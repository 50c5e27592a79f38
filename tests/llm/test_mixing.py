import random
import re
from collections import defaultdict

import duckdb
import pytest

from jatoba.llm import mixing
from tests.llm.frames import AWKWARD, documents, prose, with_clashing_columns


def water_filling(sizes, weights=(5, 2, 1), most=3):
    """Targets by giving the excess out again until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        if not free:
            return capped
        share = (total - sum(capped.values())) / sum(weight[s] for s in free)
        over = {s: most * sizes[s] for s in free if share * weight[s] >= most * sizes[s]}
        if not over:
            return capped | {s: share * weight[s] for s in free}
        capped |= over


def rows_of(rng):
    sources = ["b", "a", None, "ä", "tiny", "B", "empty"]
    rows = [(i, prose(rng, rng.randint(1, 60)), "en", rng.choices(sources[:6], [30, 8, 10, 5, 1, 4])[0]) for i in range(400)]
    return rows + [(900 + i, None, "en", "empty") for i in range(3)] + [(r[0], r[1], "en", "b") for r in AWKWARD]


def test_targets_and_taken_words(spark):
    rows = rows_of(random.Random(3))
    got = mixing.mix(documents(spark, rows)).collect()
    sizes, taken, target, biggest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in got:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.row.text or ""))
        assert r.taken in [k * r.size for k in range(4)]
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        biggest[r.source] = max(biggest[r.source], r.size)
    want = water_filling(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= biggest[s]
    assert len(got) == len(rows) and all(r.source_size == sizes[r.source] for r in got)


def test_equals_its_sql(spark):
    import pandas as pd

    rows = rows_of(random.Random(4))
    documents_ = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"]).astype({"doc_id": "Int64"})  # noqa: F841
    con = duckdb.connect()
    con.register("documents", documents_)
    want = sorted(map(repr, con.sql(mixing.SQL).fetchall()))
    got = mixing.mix(documents(spark, rows), whole=False).select("doc_id", "size", "source_size", "target", "taken")
    assert sorted(repr(tuple(r)) for r in got.collect()) == want


def test_keys_favour_quality_and_reruns_agree(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, 40) if i % 2 else "x" * 500 + " yy", "en", "a" if i < 400 else "b") for i in range(600)]
    first = {r.doc_id: r.times for r in mixing.mix(documents(spark, rows), weights=(1, 9)).collect()}
    again = {r.doc_id: r.times for r in mixing.mix(documents(spark, rows[::-1]).repartition(5), weights=(1, 9)).collect()}
    assert first == again
    good, bad = (sum(first[i] for i in range(400) if i % 2 == k) for k in (1, 0))
    assert good > 1.5 * bad


def test_mixed_repeats_documents(spark):
    rows = rows_of(random.Random(7))
    docs = with_clashing_columns(documents(spark, rows))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    times = defaultdict(int)
    for r in mixing.mix(documents(spark, rows)).collect():
        times[r.doc_id, r.row.text] += r.times
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id, r.text] += 1
    assert dict(got) == {k: v for k, v in times.items() if v}


def test_empty_and_wordless_tables(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    assert [r.target for r in mixing.mix(documents(spark, [(1, None), (2, " ")])).collect()] == [0.0, 0.0]
