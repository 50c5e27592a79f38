import numpy as np
import pytest
from pyspark.sql import functions as F

from jatoba.llm import embeddings, neighbours
from jatoba.llm.vectors import usable
from tests.llm.frames import EMBEDDINGS, with_clashing_columns

NAN, INF = float("nan"), float("inf")
AWKWARD = [(900, None, 1), (901, [], 1), (902, [0.0] * 8, 1), (903, [NAN] + [1.0] * 7, 1), (904, [INF] + [1.0] * 7, 1), (905, [None] + [1.0] * 7, 1), (906, [1.0] * 8, None), (None, [1.0] * 8, 1), (907, [1.0, 2.0], 1), (908, [2.0, 4.0], 1)]


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y) for i, v, y in rows], EMBEDDINGS)


def clustered(seed, n, dim=8):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        if i % 3 and out:
            v = np.array(out[rng.integers(len(out))][1]) + rng.normal(0, 0.12, dim)
        else:
            v = rng.normal(size=dim)
        out.append((i, v.astype(np.float32).tolist(), int(rng.integers(3))))
    return out


def plain_links(rows, threshold):
    good = [(i, np.array(v, np.float32).astype(np.float64), y) for i, v, y in rows if i is not None and y is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n, parent = [0] * len(good), list(range(len(good)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(good)):
        for b in range(a):
            (_, u, x), (_, v, y) = good[a], good[b]
            if x == y and len(u) == len(v) and u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= threshold:
                n[a] += 1
                n[b] += 1
                parent[find(a)] = find(b)
    least = {}
    for k, (i, *_) in enumerate(good):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, n[k], least[find(k)]) for k, (i, *_) in enumerate(good))


@pytest.mark.parametrize("seed,list_size,block", [(0, 4096, 4096), (1, 20, 16), (2, 50, 8)])
def test_links_equal_brute_force(spark, monkeypatch, seed, list_size, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = clustered(seed, 240)
    rows += [(300 + k, rows[5][1], rows[5][2]) for k in range(4)] + [(400, rows[7][1], 2), (401, rows[7][1], 2), (401, rows[7][1], 2)]
    found = embeddings.near_duplicates(with_clashing_columns(vectors(spark, rows + AWKWARD)), list_size=list_size).collect()
    assert len(found) == len(rows) + len(AWKWARD)
    lone = {900, 901, 902, 903, 904, 905, 906, None}
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in found if r.vec_id not in lone)
    assert got == plain_links(rows + AWKWARD, 0.93)
    for r in found:
        assert r.kept == (r.vec_id is not None and r.vec_id == r.component_id)
        if r.vec_id in lone:
            assert r.n_links == 0 and r.component_id == r.vec_id


def test_no_list_that_may_hold_a_link_is_left_out():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    model = embeddings.quantiser(x, 12)
    home, codes, error = model.encode(x)
    radius = 0.4
    near = np.sqrt(np.maximum(((x[:, None] - x[None]) ** 2).sum(axis=2), 0)) <= radius
    assert model.probes(x, radius)[:, home][near].all()
    for k in range(12):
        y = np.flatnonzero(home == k)
        pairs = {(a, b) for i, j in embeddings.linked_pairs(model, k, x, x[y], 1 - radius**2 / 2) for a, b in zip(i.tolist(), y[j].tolist(), strict=True)}
        a, b = np.nonzero(x @ x[y].T >= 1 - radius**2 / 2)
        assert pairs == set(zip(a.tolist(), y[b].tolist(), strict=True))


@pytest.mark.parametrize("lists,size", [(1, 1000), (40, 1000), (40, 150), (3, 64)])
def test_a_vector_is_sent_to_blocks_and_not_to_each_list(monkeypatch, lists, size):
    monkeypatch.setattr(embeddings, "SENT", 100)
    rng = np.random.default_rng(lists)
    x = rng.normal(size=(600, 16))  # no structure: nearly all lists are probed
    model = embeddings.quantiser(x, lists)
    classes = np.arange(600) * 7
    home = embeddings.placed(model, None, x, classes, 0.4)[0]
    layout = embeddings.Layout(np.append(0, np.cumsum(np.bincount(home, minlength=len(model.centroids)))), size)
    home, own, row, block = embeddings.placed(model, layout, x, classes, 0.4)
    asking = [np.unique(own[row][block == b]) for b in range(layout.blocks)]
    pieces = list(embeddings.sent(own, row, block, asking))
    assert max(len(p[0]) for p in pieces) <= 100  # however many lists or blocks
    at, to, part, probe = (np.concatenate(v) for v in zip(*pieces, strict=True))
    assert len(at) <= (layout.blocks + 1) * len(x) and np.bincount(own).max() <= 1.5 * size
    # Every pair of vectors that may link meets once, the one of the lower block asking.
    meets = {(int(b), int(p)): (set(at[(to == b) & (part == p) & ~probe].tolist()), set(at[(to == b) & (part == p) & probe].tolist())) for b, p in zip(to, part, strict=True)}
    probes = model.probes(x / np.linalg.norm(x, axis=1, keepdims=True), 0.4)
    for i, j in rng.integers(0, 600, (2000, 2)).tolist():
        if own[i] < own[j] and probes[i, home[j]]:
            assert j in meets[own[j], own[i]][0] and i in meets[own[j], own[i]][1]
        if own[i] == own[j]:
            assert {i, j} <= meets[own[i], own[i]][0]


def test_empty_tables(spark):
    assert embeddings.near_duplicates(vectors(spark, [])).collect() == []
    assert neighbours.search(vectors(spark, []), F.col("vec_id") % 20 == 0).collect() == []
    assert vectors(spark, AWKWARD).where(usable(F.col("embedding"))).count() == 4


def plain_nearest(rows, top, every=20):
    good = [(i, np.array(v, np.float32).astype(np.float64)) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in good:
        if i % every == 0:
            best = {}
            for j, x in good:
                if j != i and len(x) == len(q):
                    best[j] = max(best.get(j, -INF), float((q * x).sum()))
            out[i] = sorted((-s, j) for j, s in best.items())[:top]
    return out


def test_all_parts_give_the_exact_answer(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    monkeypatch.setattr(neighbours, "QUERY_SLICE", 4)
    rows = clustered(5, 300) + [(500 + k, [1.0] * 8, 1) for k in range(30)] + [(700, [1.0] * 8, 1), (700, [1.0] * 8, 1)] + AWKWARD
    found = neighbours.search(with_clashing_columns(vectors(spark, rows)).drop("query"), F.col("vec_id") % 20 == 0, top=5, parts=4, probes=4).collect()
    want = plain_nearest(rows, 5)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    assert got.keys() == {q for q, w in want.items() if w}
    for q in got:
        assert [j for _, j in got[q]] == [j for _, j in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], atol=1e-12)


def test_parts_are_balanced_and_learned():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 16)) * 3
    x = centres[rng.integers(8, size=1600)] + rng.normal(size=(1600, 16)) * 0.5
    graph = neighbours.neighbour_graph(x, 8)
    part = neighbours.balanced_parts(x, graph, 8)
    assert np.bincount(part, minlength=8).max() <= 1600 / 8 * 1.06
    assert (part[graph] == part[:, None]).mean() > 0.7
    router = neighbours.fit(x, 8)
    top = router.ranked(x)[:, :2]
    near = router.ranked(x)[:, 0][graph]
    assert (near[:, :, None] == top[:, None, :]).any(axis=2).mean() > 0.9


def test_recall_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = {}
    for r in neighbours.search(rows, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    want = plain_nearest([(r.vec_id, r.embedding, 0) for r in rows.collect()], 20)
    hits = sum(len(found[q] & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values())), hits / sum(map(len, want.values()))
