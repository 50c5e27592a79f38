import random

import pytest

from jatoba.llm.graph import components


def plain(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    return sorted((x, find(x)) for x in parent if find(x) != x)


def cases():
    rng = random.Random(0)
    yield "chain", [(i, i + 1) for i in range(60)]
    shuffled = rng.sample(range(200), 200)
    yield "shuffled chain", list(zip(shuffled, shuffled[1:], strict=False))
    yield "hub", [(500, i) for i in range(300)] + [(7, 900)]
    yield "repeated, reversed and loops", [(1, 2), (2, 1), (1, 2), (3, 3), (4, 5), (5, 4)]
    yield "random", [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]
    yield "negative", [(-5, 3), (3, -9), (2**62, -(2**62))]
    yield "none", []
    yield "only loops", [(1, 1)]


@pytest.mark.parametrize("name,links", list(cases()), ids=lambda c: c if isinstance(c, str) else "")
def test_components_equal_union_find(spark, name, links):
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert sorted(tuple(r) for r in found.where("node <> component").collect()) == plain(links)
