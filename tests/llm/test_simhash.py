import random
import re

import numpy as np
import pytest
import xxhash

from jatoba.llm import simhash
from jatoba.llm.simhash import anchors, keep_one, near_duplicates
from tests.llm.frames import AWKWARD, documents, prose, with_clashing_columns


def plain_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, threshold=2):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= threshold:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [least[find(i)] for i in range(len(ids))]


def near_copies(rng):
    rows = []
    for base in range(12):
        text = prose(rng, rng.randint(3, 120))
        rows.append((base, text))
        for copy in range(rng.randint(0, 4)):
            words = text.split(" ")
            for _ in range(copy):
                words[rng.randrange(len(words))] = "changed"
            rows.append((100 + 10 * base + copy, rng.choice([" ", "\n", "  \t"]).join(words).upper()))
    return rows


def test_results_equal_brute_force(spark):
    rows = near_copies(random.Random(1)) + AWKWARD
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id) for r in near_duplicates(documents(spark, rows)).collect())
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    roots = plain_components([d for d, *_ in rows], fps)
    want = sorted((d if d is not None else -1, f"{f:016x}", c) for (d, *_), f, c in zip(rows, fps, roots, strict=True))
    assert got == want


@pytest.mark.parametrize("threshold", [0, 1, 2])
def test_links_are_all_found_and_chains_are_followed(spark, threshold):
    rng = np.random.default_rng(threshold)
    seeds = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    all_fps = list(seeds)
    for f in seeds:
        for _ in range(6):  # chains whose ends are far apart
            for _ in range(int(rng.integers(1, 4))):
                f = f ^ (np.uint64(1) << np.uint64(rng.integers(0, 64)))
            all_fps.append(f)
    fps = sorted({int(f) for f in all_fps} | {0, 2**64 - 1})
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    got = {(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in simhash.links(df, threshold).collect()}
    want = {(a, b) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= threshold}
    assert {frozenset(p) for p in got} == {frozenset(p) for p in want} and len(got) == len(want) // 2


def test_anchors_cover_every_fingerprint_once_at_home():
    fp = np.random.default_rng(0).integers(0, 1 << 63, 3000, dtype=np.uint64)
    index, anchor, home = anchors(fp, 2)
    assert (np.sort(index[home]) == np.arange(len(fp))).all()
    differ = np.bitwise_count((fp[index] & np.uint64((1 << 46) - 1)) ^ anchor.astype(np.uint64))
    assert differ[home].max() <= 6 and differ.max() <= 8
    assert len(set(zip(index.tolist(), anchor.tolist(), strict=True))) == len(index)


def test_one_row_of_each_group_stays(spark):
    docs = documents(spark, [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (7, "p q r s t"), (None, "p q r s t"), (None, "z z y"), (None, None), (5, None), (2, "")])
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect()) == [(False, 1, "a b c d"), (False, 2, ""), (False, 7, "p q r s t"), (True, 0, "z z y")]


def test_empty_tables_and_clashing_columns(spark):
    assert near_duplicates(documents(spark, [])).collect() == []
    assert keep_one(documents(spark, [])).collect() == []
    docs = with_clashing_columns(documents(spark, [(1, "a b c"), (2, "a b c"), (3, "d e f")]))
    assert sorted((r.doc_id, r.component_id) for r in near_duplicates(docs).collect()) == [(1, 1), (2, 1), (3, 3)]
    kept = keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
