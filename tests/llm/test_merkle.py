"""Trees, multiproofs and tampering against a plain model."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from jatoba.llm import merkle
from tests.llm.frames import AWKWARD, DOCUMENTS, documents, prose, with_clashing_columns


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])])


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][k : k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def path(made, place):
    for level in made[:-1]:
        first = place - place % 8
        yield "".join(level[first:place]), "".join(level[place + 1 : first + 8])
        place //= 8


def model(rows):
    groups = defaultdict(list)
    for r in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]) if r[1] is not None else None
        touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), leaf((r[0], low, *r[2:])) if touched else None))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for place, (there, doc_id, own, claimed) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            proof = [*path(trees[g], place), *path(top, k)]
            folded = claimed or own
            for left, right in proof:
                folded = H(left, folded, right)
            out.append((doc_id if there else None, own, trees[g][-1][0], top[-1][0], H(*[a + b for a, b in proof]), folded, folded == top[-1][0]))
    return out


def agree(frame, rows):
    assert sorted(map(repr, (tuple(r) for r in frame.collect()))) == sorted(map(repr, model(rows)))


def test_awkward_rows_and_many_languages(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 5).title(), rng.choice(["pt", "en", None, "", "-", "=", "é", "z" * 50]), "s") for i in range(300)]
    rows += [(1000 + i, "A", f"lang{i}", None) for i in range(70)] + [(5, "Other Text", "pt", "s")] * 20 + [(6, "LONG " * 200_000, "en", "s")]
    rows += [(i, t, "en", "s") for i, t in AWKWARD]
    rows = [(*r, None if i % 7 == 0 else len(r[1] or "")) for i, r in enumerate(rows)]
    rng.shuffle(rows)
    agree(merkle.check_documents(with_clashing_columns(spark.createDataFrame(rows, DOCUMENTS))), rows)


@pytest.mark.parametrize("n", [0, 1, 8, 9])
def test_small_tables(spark, n):
    rows = [(i, "Text", "en", "s", 4) for i in range(n)]
    agree(merkle.check_documents(documents(spark, [r[:4] for r in rows])), rows)


def test_a_language_of_several_blocks(spark):
    n = merkle.BLOCK + 7000
    rows = [(i * 3 - 50, f"Row {i % 90}", "en" if i % 50 else "pt", "s", 6) for i in range(n)] + [(7, "Equal", "en", "s", 5)] * 900
    frame = spark.createDataFrame(rows, DOCUMENTS).repartition(5)
    agree(merkle.check_documents(frame), rows)


def test_proofs_of_some_leaves_fetch_what_they_lack(spark):
    n = 2 * merkle.BLOCK + 100
    rows = [(i, f"T{i}", "en", "s", 2) for i in range(n)]
    built = merkle.manifest(merkle.document_leaves(spark.createDataFrame(rows, DOCUMENTS).repartition(4)), "doc_id")
    chosen = [0, 1, 9, 40_000, n - 1]
    got = merkle.prove(built, built.leaves.where(F.col("doc_id").isin(chosen)), with_siblings=True).collect()
    want = {m[0]: m for m in model(rows) if m[0] in chosen}
    assert len(got) == len(chosen)
    for r in got:
        assert r.leaf == want[r.doc_id][1] and r.verified and r.proof_sha256 == want[r.doc_id][4] == H(*r.siblings)


def test_the_octopus_asks_for_the_least():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 700)
        leaves = [H(str(i)) for i in range(n)]
        made = levels(leaves)
        wanted = sorted(rng.sample(range(n), rng.randint(1, min(n, 12))))
        missing = merkle.octopus(np.array(wanted), n)
        # Needed are the siblings on the paths, less what lies above a wanted leaf.
        paths = [{p // 8**k for p in wanted} for k in range(len(made))]
        needed = {(k, i) for k in range(len(made) - 1) for p in paths[k] for i in merkle.run_of(p, n, k) if i not in paths[k]}
        assert len(missing) == len(set(missing)) and set(missing) == needed
        fetched = {(k, i): made[k][i] for k, i in missing}
        proofs = merkle.expand({p: leaves[p] for p in wanted}, n, fetched, wanted)
        for p, proof in zip(wanted, proofs, strict=True):
            assert proof == list(path(made, p)) and merkle.fold(leaves[p], proof) == made[-1][0]
            assert not proof or merkle.fold(H("other"), proof) != made[-1][0]
