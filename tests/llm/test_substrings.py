import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jatoba.llm import substrings
from jatoba.llm.substrings import compact_windows, cut_passages, find_passages
from tests.llm.frames import AWKWARD, documents, prose, with_clashing_columns


def plain_windows(h, first, width):
    out = set()
    for row, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        end = next((i for i in range(a, b) if h[i] == 0), b)

        def divide(left, right):
            if right - left < width:
                return
            c = min(range(left, right), key=lambda i: (h[i], i))
            out.add((row, c - a, left - a, right - 1 - a))  # noqa: B023
            divide(left, c)
            divide(c + 1, right)

        divide(a, end)
    return out


@pytest.mark.parametrize("width", [1, 2, 3, 7, 16])
def test_compact_windows_are_the_nodes_of_the_cartesian_tree(width):
    rng = np.random.default_rng(width)
    for top in (6, 1 << 40):
        first = np.cumsum([0, *rng.integers(0, 60, 12)])
        h = rng.integers(1, top, first[-1]).astype(np.uint64)
        for b in first[1:]:
            h[max(0, b - 3) : b] = 0
        row, c, left, right, value = compact_windows(h, first, width)
        got = set(zip(row.tolist(), c.tolist(), left.tolist(), right.tolist(), strict=True))
        want = plain_windows(h, first, width)
        if top > 6:
            assert got == want
        else:  # among equal hashes another place may be taken, but every window is there
            assert {g[0] for g in got} == {w[0] for w in want}
        assert (value == h[first[row] + c]).all()


def test_shingles_do_not_see_case_space_or_row_ends():
    column = pa.array(["A b c d e f", None, "x", "a  B\tc\nd e F", "f a b c d e"])
    h, first, _ = substrings.shingle_hashes(column, 5)
    rows = [h[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    assert (rows[0] == rows[3]).all() and rows[0][0] == rows[4][1] and (rows[0][2:] == 0).all() and rows[0][1] != 0


def planted(rng, copies):
    """Documents with one passage each from a few, at random places, with some words changed."""
    passages = [prose(rng, 80).split() for _ in range(5)]
    rows, truth = [], {}
    for i in range(copies):
        k, words = rng.randrange(5), prose(rng, rng.randint(60, 300)).split()
        passage = list(passages[k])
        if i % 3 == 2:
            passage[40] = "other"
        at = rng.randrange(len(words))
        rows.append((i, " ".join(words[:at] + passage + words[at:])))
        truth[i] = (k, at)
    return rows, truth


@pytest.mark.parametrize("partitions", [1, 13])
def test_planted_passages_are_found_where_they_are(spark, partitions):
    rng = random.Random(4)
    rows, truth = planted(rng, 60)
    rows += [(1000 + i, prose(rng, 200)) for i in range(30)] + AWKWARD
    found = find_passages(with_clashing_columns(documents(spark, rows)).drop("text_key").repartition(partitions)).collect()
    firsts = {k: min(i for i, (p, _) in truth.items() if p == k) for k in range(5)}
    assert {r.doc_id for r in found} == set(truth) - set(firsts.values())
    covered = {}
    for r in found:
        (k, at), (source_k, source_at) = truth[r.doc_id], truth[r.source_id]
        assert k == source_k and r.source_id < r.doc_id and r.similarity >= 0.8
        assert at - 6 <= r.start and r.start + r.length <= at + 86 and r.length >= 50
        assert abs((r.start - at) - (r.source_start - source_at)) <= 1
        covered.setdefault(r.doc_id, set()).update(range(r.start - at, r.start - at + r.length))
    assert all(len(c & set(range(80))) >= 74 for c in covered.values())


def test_whole_copies_near_copies_and_unlike_texts(spark):
    rng = random.Random(8)
    text = prose(rng, 200)
    words = text.split()
    near = " ".join(words[:100] + ["new", "words"] + words[100:])
    half = " ".join(words[:60] + prose(rng, 100).split())
    short = " ".join(words[:49])
    unlike = " ".join(w if i % 7 else "x" + w for i, w in enumerate(words))
    rows = [(1, text), (2, text), (3, near), (4, half), (5, short), (6, unlike), (None, text), (7, prose(rng, 200))]
    rows = find_passages(documents(spark, rows)).orderBy(F.desc("source_id")).collect()
    found = {r.doc_id: r for r in rows}  # the first source of each
    assert set(found) == {2, 3, 4, None}
    assert (found[2].start, found[2].length, found[2].similarity) == (0, 200, 1.0)
    assert found[3].length == 202 and 0.9 < found[3].similarity < 1
    assert (found[4].start, found[4].length) == (0, 60)
    assert found[None].source_id == 1


def test_two_passages_of_one_pair(spark):
    rng = random.Random(10)
    a, b = prose(rng, 70), prose(rng, 55)
    rows = [(1, f"{a} {prose(rng, 90)} {b}"), (2, f"{b} {prose(rng, 90)} {a} {prose(rng, 30)}"), (3, prose(rng, 40) + " " + a)]
    found = sorted({(r.doc_id, r.start, r.length) for r in find_passages(documents(spark, rows)).collect()})
    assert found == [(2, 0, 55), (2, 145, 70), (3, 40, 70)]


def test_stage_cuts_all_but_the_first(spark):
    rng = random.Random(11)
    passage, one, two, three = prose(rng, 60), prose(rng, 20), prose(rng, 25), prose(rng, 25)
    rows = [(1, f"{one}\n{passage}\n{three}"), (2, f"{two}\n{passage}"), (3, passage), (4, None), (5, ""), (6, two), (3, passage), (7, f"{passage}  tail\n")]
    docs = with_clashing_columns(documents(spark, rows))
    out = cut_passages(docs)
    assert out.dtypes == docs.dtypes
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: (rows[0][1], len(rows[0][1])), 2: (two + "\n", len(two) + 1), 4: (None, 0), 5: ("", 0), 6: (two, len(two)), 7: ("tail\n", 5)}


def test_empty_table(spark):
    assert find_passages(documents(spark, [])).collect() == [] and cut_passages(documents(spark, [])).collect() == []


def test_brute_force_on_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    words = {r.doc_id: [w for w in r.text.lower().encode().split()] for r in docs}
    holders: dict[tuple, set] = {}
    for d, w in words.items():
        for i in range(len(w) - 49):
            holders.setdefault(tuple(w[i : i + 50]), set()).add(d)
    repeated = {d for h in holders.values() if len(h) > 1 for d in h - {min(h)}}
    found = find_passages(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    assert repeated <= {r.doc_id for r in found}
    for r in found:
        x = words[r.doc_id][r.start : r.start + r.length]
        shingles = {tuple(x[i : i + 5]) for i in range(len(x) - 4)}
        source = words[r.source_id]
        there = {tuple(source[i : i + 5]) for i in range(len(source) - 4)}
        assert len(x) == r.length >= 50 and len(shingles & there) >= 0.8 * len(shingles)


def test_no_repeat_is_lost_among_common_lines(spark):
    """Signatures that many texts share: neither the first holder nor the one before need hold the passage."""
    rng = random.Random(20)
    lines = [prose(rng, 8) for _ in range(20)]
    rows = [[i, " ".join(rng.choice(lines) for _ in range(rng.randint(10, 60)))] for i in range(400)]
    truth = {}
    for _ in range(60):
        x, a = rng.randrange(200, 400), rng.randrange(200)
        source, words = rows[a][1].split(), rows[x][1].split()
        at, to = rng.randrange(len(source) - 55), rng.randrange(len(words))
        words[to:to] = source[at : at + rng.randint(52, 90)]
        rows[x][1] = " ".join(words)
    holders: dict[tuple, int] = {}
    for i, text in rows:
        words = text.split()
        for k in range(len(words) - 49):
            if holders.setdefault(tuple(words[k : k + 50]), i) != i:
                truth.setdefault(i, set()).update(range(k, k + 50))
    covered: dict[int, set] = {}
    for r in find_passages(documents(spark, rows).repartition(5)).collect():
        assert r.source_id < r.doc_id and r.length >= 50 and r.similarity >= 0.8
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.length))
    assert len(truth) > 30 and set(truth) <= set(covered)
    lost = sum(len(words - covered[i]) for i, words in truth.items())
    assert lost <= 0.01 * sum(map(len, truth.values()))


def covered_words(found):
    out: dict[int, set] = {}
    for r in found:
        out.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.length))
    return out


def unlike_copies(rng, copies, every):
    """Texts made of one by changing a word in ``every``, at random: they share runs of words, and next to no passage."""
    words = prose(rng, 500).split()
    return [[w if rng.randrange(every) else prose(rng, 1) for w in words] for _ in range(copies)]


def test_texts_that_share_runs_but_no_passage_are_not_all_paired(spark, monkeypatch):
    rng = random.Random(23)
    rows = [(i, " ".join(words)) for i, words in enumerate(unlike_copies(rng, 120, 14))]
    made, real = [], substrings._rest_links
    monkeypatch.setattr(substrings, "_rest_links", lambda *given, **named: made.append(real(*given, **named)) or made[-1])
    found = find_passages(documents(spark, rows)).collect()
    assert made and sum(links.count() for links in made) <= 20 * len(rows)
    assert all(r.similarity >= 0.8 and r.length >= 50 for r in found)


@pytest.mark.parametrize("members", [4096, 8])
def test_sources_among_many_are_found_in_one_block_and_in_many(spark, monkeypatch, members):
    monkeypatch.setattr(substrings, "MEMBERS", members)
    rng = random.Random(24)
    texts = unlike_copies(rng, 60, 16)
    truth = {}
    for x, a in ((30, 3), (41, 17), (59, 28)):  # neither the first nor the ones before
        texts[x][200:260] = texts[a][200:260]
        truth[x] = set(range(200, 260))
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    covered = covered_words(find_passages(documents(spark, rows).repartition(3)).collect())
    assert all(words <= covered[x] for x, words in truth.items())


def test_a_passage_whose_changed_word_is_in_its_middle():
    """Neither side of the change outweighs it alone, and what is around the passage is unlike."""
    rng = np.random.default_rng(5)
    x = rng.integers(1, 1 << 30, 400)
    a = rng.integers(1 << 30, 1 << 31, 400)
    a[100:121], a[126:148] = x[100:121], x[126:148]
    a[20:25] = x[20:25]
    found = substrings.verify(x, a, 46, 0.8)
    assert [(s, e, b) for s, e, b, _ in found] == [(100, 148, 100)] and found[0][3] >= 0.8


def test_rows_of_one_word_keep_few_windows(spark):
    column = pa.array(["a " * 500 + prose(random.Random(3), 100), "a " * 120])
    row, k, c, left, right, _ = substrings.Finder().windows(column)
    assert (row == 1).sum() <= 4 * 8 and (row == 0).sum() < 200
    assert (right - left >= substrings.Finder().width - 1).all()
    found = find_passages(documents(spark, [(1, "a " * 120), (2, "b c " + "a " * 500)])).collect()
    assert {w for r in found for w in range(r.start, r.start + r.length)} >= set(range(2, 502))


def test_rows_of_one_word_are_not_all_paired(spark, monkeypatch):
    rng = random.Random(21)
    rows = [(i, "".join(f"{prose(rng, 40)} {f'{w} ' * (rng.randint(26, 41) // len(w.split()))}" for w in ("a", "b", "c", "d", "e", "f g", "h i", "j k l"))) for i in range(60)]
    made, real = [], substrings._rest_links
    monkeypatch.setattr(substrings, "_rest_links", lambda *given, **named: made.append(real(*given, **named)) or made[-1])
    assert find_passages(documents(spark, rows)).collect() == []
    assert made and sum(links.count() for links in made) <= len(rows)


def test_passages_that_are_little_more_than_a_row_of_one_word(spark):
    rng = random.Random(22)
    rows = [(i, f"{prose(rng, 60)} {'a ' * rng.randint(26, 41)}{prose(rng, 60)}") for i in range(60)]
    before, after = prose(rng, 4), prose(rng, 4)
    rows += [(100 + i, f"{prose(rng, 30 + i)} {before} {'a ' * 44}{after} {prose(rng, 50)}") for i in range(3)]
    rows += [(200 + i, f"{prose(rng, 40 + i)} {'a ' * (60 + i)}{prose(rng, 50)}") for i in range(3)]
    covered: dict[int, set] = {}
    for r in find_passages(documents(spark, rows)).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.length))
    assert set(covered) - {200} == {101, 102, 201, 202}  # the first long row has shorter ones before it only
    assert all(set(range(30 + i, 82 + i)) <= covered[100 + i] for i in (1, 2))
    assert all(set(range(40 + i, 100 + 2 * i)) <= covered[200 + i] for i in (1, 2))
