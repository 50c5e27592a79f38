import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from jatoba.llm import language
from tests.llm.frames import AWKWARD, documents, prose, with_clashing_columns

ALPHABETS = {"aa": "abcdefé", "bb": "ghijklß", "cc": "mnopqrñ"}


def plain_marginals(score, transition, start):
    n = len(score)
    ahead, behind = np.empty_like(score), np.zeros_like(score)
    ahead[0] = start + score[0]
    for t in range(1, n):
        ahead[t] = np.logaddexp.reduce(ahead[t - 1][:, None] + transition, axis=0) + score[t]
    for t in range(n - 2, -1, -1):
        behind[t] = np.logaddexp.reduce(transition + (score[t + 1] + behind[t + 1])[None], axis=1)
    total = ahead + behind
    return np.exp(total - np.logaddexp.reduce(total, axis=1)[:, None])


def test_forward_backward_equals_the_plain_recursion():
    rng = np.random.default_rng(0)
    first = np.array([0, 0, 1, 64, 65, 130, 500])
    score, transition, start = rng.normal(size=(500, 3)) * 4, rng.normal(size=(3, 3)), rng.normal(size=3)
    got = language.forward_backward(score, transition, start, first)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b > a:
            assert np.abs(got[a:b] - plain_marginals(score[a:b], transition, start)).max() < 1e-9


def labelled(rng, n, words=40):
    langs = sorted(ALPHABETS)
    return [(i, prose(rng, rng.randint(5, words), ALPHABETS[langs[i % 3]]), langs[i % 3]) for i in range(n)]


@pytest.fixture(scope="module")
def model():
    rows = labelled(random.Random(1), 90)
    return language.fit([r[1] for r in rows], [r[2] for r in rows])


def test_gradients_are_those_of_the_likelihood():
    rng = np.random.default_rng(2)
    score, truth = rng.normal(size=(2, 5, 3)), rng.integers(0, 3, (2, 5))
    transition, start = rng.normal(size=(3, 3)), rng.normal(size=3)

    def likelihood(score, transition, start):
        total = 0.0
        for s, y in zip(score, truth, strict=True):
            ahead = start + s[0]
            for t in range(1, len(s)):
                ahead = np.logaddexp.reduce(ahead[:, None] + transition, axis=0) + s[t]
            path = start[y[0]] + s[np.arange(len(s)), y].sum() + transition[y[:-1], y[1:]].sum()
            total += path - np.logaddexp.reduce(ahead)
        return total

    given = [score, transition, start]
    for k, gradient in enumerate(language._gradients(score, truth, transition, start)):
        for at in np.ndindex(given[k].shape):
            moved = [v.copy() for v in given]
            moved[k][at] += 1e-6
            assert (likelihood(*moved) - likelihood(*given)) / 1e-6 == pytest.approx(gradient[at], abs=1e-4)


def test_runs_of_code_switched_text_are_found(spark, model):
    rng = random.Random(9)
    parts = [prose(rng, n, ALPHABETS[x]) for x, n in (("aa", 30), ("cc", 20), ("bb", 70))]
    found = language.predict(documents(spark, [(1, " ".join(parts))]), model, spans=True).first()
    assert [(s.lang, s.first, s.words) for s in found.spans] == [("aa", 0, 30), ("cc", 30, 20), ("bb", 50, 70)]
    assert found.lang_pred == "bb" and 0.5 < found.score < 0.65


def test_awkward_rows(spark, model):
    docs = with_clashing_columns(documents(spark, AWKWARD)).withColumn("letter", F.lit(0))
    found = language.predict(docs, model).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.score <= 1 for r in found)
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
        assert r.lang_pred in {"und", *ALPHABETS}


def test_learning_leaves_the_held_out_alone(spark):
    rows = labelled(random.Random(5), 240)
    wrong = [(d, t, "aa" if zlib.crc32(str(d).encode()) % 4 == 2 else lang) for d, t, lang in rows]
    right = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in language.identify(documents(spark, rows)).collect()}
    misled = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in language.identify(documents(spark, wrong)).collect()}
    assert right == misled
    for d, _, lang in rows:
        assert right[d][0] == (zlib.crc32(str(d).encode()) % 4 == 2) and right[d][1] == lang


def test_no_labels_no_rows_and_the_stage(spark):
    unlabelled = documents(spark, [(1, "some text", None)])
    assert [(r.lang_pred, r.score) for r in language.identify(unlabelled).collect()] == [("und", 0.0)]
    assert language.identify(documents(spark, [])).collect() == []
    rows = labelled(random.Random(6), 60)
    docs = documents(spark, rows + [(900, None), (901, "123 ..."), (None, rows[0][1], None), (902, "")]).withColumn("extra", F.lit(1))
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [r[0] for r in rows] and kept.count() == 61


def test_held_out_accuracy(spark, sf_dir="/root/testdata/sf0.01"):
    found = language.identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    right = found.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98


def test_every_language_is_learned(spark):
    """More than 64 of them, rare ones, and one that only has texts of over 20,000 characters."""
    rng = random.Random(11)
    ids = iter(i for i in range(10_000) if zlib.crc32(str(i).encode()) % 4 != 2)
    rows = [(next(ids), prose(rng, 20, ALPHABETS["aa"]), f"l{k:02}") for k in range(70) for _ in range(2 if k else 1)]
    long = [(next(ids), "1 " * 30_000 + prose(rng, 5_000, ALPHABETS["bb"]), "long") for _ in range(3)]
    assert all(len(t) > language.SAMPLE_CHARS for _, t, _ in long)
    assert language.fit_documents(documents(spark, rows + long)).labels == sorted({r[2] for r in rows + long})
    rows = labelled(rng, 90) + [(1000 + d, t, lang) for d, t, lang in long]
    rows = [(d, t, "long" if lang == "bb" else lang) for d, t, lang in rows if lang != "bb"]
    found = {r.doc_id: r.lang_pred for r in language.identify(documents(spark, rows)).collect()}
    assert found == {d: lang for d, _, lang in rows}


def test_one_document_of_a_language_is_drawn_at_least_and_repeated_ids_once(spark):
    rng = random.Random(12)
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, prose(rng, 6, ALPHABETS[lang]), lang) for i in ids for lang in ("aa", "bb")] + [(ids[0], prose(rng, 6, ALPHABETS["cc"]), "cc")] * 500
    assert language.fit_documents(documents(spark, rows), sample_docs=1).labels == ["aa", "bb", "cc"]


def test_excerpts_are_bounded_whole_words_of_the_text(spark):
    words = prose(random.Random(13), 20_000, ALPHABETS["aa"])
    got = documents(spark, [(1, words), (2, "é" * 50_000)]).select("doc_id", language._excerpt(F.col("text"), F.col("doc_id"), 4_000).alias("t")).orderBy("doc_id").collect()
    assert 2_000 < len(got[0].t) <= 4_003 and set(got[0].t.split()) <= set(words.split())
    assert got[1].t.split() == ["é" * 1_000] * 4


def test_the_stage_keeps_all_if_nothing_can_be_learned(spark):
    rows = [(1, "some text", None), (2, None, None), (3, "123", "aa"), (None, "more text", "aa")]
    kept = language.keep_identified(documents(spark, rows))
    assert sorted(map(str, kept.collect())) == sorted(map(str, documents(spark, rows).collect()))
