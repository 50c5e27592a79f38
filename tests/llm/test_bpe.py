"""Ids against the tokenizer library and against a plain merge, and back to bytes."""

import random
import struct
from hashlib import sha256

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from jatoba.llm import bpe
from tests.llm.frames import AWKWARD, DOCUMENTS, documents, prose, with_clashing_columns

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    "  two  blanks \n\n  lines\t\ttabs   ", "it's we'll I'VE don't 'x '' ’s", "a" * 3000, "ab" * 2000 + "a", "=" * 500 + "-" * 63 + "~" * 64,
    "日本語のテキスト、かな。" * 40, "😀😃 👩‍👩‍👧 é é ﬁ İ ß", "\x00\x01\x1c x\x1d\x85y\xa0z w　v", "1234567890" * 30, "x\r\n\r\n y",
    "Supercalifragilistic" * 20, "<|endoftext|> <|startoftext|>", " ", "\n", "   ", "z  ", "١٢ ½ Ⅳ", "\U00010000\U0010ffff" * 50,
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def want(library, rows):
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        yield doc_id, len(ids), sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), sha256((text or "").encode()).hexdigest(), ids


def test_ids_are_those_of_the_library(spark, library):
    rng = random.Random(1)
    rows = [(i, t) for i, t in enumerate(ODD)] + AWKWARD + [(100 + i, prose(rng, 200, "etaoinsh,.\n 'é字9")) for i in range(40)]
    rows += [(200, "".join(rng.choices("abcdefghijklmnop", k=4000))), (201, "word " * 100_000)]
    frame = with_clashing_columns(documents(spark, rows)).repartition(3)
    found = bpe.encode(frame, PATH, public_tokenizers.PATTERN, with_ids=True)
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in found.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want(library, rows)))
    back = {(r.doc_id, bytes(r.decoded)) for r in bpe.decode(found, PATH).collect()}
    assert back == {(d, (t or "").encode()) for d, t in rows}


def test_words_are_forgotten_and_met_again(spark, library, monkeypatch):
    rng = random.Random(2)
    rows = [(i, prose(rng, 300)) for i in range(50)]
    # The limits go with the functions that the driver makes; a head of a few words leaves the rest to the tasks.
    monkeypatch.setattr(bpe, "HEAD_DOCUMENTS", 2)
    found = bpe.encode(documents(spark, rows).repartition(2), PATH, public_tokenizers.PATTERN)
    assert sorted(tuple(r) for r in found.collect()) == sorted(x[:4] for x in want(library, rows))
    words = bpe.Words(bpe.read_ranks(PATH), public_tokenizers.PATTERN, ["the"])
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 5)
    flags = [words.block(pa.array([prose(rng, 9)]))[0] for _ in range(3)]
    assert flags == [True, True, True] and next(iter(words.known)) == "the"


def test_no_rows(spark):
    assert bpe.encode(spark.createDataFrame([], DOCUMENTS), PATH, public_tokenizers.PATTERN).collect() == []


def plain(word, ranks):
    if word in ranks:
        return [ranks[word]]
    parts = [bytes([b]) for b in word]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(3))
def test_any_table_of_ranks(spark, monkeypatch, seed):
    """Tables in which a merge often makes a pair of lower rank than its own, which real ones seldom do; both folds."""
    rng = random.Random(seed)
    tokens = {bytes(rng.choices(b"abc", k=rng.randint(2, 5))) for _ in range(60)}
    order = rng.sample(sorted(tokens), len(tokens))
    ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(order)}
    words = [bytes(rng.choices(rng.choice([b"abc", b"a", b"ab"]), k=rng.randint(1, 40))) for _ in range(300)]
    rows = [([list(w)], len(w)) for w in words]
    frame = spark.createDataFrame(rows, "words array<array<int>>, n int").withColumn("ranks", bpe.rank_literal(spark, ranks))
    for longest in (0, 1000):
        monkeypatch.setattr(bpe, "LONG", longest)
        got = frame.select("words", F.transform("words", lambda w: bpe.encode_word(w, F.col("ranks"))).alias("ids")).collect()
        for r in got:
            word = bytes(r.words[0])
            if word not in ranks:
                assert r.ids[0] == plain(word, ranks), (word, longest)


def test_unknown_ids_raise(spark):
    with pytest.raises(Exception, match="no token"):
        bpe.decode(spark.createDataFrame([(1, [50_256])], "doc_id long, ids array<int>"), PATH).collect()
    nothing = spark.createDataFrame([(1, None), (None, [])], "doc_id long, ids array<int>")
    assert {bytes(r.decoded) for r in bpe.decode(nothing, PATH).collect()} == {b""}
