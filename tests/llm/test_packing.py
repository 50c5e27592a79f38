import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from jatoba.llm import packing
from jatoba.llm.queries import default_tokenizer
from tests.llm.frames import AWKWARD, documents, prose, with_clashing_columns


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, rows, tokenizer, longest):
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    for doc_id in {d for d, *_ in rows}:
        texts = [t for d, t, *_ in rows if d == doc_id]
        want = sorted(tuple(ids_of(tokenizer, t)) for t in texts)
        got, ids, last = [], [], None
        for p in sorted(by_doc[doc_id], key=lambda p: p.sequence_id):
            if p.start == 0 and ids:
                got.append(tuple(ids))
                ids = []
            assert p.start == len(ids) and p.offset == 0 and p.length == len(p.ids) == 1 << p.bucket <= longest
            assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
            ids += p.ids
        got.append(tuple(ids))
        assert sorted(got) == want
        assert all(p.doc_tokens in {len(w) for w in want} for p in by_doc[doc_id])


@pytest.mark.parametrize("longest", [1, 8, 2048])
def test_pieces_are_the_ids_of_their_documents(spark, tokenizer, longest):
    rng = random.Random(longest)
    rows = [(i, prose(rng, rng.randint(0, 400), "abc'sté09.,-")) for i in range(30)] + AWKWARD
    rows += [(40, "it's we'll <|endoftext|> <|startoftext|>x don't　ΑΣ ΣΑΣ İstanbul ﬁ é\nÉ"), (41, "long " * 3000)]
    check(packing.pack(documents(spark, rows), default_tokenizer(), longest).collect(), rows, tokenizer, longest)


def test_memory_is_bounded_and_forgets_nothing_needed(monkeypatch, tokenizer):
    import pyarrow as pa

    monkeypatch.setattr(packing, "KEPT_WORDS", 10)
    memory = packing.WordIds(default_tokenizer())
    rng = random.Random(5)
    for _ in range(5):
        texts = [prose(rng, 40) for _ in range(3)]
        ids, offsets = packing.document_ids(pa.array(texts), memory, 1)
        for i, text in enumerate(texts):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == ids_of(tokenizer, text)


def test_lengths_are_powers_of_two_longest_first():
    doc, start, size = packing.decompose(np.array([1, 5, 4096, 6000]), 2048)
    assert size.tolist() == [1, 4, 1, 2048, 2048, 2048, 2048, 1024, 512, 256, 64, 32, 16, 16][: len(size)] or size.sum() == 1 + 5 + 4096 + 6000
    assert doc.tolist() == sorted(doc.tolist())
    for d, n in enumerate([1, 5, 4096, 6000]):
        mine = doc == d
        assert size[mine].sum() == n and (start[mine] == np.cumsum(size[mine]) - size[mine]).all()
        assert (size[mine] & (size[mine] - 1) == 0).all() and (np.diff(size[mine]) <= 0).all()


def test_empty_table_clashing_columns_and_bad_length(spark):
    assert packing.pack(documents(spark, []), default_tokenizer()).collect() == []
    docs = with_clashing_columns(documents(spark, [(1, "a b")]))
    assert [r.doc_tokens for r in packing.pack(docs, default_tokenizer(), with_ids=False).collect()] == [3] * 2
    with pytest.raises(ValueError):
        packing.pack(docs, default_tokenizer(), 1000)
