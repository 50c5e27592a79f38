"""Packing by power-of-two decomposition.

A document of n ids is cut into pieces whose lengths are powers of two: as many of the longest
as fit, then one for each set bit of the rest, longest first. Every piece is a sequence of its
own, so no sequence crosses documents and none is padded; sequences of equal length share a
bucket, from which batches are formed.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jatoba.llm.text import Words, batch_bytes, find_words, hash_words, held, released, run_ranges, slices

STEP_BYTES = 1 << 21
KEPT_WORDS = 1 << 20
"""Words whose ids a worker remembers; beyond it, it starts anew."""
PLAIN_BYTES = 64
"""Longer words are encoded anew each time they occur."""


class WordIds:
    """Ids of words, by way of a bounded memory.

    The tokenizer's word pattern never crosses white space, so the ids of a text are those of
    its words one after the other.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [words.data[s:e].tobytes().decode() for s, e in zip(words.starts[at], words.ends[at], strict=True)]
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.uint32, int(lengths.sum())), lengths

    def __call__(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has."""
        hashes = hash_words(words)
        long = np.flatnonzero(words.ends - words.starts > PLAIN_BYTES)
        short = np.flatnonzero(words.ends - words.starts <= PLAIN_BYTES)
        distinct, first, which = np.unique(hashes[short], return_index=True, return_inverse=True)
        if len(self.hashes) > KEPT_WORDS:
            self._forget()
        place = np.searchsorted(self.hashes, distinct)
        known = place < len(self.hashes)
        known[known] = self.hashes[place[known]] == distinct[known]
        if not known.all():
            ids, lengths = self._encode(words, short[first[~known]])
            starts = len(self.ids) + np.cumsum(lengths) - lengths
            self.ids = np.concatenate([self.ids, ids])
            at = place[~known]
            self.hashes = np.insert(self.hashes, at, distinct[~known])
            self.starts = np.insert(self.starts, at, starts)
            self.lengths = np.insert(self.lengths, at, lengths)
            place = np.searchsorted(self.hashes, distinct)
        starts, lengths = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        starts[short], lengths[short] = self.starts[place][which], self.lengths[place][which]
        pool = self.ids
        if len(long):
            ids, lengths[long] = self._encode(words, long)
            starts[long] = len(pool) + np.cumsum(lengths[long]) - lengths[long]
            pool = np.concatenate([pool, ids])
        return pool[run_ranges(starts, lengths)], lengths


def encoder(path: str) -> WordIds:
    return held(f"ids {path}", lambda: WordIds(path))


def document_ids(column: pa.Array, ids_of: WordIds, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each followed by ``end``, and the n + 1 offsets of the texts."""
    data, offsets = batch_bytes(column)
    words = find_words(data, offsets)
    ids, lengths = ids_of(words)
    before = np.zeros(len(words) + 1, np.int64)
    np.cumsum(lengths, out=before[1:])
    ends = before[words.first[1:]]
    out = np.insert(ids, ends, np.uint32(end))
    return out, np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])


def decompose(lengths: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each document its pieces: document, start in it, length."""
    bits = longest.bit_length()
    # Column 0 counts the longest pieces, column k the piece of longest / 2 ** k.
    count = np.empty((len(lengths), bits), np.int64)
    count[:, 0] = lengths // longest
    for k in range(1, bits):
        count[:, k] = lengths >> (bits - 1 - k) & 1
    flat = count.ravel()
    doc = np.repeat(np.repeat(np.arange(len(lengths)), bits), flat)
    size = np.repeat(np.tile(longest >> np.arange(bits), len(lengths)), flat)
    end = np.cumsum(size)
    first = np.cumsum(lengths) - lengths
    return doc, end - size - first[doc], size


def pack(docs: DataFrame, tokenizer: str, longest: int = 2048, end: int = 1, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket[, ids]``.

    A piece is a whole sequence, so ``offset`` is 0 and there is no padding; ``bucket`` is the
    logarithm of its length. A NULL or empty text is the one piece of the end id; equal rows
    and rows with the same or no doc_id are documents of their own; no rows give no rows;
    other columns are not read. Nothing is shuffled: a row's pieces come from the task that
    read it, about two megabytes of text at a time, or one document if that is longer.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("longest must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer)
        for whole in batches:
            for batch in slices(whole, "text", STEP_BYTES):
                ids, offsets = document_ids(batch.column("text"), ids_of, end)
                doc, start, size = decompose(np.diff(offsets), longest)
                at = offsets[doc] + start
                view = memoryview(ids.astype("<u4", copy=False)).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), size.tolist(), strict=True)]
                columns = {
                    "doc_id": batch.column("doc_id").take(pa.array(doc)),
                    "start": pa.array(start),
                    "length": pa.array(size),
                    "ids_crc32": pa.array(crc, pa.int64()),
                    "doc_tokens": pa.array(np.diff(offsets)[doc]),
                    "bucket": pa.array(np.log2(size).astype(np.int32)),
                }
                if with_ids:
                    columns["ids"] = pa.ListArray.from_arrays(
                        pa.array(np.append(np.cumsum(size) - size, len(ids)).astype(np.int32)), pa.array(ids.view(np.int32))
                    )
                yield pa.record_batch(columns)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket int"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        released(run), schema + (", ids array<int>" if with_ids else "")
    )
    return rows.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        "bucket", *(["ids"] if with_ids else []),
    )
