"""Byte-level BPE by folding ranked merges, with Spark's higher-order functions.

Texts are read in blocks of a few megabytes. A block becomes one row: the distinct words that its task has not met yet,
as the ids of their bytes, and for each document the places of its words among those met. The words are encoded by column expressions:
a fold over each word's array merges the pair of least rank until no pair has one, the ranks being a literal map that the plan carries.
Behind it the ids are put together per document, and decoding concatenates the bytes of the ids. Nothing is shuffled, and a
task that runs again meets the same words in the same order.

In a long word the fold merges all places of the least rank at once where that cannot change the result, so it takes
as many steps as there are different merges, and not one for each byte.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jatoba.llm.text import held, run_ranges, slices

BLOCK_BYTES = 4 << 20
"""Text of a block; a longer document is a block of its own."""
KNOWN_WORDS = 1 << 19
"""Words a task remembers; beyond it, it begins anew at the next block."""
HEAD_DOCUMENTS, HEAD_CHARACTERS, HEAD_WORDS = 2000, 8192, 1 << 18
"""The words that every task knows from the start are those of so many documents' beginnings, so many at most."""
LONG = 64
"""From this many bytes on, all places of a rank are merged at once."""
BUCKETS = 65521
"""Entries of the literal, a prime: pairs by their remainder, so that a look-up reads two or three."""
BLOCK_WORDS = 1 << 13
"""Words of a row when the words that all tasks know are encoded."""
ID_BITS = 20
NONE = 1 << ID_BITS
"""Stands for a pair without a rank; ids are less."""


def read_ranks(path: str) -> dict[bytes, int]:
    """The bytes and rank of each token, a line each."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def rank_literal(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """The rank of each pair of tokens that is one, as a single value ``array<map<bigint, int>>``; its size is that of the vocabulary."""
    if max(ranks.values()) >= NONE:
        raise ValueError(f"ids must be less than {NONE}")
    buckets: list[list[tuple[int, int]]] = [[] for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            left, right = ranks.get(token[:k]), ranks.get(token[k:])
            if left is not None and right is not None:
                key = (left << ID_BITS) + right
                buckets[key % BUCKETS].append((key, rank))
    kind = pa.list_(pa.map_(pa.int64(), pa.int32()))
    return spark.createDataFrame(pa.table([pa.array([buckets], kind)], ["ranks"])).scalar()


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _count(n: Column) -> Column:
    """0 to n - 1; nothing for n below 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _ranker(ranks: Column) -> Callable[[Column, Column], Column]:
    """The rank of two ids next to each other, NONE without one."""

    def rank(left: Column, right: Column) -> Column:
        def found(key: Column) -> Column:
            return F.coalesce(F.try_element_at(F.get(ranks, (key % BUCKETS).cast("int")), key), F.lit(NONE))

        return _let(F.shiftleft(left.cast("bigint"), ID_BITS) + right, found)

    return rank


def _fold_short(word: Column, rank: Callable[[Column, Column], Column]) -> Column:
    """One merge a step. A piece is one number: the rank it has with the next, where it began, its id; so the least is the one to merge."""

    def piece(pair: Column, start: Column, own: Column) -> Column:
        return F.shiftleft(pair.cast("bigint"), 2 * ID_BITS) + start + own

    def own(x: Column) -> Column:
        return x.bitwiseAND(F.lit(NONE - 1))

    def start(x: Column) -> Column:
        return x.bitwiseAND(F.lit((NONE - 1) << ID_BITS))

    def paired(left: Column, right: Column) -> Column:
        return F.when(right.isNull(), F.lit(NONE)).otherwise(rank(left, right))

    begin = F.transform(word, lambda x, i: piece(paired(x, F.get(word, i + 1)), F.shiftleft(i.cast("bigint"), ID_BITS), x))

    def merged(pieces: Column, least: Column) -> Column:
        made = F.shiftright(least, 2 * ID_BITS)
        kept = F.filter(pieces, lambda x, i: (i == 0) | (F.get(pieces, i - 1) != least))

        def renewed(kept: Column) -> Column:
            return F.transform(
                kept,
                lambda x, i: F.when(x == least, piece(paired(made, own(F.get(kept, i + 1))), start(x), made))
                .when(F.get(kept, i + 1) == least, piece(rank(own(x), made), start(x), own(x)))
                .otherwise(x),
            )

        return _let(kept, renewed)

    def go(pieces: Column, _: Column) -> Column:
        none = F.lit(NONE << 2 * ID_BITS)
        return _let(F.array_min(pieces), lambda least: F.when(least >= none, pieces).otherwise(merged(pieces, least)))

    return F.aggregate(F.slice(word, 2, F.size(word)), begin, go, lambda pieces: F.transform(pieces, lambda x: own(x).cast("int")))


def _fold_long(word: Column, rank: Callable[[Column, Column], Column]) -> Column:
    """All merges of one rank a step, if none of them makes a pair of lower rank; else the leftmost."""

    def state(ids: Column) -> Column:
        pairs = F.transform(_count(F.size(ids) - 1), lambda i: rank(F.get(ids, i), F.get(ids, i + 1)))
        return _let(pairs, lambda p: F.struct(ids.alias("ids"), p.alias("pairs"), F.coalesce(F.array_min(p), F.lit(NONE)).alias("least")))

    def places(pairs: Column, least: Column) -> Column:
        all_of = F.filter(_count(F.size(pairs)), lambda i: F.get(pairs, i) == least)
        # Where pairs of one rank overlap, as in "aaa", every other one of a run is merged.
        return _let(
            all_of,
            lambda at: F.flatten(
                F.zip_with(
                    F.filter(at, lambda p, k: (k == 0) | (F.get(at, k - 1) < p - 1)),
                    F.filter(at, lambda p, k: (k == F.size(at) - 1) | (F.get(at, k + 1) > p + 1)),
                    lambda first, last: F.sequence(first, last, F.lit(2)),
                )
            ),
        )

    def step(ids: Column, pairs: Column, least: Column) -> Column:
        def lower(p: Column) -> Column:
            """Whether a pair that the merge at ``p`` makes ranks lower, with the pieces next to it as they are."""
            before = (p > 0) & (rank(F.get(ids, p - 1), least) < least)
            return before | ((p + 2 < F.size(ids)) & (rank(least, F.get(ids, p + 2)) < least))

        def merge(at: Column) -> Column:
            gone = F.transform(at, lambda p: p + 1)
            stay = F.array_except(_count(F.size(ids)), gone)
            # Of a run every other place stays, and those are the merged ones; a single merge has one place.
            hit = lambda i: F.when(F.size(at) == 1, i == F.get(at, F.lit(0))).otherwise(F.coalesce(F.get(pairs, i) == least, F.lit(False)))
            return _let(F.transform(stay, lambda i: F.when(hit(i), least).otherwise(F.get(ids, i))), state)

        def chosen(at: Column) -> Column:
            risky = (F.size(at) > 1) & ((rank(least, least) < least) | F.exists(at, lower))
            return _let(F.when(risky, F.slice(at, 1, 1)).otherwise(at), merge)

        return _let(places(pairs, least), chosen)

    def go(s: Column, _: Column) -> Column:
        return F.when(s["least"] == NONE, s).otherwise(step(s["ids"], s["pairs"], s["least"]))

    return F.aggregate(F.slice(word, 2, F.size(word)), state(word), go, lambda s: s["ids"])


def encode_word(word: Column, ranks: Column) -> Column:
    """The ids of a word from those of its bytes, ``array<int>``."""
    rank = _ranker(ranks)
    return F.when(F.size(word) < LONG, _fold_short(word, rank)).otherwise(_fold_long(word, rank))


class Words:
    """The distinct words a task has met, and the ids of the bytes of new ones; a word that is a token is that one id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, head: list[str]) -> None:
        self.ranks, self.head = ranks, head
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.find = regex.compile(pattern).findall
        self.known: dict[str, int] | None = None

    def block(self, texts: pa.Array) -> tuple[bool, list[int], np.ndarray, list[np.ndarray]]:
        """Whether the words were forgotten, the ends of the documents, the places of their words, the new words."""
        fresh = self.known is None or len(self.known) > len(self.head) + KNOWN_WORDS
        if fresh:
            self.known = {w: i for i, w in enumerate(self.head)}
        known, places, ends, before = self.known, [np.zeros(0, np.int32)], [0], len(self.known)
        for text in texts:
            found = self.find(text.as_py() or "")
            places.append(np.fromiter([known.setdefault(w, len(known)) for w in found], np.int32, len(found)))
            ends.append(ends[-1] + len(found))
        return fresh, ends, np.concatenate(places), [self.ids(w) for w in islice(known, before, None)]

    def ids(self, word: str) -> np.ndarray:
        data = word.encode()
        whole = self.ranks.get(data)
        return self.of_byte[np.frombuffer(data, np.uint8)] if whole is None else np.array([whole], np.int32)


BLOCK = "doc_ids array<long>, fresh boolean, ends array<long>, places array<int>, words array<array<int>>"


def _one(values: pa.Array) -> pa.ListArray:
    """All values as the list of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *arrays])))


def _blocks(ranks_path: str, pattern: str, head: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(read_ranks(ranks_path), pattern, head.value[0])
        for whole in batches:
            for batch in slices(whole, "text", BLOCK_BYTES):
                fresh, ends, places, new = words.block(batch.column("text"))
                yield pa.record_batch(
                    [_one(batch.column("doc_id")), pa.array([fresh]), _one(pa.array(ends, pa.int64())), _one(pa.array(places)), _one(_lists(new))],
                    ["doc_ids", "fresh", "ends", "places", "words"],
                )

    return run


def _head(texts: DataFrame, ranks_path: str, pattern: str, ranks: Column) -> Broadcast:
    """Words of a bounded sample and their ids. They spare work and decide nothing: a word that is not among them is encoded where it is met."""
    find, count = regex.compile(pattern).findall, Counter()
    # The limit stands last, so that Spark reads no more partitions than it takes.
    for row in texts.select(F.substring("text", 1, HEAD_CHARACTERS)).limit(HEAD_DOCUMENTS).collect():
        count.update(find(row[0] or ""))
    words = [w for w, _ in count.most_common(HEAD_WORDS)]
    bytes_of = Words(read_ranks(ranks_path), pattern, [])
    parts = [_lists([bytes_of.ids(w) for w in words[k : k + BLOCK_WORDS]]) for k in range(0, len(words), BLOCK_WORDS)]
    spark = texts.sparkSession
    codes = []
    if parts:
        table = pa.table([pa.array([p.to_pylist() for p in parts], pa.list_(pa.list_(pa.int32())))], ["words"])
        rows = spark.createDataFrame(table.append_column("part", pa.array(range(len(parts))))).repartition(len(parts), "part")
        coded = rows.withColumn("ranks", ranks).select("part", _codes(F.col("words")).alias("codes")).toArrow().sort_by("part")
        codes = [ids for row in coded.column("codes").to_pylist() for ids in row]
    lengths = np.array([len(ids) for ids in codes], np.int64)
    return spark.sparkContext.broadcast((words, np.array([i for ids in codes for i in ids], np.int32), lengths))


def _codes(words: Column) -> Column:
    return F.transform(words, lambda word: encode_word(word, F.col("ranks")))


class Pieces:
    """The bytes of each id, laid out one after the other."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        tokens = sorted(ranks, key=ranks.get)
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        self.lengths[[ranks[t] for t in tokens]] = [len(t) for t in tokens]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.data[run_ranges(self.starts[ids], self.lengths[ids])].tobytes()


def _documents(ranks_path: str, head: Broadcast, with_ids: bool):
    """Blocks with encoded words to documents: ids put together, hashed, and decoded again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(read_ranks(ranks_path))
        pool = lengths = None
        for batch in batches:
            for k in range(len(batch)):
                doc_ids, new = batch.column("doc_ids")[k].values, batch.column("codes")[k].values
                ends, places = (batch.column(c)[k].values.to_numpy() for c in ("ends", "places"))
                if batch.column("fresh")[k].as_py():
                    _, pool, lengths = head.value
                pool = np.concatenate([pool, new.flatten().to_numpy(zero_copy_only=False)])
                lengths = np.concatenate([lengths, pc.list_value_length(new).to_numpy(zero_copy_only=False).astype(np.int64)])
                starts = np.cumsum(lengths) - lengths
                rows, kept = [], []
                for first, last in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    at = places[first:last]
                    ids = pool[run_ranges(starts[at], lengths[at])]
                    rows.append((len(ids), sha256(ids.astype("<u4").tobytes()).hexdigest(), sha256(pieces.decode(ids)).hexdigest()))
                    kept.append(ids if with_ids else None)
                numbers, shas, decoded = zip(*rows, strict=True)
                columns = [doc_ids, pa.array(numbers, pa.int64()), pa.array(shas), pa.array(decoded)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.record_batch(columns, names)

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]`` for every document, a row for each row of ``docs``.

    Each match of ``pattern`` is encoded by itself, without special tokens. A NULL or empty text has no ids
    and the hashes of nothing; equal rows and rows with the same or no doc_id are documents of their own; ties
    between pairs of one rank go to the leftmost; a text of any length is encoded whole, a very long one as a
    block by itself; no rows give no rows; other columns are not read.
    """
    ranks = rank_literal(docs.sparkSession, read_ranks(ranks_path))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    head = _head(texts, ranks_path, pattern, ranks)
    blocks = texts.mapInArrow(_blocks(ranks_path, pattern, head), BLOCK).withColumn("ranks", ranks)
    coded = blocks.select("doc_ids", "fresh", "ends", "places", _codes(F.col("words")).alias("codes"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return coded.mapInArrow(_documents(ranks_path, head, with_ids), schema)


def decode(coded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, decoded`` (binary) from ``doc_id, ids``; NULL or no ids give no bytes, an id without a token raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = held(f"pieces {ranks_path}", lambda: Pieces(read_ranks(ranks_path)))
        for batch in batches:
            for k in range(len(batch)):
                ids = np.array(batch.column("ids")[k].as_py() or [], np.int64)
                if ((ids < 0) | (ids >= len(pieces.lengths))).any() or (pieces.lengths[ids] == 0).any():
                    raise ValueError("an id that no token has")
                yield pa.record_batch([batch.column("doc_id").slice(k, 1), pa.array([pieces.decode(ids)], pa.binary())], ["doc_id", "decoded"])

    return coded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, decoded binary")
