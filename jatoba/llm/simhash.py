"""SimHash near-duplicates by anchor-point covering.

A fingerprint bit is set where more than half of the shingle hashes set it. Fingerprints are
compared at anchors: the codewords of a covering code on their low 46 bits, the product of two
binary Golay codes, each of which covers its 23 bits with radius 3. Every fingerprint has one
home, the anchor within that radius in both halves. It is also copied to every anchor within
the covering radius plus the threshold, the threshold being shared out over the halves. Two
fingerprints within the threshold then always meet at the home of either, and one equi join on
the anchor compares them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jatoba.llm.graph import components
from jatoba.llm.text import SPACE, batch_bytes, find_words, pieces, slices, whole_row

HALF_BITS = 23
RADIUS = 3
GOLAY = 0b101011100011
"""Generator polynomial of the binary Golay code."""
STEP_BYTES = 1 << 21
STEP_ROWS = 1 << 14
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_bits(column: pa.Array, words: int, seed: int) -> np.ndarray:
    """The fingerprint of each text of a column, as uint64."""
    data, offsets = batch_bytes(column)
    found = find_words(data, offsets)
    # Words with one space after each, so that a shingle is one stretch of bytes.
    space = SPACE[data]
    kept = ~space
    kept[1:] |= space[1:] & ~space[:-1]
    plain = np.where(space, np.uint8(32), _LOWER[data])
    # A word that ends where its row ends has no space to keep, but no shingle goes beyond it.
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kept, out=place[1:])
    plain = plain[kept].tobytes()
    starts, ends = place[found.starts], place[found.ends]
    counts = found.counts
    shingles = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), shingles)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    first = found.first[row] + nth
    last = np.minimum(first + words, found.first[row + 1]) - 1
    out = np.zeros(len(counts), np.uint64)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros((len(counts), 64), np.int64)
    for a, b in pieces(np.arange(1, len(row) + 1), STEP_ROWS):
        h = np.fromiter(
            (digest(plain[s:e], seed) for s, e in zip(starts[first[a:b]].tolist(), ends[last[a:b]].tolist(), strict=True)),
            np.uint64,
            b - a,
        )
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        new = np.flatnonzero(np.diff(row[a:b], prepend=-1))
        ones[row[a:b][new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int32)
    for bit in range(64):
        out |= (2 * ones[:, bit] > shingles).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, text_key, fp``: the fingerprint of each row of documents, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", STEP_BYTES):
                bits = shingle_bits(batch.column("text"), words, seed).view(np.int64)
                yield pa.record_batch([batch.column("doc_id"), batch.column("text_key"), pa.array(bits)], ["doc_id", "text_key", "fp"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "doc_id long, text_key long, fp long")


@cache
def _golay() -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The syndrome of each byte at each place, and the error patterns of each syndrome.

    The patterns come in a list by their weight beyond the radius (0, 1, 2, ...): start
    positions by syndrome, and the patterns in that order.
    """

    def remainder(v: np.ndarray) -> np.ndarray:
        v = v.copy()
        for bit in range(HALF_BITS - 1, 10, -1):
            v ^= np.where(v >> bit & 1, GOLAY << (bit - 11), 0)
        return v

    tables = np.stack([remainder(np.arange(256) << shift) for shift in (0, 8, 16)])
    bit = 1 << np.arange(HALF_BITS)
    by_weight = [np.zeros(1, np.int64)]
    tops = [np.full(1, -1)]
    for _ in range(RADIUS + 2):
        grown = [(p | bit[k], k) for k in range(HALF_BITS) for p in [by_weight[-1][tops[-1] < k]] if len(p)]
        by_weight.append(np.concatenate([p for p, _ in grown]))
        tops.append(np.concatenate([np.full(len(p), k) for p, k in grown]))
    levels = [np.concatenate(by_weight[: RADIUS + 1]), *by_weight[RADIUS + 1 :]]
    out = []
    for patterns in levels:
        s = _syndrome(patterns, tables)
        order = np.argsort(s, kind="stable")
        out.append((np.searchsorted(s[order], np.arange(2049)), patterns[order]))
    return tables, out


def _syndrome(v: np.ndarray, tables: np.ndarray) -> np.ndarray:
    return tables[0][v & 255] ^ tables[1][v >> 8 & 255] ^ tables[2][v >> 16]


def anchors(fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For uint64 fingerprints: index into ``fp``, anchor, and whether it is the home."""
    tables, levels = _golay()
    mask = np.uint64((1 << HALF_BITS) - 1)
    halves = [(fp >> np.uint64(s) & mask).astype(np.int64) for s in (0, HALF_BITS)]
    syndromes = [_syndrome(h, tables) for h in halves]
    rows, places, home = [], [], []
    for p in range(threshold + 1):
        for q in range(threshold + 1 - p):
            index, low = _expand(np.arange(len(fp)), halves[0], syndromes[0], levels[p])
            again, high = _expand(index, halves[1][index], syndromes[1][index], levels[q], carry=low)
            rows.append(again)
            places.append(high[0] | high[1] << HALF_BITS)
            home.append(np.full(len(again), p + q == 0))
    return np.concatenate(rows), np.concatenate(places), np.concatenate(home)


def _expand(index, value, syndrome, level, carry=None):
    start, patterns = level
    n = start[syndrome + 1] - start[syndrome]
    at = np.arange(int(n.sum())) + np.repeat(start[syndrome] - (np.cumsum(n) - n), n)
    words = np.repeat(value, n) ^ patterns[at]
    return np.repeat(index, n), words if carry is None else (np.repeat(carry, n), words)


def links(distinct: DataFrame, threshold: int = 2) -> DataFrame:
    """Pairs ``a < b`` of different fingerprints of the column ``fp`` within ``threshold`` bits.

    A fingerprint has at most 2,080 others within two bits, so links grow with the rows.
    """
    if not 0 <= threshold <= 2:
        raise ValueError("the anchors are tabled for thresholds up to 2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), STEP_ROWS):
                fp = whole.column("fp").slice(k, STEP_ROWS).to_numpy(zero_copy_only=False)
                index, anchor, home = anchors(fp.view(np.uint64), threshold)
                yield pa.record_batch([pa.array(anchor), pa.array(fp[index]), pa.array(home)], ["anchor", "fp", "home"])

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), STEP_ROWS):
                fp = whole.column("fp").slice(k, STEP_ROWS).to_numpy(zero_copy_only=False)
                index, anchor, _ = anchors(fp.view(np.uint64), 0)
                yield pa.record_batch([pa.array(anchor), pa.array(fp[index])], ["anchor", "at_home"])

    copies = distinct.select("fp").mapInArrow(run, "anchor long, fp long, home boolean").drop("home")
    at_home = distinct.select("fp").mapInArrow(homes, "anchor long, at_home long")
    met = at_home.join(copies, "anchor").where(
        (F.col("at_home") != F.col("fp")) & (F.bit_count(F.col("at_home").bitwiseXOR(F.col("fp"))) <= threshold)
    )
    return met.select(F.least("at_home", "fp").alias("a"), F.greatest("at_home", "fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = 3, threshold: int = 2, seed: int = 42) -> DataFrame:
    """``doc_id, text_key, fingerprint, component_id, keep_key``, one row per row of documents.

    ``component_id`` is the smallest doc_id of the documents reachable over links of at most
    ``threshold`` differing bits. Equal fingerprints are one class, so copies never meet in
    pairs. NULL and wordless texts have fingerprint zero and link like any other; rows equal
    in every column get equal rows; a NULL doc_id comes after all others and is the
    component_id only where nothing else is in the component; no rows give no rows; other
    columns are not read. ``keep_key`` is the text_key of the row that stays.
    """
    found = fingerprints(docs, words, seed).checkpoint()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    classes = found.groupBy("fp").agg(first).checkpoint()
    linked = components(links(classes.select("fp"), threshold))
    members = linked.select(F.col("node").alias("fp"), "component").union(
        linked.select("component", "component").distinct()
    )
    roots = members.join(classes, "fp").groupBy("component").agg(F.min("first").alias("root"))
    named = classes.join(members.join(roots, "component").select("fp", "root"), "fp", "left").select(
        "fp", F.coalesce("root", "first").alias("root")
    )
    # Dealt out anew, both sides of the join come from a shuffle, and AQE can split a fingerprint that many rows have.
    return found.join(named.repartition(F.xxhash64("fp")), "fp").select(
        "doc_id",
        "text_key",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("root.doc_id").alias("component_id"),
        F.col("root.text_key").alias("keep_key"),
    )


def keep_one(docs: DataFrame, words: int = 3, threshold: int = 2) -> DataFrame:
    """The documents without all but one row of each component."""
    kept = near_duplicates(docs, words, threshold).where(
        "doc_id <=> component_id and text_key = keep_key"
    ).select(F.col("doc_id").alias("_id"), "text_key").distinct()
    # The row travels as one struct, so that no column of documents clashes with those made here.
    held = docs.select(F.col("doc_id").cast("long").alias("row_id"), F.xxhash64("text").alias("row_key"), whole_row(docs))
    return (
        held.join(kept, F.col("row_id").eqNullSafe(F.col("_id")) & (F.col("row_key") == F.col("text_key")), "left_semi")
        .dropDuplicates(["row_id", "row_key"])
        .select("row.*")
    )
