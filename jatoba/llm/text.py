"""Words of whole Arrow batches of text, as numpy arrays.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``. Text is UTF-8, in which those bytes
stand for themselves alone, so words are found on bytes. Nothing here loops over words.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP_BYTES = 1 << 20
"""Bytes that are hashed in one go."""
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


@dataclass
class Words:
    """``starts`` and ``ends`` are byte positions in ``data``; the words of row ``i`` are ``first[i]:first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def batch_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~SPACE[data]
    new = np.zeros(len(data) + 1, bool)
    new[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | new[1:-1]
    ends = inside
    ends[:-1] &= ~inside[1:] | new[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 bits."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            full = np.full(n, base, np.uint64)
            full[0] = 1
            _powers[k] = np.cumprod(full, dtype=np.uint64)
    return _powers


def hash_words(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes; the words stand in the order of the text."""
    out = np.empty(len(words), np.uint64)
    for a, b in pieces(words.ends, STEP_BYTES):
        low, high = words.starts[a], words.ends[b - 1]
        up, down = _tables(max(high - low + 1, 2 * STEP_BYTES))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((words.data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        s, e = words.starts[a:b] - low, words.ends[a:b] - low
        out[a:b] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _BASE)
    return out


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``values[starts[i] : ends[i]]``, of its values and their order."""
    up, down = _tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _BASE)


def pieces(ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose ends lie within ``size`` of their beginning, one index at least."""
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + size, "right")))
        yield a, b
        a = b


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``size`` bytes of text each, to bound the arrays made of them."""
    for part, _ in row_slices(batch, batch.column(column), size):
        yield part


def row_slices(batch: pa.RecordBatch, text: pa.Array, size: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """The same for a text that lies anywhere in the batch, with the text of each run."""
    for a, b in pieces(text_ends(text), size):
        yield batch.slice(a, b - a), text.slice(a, b - a)


def text_of(rows: pa.Array) -> pa.Array:
    """The column ``text`` of a struct column of whole rows."""
    text = rows.field("text")
    return text if pa.types.is_string(text.type) else text.cast(pa.string())


def text_ends(column: pa.Array) -> np.ndarray:
    """Where each text would end if they stood one after the other."""
    return np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)


def run_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated ranges ``starts[i] : starts[i] + lengths[i]``."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


class Memory:
    """Values of words that a worker has met, by word hash; bounded, and begun anew when full.

    ``make(words, at)`` gives the values of the words at these ascending places, a row each. Words of
    more than ``longest`` bytes are made anew each time, so that no text crafted to collide
    is looked up.
    """

    def __init__(self, make, width: int, dtype, most: int = 1 << 20, longest: int = 64) -> None:
        self.make, self.most, self.longest = make, most, longest
        self.hashes = np.zeros(0, np.uint64)
        self.values = np.zeros((0, width), dtype)

    def __call__(self, words: Words, hashes: np.ndarray) -> np.ndarray:
        out = np.empty((len(words), self.values.shape[1]), self.values.dtype)
        long = words.ends - words.starts > self.longest
        if long.any():
            out[long] = self.make(words, np.flatnonzero(long))
        short = np.flatnonzero(~long)
        distinct, first, which = np.unique(hashes[short], return_index=True, return_inverse=True)
        if len(self.hashes) > self.most:
            self.hashes, self.values = self.hashes[:0], self.values[:0]
        place = np.searchsorted(self.hashes, distinct)
        known = place < len(self.hashes)
        known[known] = self.hashes[place[known]] == distinct[known]
        if not known.all():
            at = short[first[~known]]
            order = np.argsort(at)
            new = np.empty((len(at), out.shape[1]), out.dtype)
            new[order] = self.make(words, at[order])
            self.hashes = np.insert(self.hashes, place[~known], distinct[~known])
            self.values = np.insert(self.values, place[~known], new, axis=0)
            place = np.searchsorted(self.hashes, distinct)
        out[short] = self.values[place][which]
        return out


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct ``row``, so that whatever they are called, they clash with nothing."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


_held: dict[str, object] = {}


def held(name: str, make):
    """What a worker keeps from batch to batch: one thing at a time, so that stages that follow each other do not add up."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` as a task that leaves its worker as small as it found it.

    Workers are used again by the stages that follow. What one of them holds, and what its allocators keep
    of it, would otherwise add up over a pipeline.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _held.clear()
            give_back()

    return task


def give_back() -> None:
    """Return to the system what is no longer used; the allocators keep it otherwise."""
    for k in range(len(_powers)):
        _powers[k] = np.ones(1, np.uint64)
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
