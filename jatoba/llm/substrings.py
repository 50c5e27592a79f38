"""Near-duplicate passages by compact windows.

A text is the sequence of its five-word shingles. For each of a few hash functions, the
Cartesian tree over the shingles' hashes gives compact windows (l, c, r): all subsequences that
hold c and lie within l..r have their smallest hash, their signature, at c. Only windows that
are long enough for a passage are made, two for each passage length of text. Windows of two
texts with one signature tell where subsequences share it; where the intervals of enough hash
functions overlap, the two passages are fetched and their shingles compared.

Windows of one signature with the same words around them are copies, and are linked to the first
of them, already in the task that read them. Of windows that differ, each is linked to all others
that share its signature if these are few. If they are many, as with a line that stands in many texts,
it is linked to the nearest ones in the order and to the first, and what these do not explain is
dealt with a second time: a near copy has an unbroken run of 24 words in common with its source,
so there compact windows over 20-word shingles are made, and every one that no passage found so far holds
is compared with all that have its signature, in blocks inside the tasks: what leaves a task are the
sources that reach furthest before and behind it, no pairs. Shingles within a row of one word,
or of a few that repeat, tell too little for that: they are linked to the first such row, and those at its ends take part with the word before and after.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from jatoba.llm.text import Words, batch_bytes, find_words, hash_words, mix, pieces, released, run_hashes, run_ranges, slices, text_ends, text_of, whole_row
from jatoba.operators.joins import semi_reduce
from jatoba.session import checkpointed, shuffles_removed, staged

SHINGLE = 5
PASSAGE = 50
"""Words of the shortest passage that is looked for."""
SIMILARITY = 0.8
HASHES = 4
ENOUGH = 2
"""Hash functions that must agree on a place before the passages are compared."""
STEP_BYTES = 1 << 21
"""Text whose shingles are made in one go."""
TOGETHER_BYTES = 1 << 22
"""Text whose copies are folded inside the task that read it."""
NEAREST = 2
"""Windows before it that a window is linked to; of a signature with more, the rest is joined by longer shingles."""
CARRIED = 1 << 16
"""Windows of a signature among which a copy is looked for."""
RUN = 24
"""Words of the unbroken run that passages have in common: of 46 shingles and more, at a similarity of 0.8, each break costs eight."""
RUN_SHINGLE = 20
MEMBERS = 4096
"""Longer shingles of a signature that a task compares with as many at a time."""
SLOTS = 2048
"""Places of a table that tells which shingles stand around a longer one; some are told wrongly to be there, none not to be."""
PAIRS = 1 << 14
"""Pairs of longer shingles whose surroundings are compared in one go."""
SLACK = 0.05
"""How much less alike the stretches of the shortest length may be than a passage that is longer, before the passages are compared."""
PERIOD = 4
"""Words that repeat in a row of them, at most: with the ``RUN - RUN_SHINGLE`` words on either side, such a row has too few shingles to be alike but for a word."""
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)

PAIR = "x_doc long, x_key long, a_doc long, a_key long"
COPY = 64
"""Added to the hash function of a link between copies, which needs no other to agree."""
REST = -1
"""Stands for the hash function where a window is one of many, and not only the nearest have to be seen."""
CONTEXT_BITS = 28
"""Of a signature's 64 bits, those that tell the words around the window."""
WINDOW = f"sign long, {PAIR}, k int, xc int, xl int, xr int, ac int"
"""A window, or with an ``a_key`` a link to a copy of it in another text."""
LINK = f"{PAIR}, k int, xc int, xl int, xr int, ac int, al int, ar int"
CANDIDATE = f"{PAIR}, xs int, xe int, as int, ae int"
"""Passages to compare, or without an ``a_key`` the place of a window that is one of many, with its signature as ``a_doc``."""
SEED = "sign long, context long, doc long, key long, c int, open boolean"
"""A longer shingle, and whether no passage found so far holds it."""
SOURCE = f"{PAIR}, xc int, ac int"
AROUND = "sign long, tile int, doc long, key long, c int, asks boolean, answers boolean, words binary"
"""A longer shingle with the words around it; whether it asks for sources in its tile, and whether it is one for others."""
PASSAGE_ROW = "doc_id long, text_key long, start int, length int, source_id long, source_key long, source_start int, similarity double"


def shingle_hashes(column: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, Words]:
    """The hash of the shingle that begins at each word, and where each row's words begin.

    The last ``shingle - 1`` places of a row begin none and hold 0.
    """
    h, words = word_hashes(column)
    return shingles_of(h, words, shingle), words.first, words


def word_hashes(column: pa.Array) -> tuple[np.ndarray, Words]:
    """The hash of each word without ASCII case, and the words."""
    data, offsets = batch_bytes(column)
    words = find_words(data, offsets)
    words = Words(_LOWER[data], words.starts, words.ends, words.first)
    return hash_words(words), words


def shingles_of(h: np.ndarray, words: Words, shingle: int) -> np.ndarray:
    """The hashes of shingles from those of the words, as :func:`shingle_hashes` has them."""
    out = np.zeros(len(h), np.uint64)
    if len(h) >= shingle:
        total = np.zeros(len(h) - shingle + 1, np.uint64)
        for k in range(shingle):
            total = total * _ODD + h[k : len(h) - shingle + 1 + k]
        out[: len(total)] = mix(total) | np.uint64(1)
    ends = words.first[1:]
    for k in range(1, shingle):
        out[ends[words.counts >= k] - k] = 0
    return out


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every run of ``width`` values."""
    size, out = 1, values
    while 2 * size <= width:
        out = pick(out[: len(out) - size], out[size:])
        size *= 2
    rest = width - size
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def smallest(h: np.ndarray, width: int) -> np.ndarray:
    """The places that have the smallest hash of some run of ``width`` shingles of one row."""
    if len(h) < width:
        return np.zeros(0, np.int64)
    least = _sliding(h, width, np.minimum)
    # Runs that leave their row or its shingles hold a 0, which is no hash.
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    return np.flatnonzero((_sliding(padded, width, np.maximum) == h) & (h > 0))


def repeats(h: np.ndarray, first: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Begins and ends of the rows of at least ``least`` words in which every word is that of ``step`` words before, by ascending step; each row once."""
    known = np.zeros(len(h), bool)
    for step in range(1, PERIOD + 1):
        again = np.zeros(len(h) + 1, np.int8)
        again[step:-1] = h[step:] == h[:-step] if len(h) > step else 0
        for k in range(step):  # the first words of a text have none before them
            again[first[:-1][np.diff(first) > k] + k] = 0
        edge = np.diff(again, prepend=0)
        low, high = np.flatnonzero(edge == 1) - step, np.flatnonzero(edge == -1)
        long = high - low >= least
        low, high = low[long], high[long]
        new = ~known[low]
        known[low] = True
        yield low[new], high[new], step


def compact_windows(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """``row, c, l, r, value`` of the windows of at least ``width`` shingles; positions within the row.

    ``h`` holds 0 where no shingle begins. A place is the smallest of some run of ``width``
    shingles if and only if its window is that long, and the places that bound it are so too,
    so the tree is only built over those.
    """
    at = smallest(h, width)
    if not len(at):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    row = np.searchsorted(first, at, "right") - 1
    left, right = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    value, place, rows = h[at].tolist(), at.tolist(), row.tolist()
    lows = first[row].tolist()
    # Shingles end where the first 0 of the row stands.
    zero = np.flatnonzero(h == 0)
    highs = zero[np.searchsorted(zero, at)] if len(zero) else np.full(len(at), len(h))
    highs = highs.tolist()
    stack: list[int] = []
    now = -1
    for i, v in enumerate(value):
        if rows[i] != now:
            for j in stack:
                right[j] = highs[j] - 1
            stack, now = [], rows[i]
        while stack and value[stack[-1]] > v:
            right[stack.pop()] = place[i] - 1
        left[i] = place[stack[-1]] + 1 if stack else lows[i]
        stack.append(i)
    for j in stack:
        right[j] = highs[j] - 1
    begin = first[row]
    return row, at - begin, left - begin, right - begin, h[at]


def thinned(row, c, left, right, value, step: int) -> tuple[np.ndarray, ...]:
    """Of windows of one hash at places next to each other, as in a row of one word, the first, the last and every ``step``-th.

    They have the smallest hash of a subsequence together, so each gets the bounds of the first one,
    and no subsequence of ``step`` shingles is without one.
    """
    new = np.ones(len(c), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1]) | (c[1:] != c[:-1] + 1)
    begin = np.flatnonzero(new)[np.cumsum(new) - 1] if len(c) else np.zeros(0, np.int64)
    kept = np.flatnonzero(((np.arange(len(c)) - begin) % step == 0) | np.append(new[1:], True)[: len(c)])
    return row[kept], c[kept], left[begin[kept]], right[kept], value[kept]


def _group(*keys: np.ndarray) -> np.ndarray:
    """Whether each row of sorted keys begins a new group."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def passages(pair, k, xc, xl, xr, ac, al, ar, width: int, enough: int, shift: int):
    """Where enough hash functions agree: ``pair, xs, xe, as, ae``, ends exclusive.

    ``pair`` numbers the text pairs. The intervals of a pair are grouped by how far the two
    texts are shifted (links within ``shift`` of the next one belong together); in a group, each
    hash function's intervals are merged and the places where enough of them overlap are kept.
    """
    d = ac - xc
    order = np.lexsort((d, pair))
    pair, k, xc, xl, xr, ac, al, ar, d = (v[order] for v in (pair, k, xc, xl, xr, ac, al, ar, d))
    new = _group(pair)
    new[1:] |= np.diff(d) > shift
    group = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    if not len(begin):
        return (np.zeros(0, np.int64),) * 5
    d_low, d_high = np.minimum.reduceat(d, begin), np.maximum.reduceat(d, begin)
    low = xc - np.minimum(xc - xl, ac - al)
    high = xc + np.minimum(xr - xc, ar - ac) + 1
    # Union per group and hash function.
    order = np.lexsort((low, k, group))
    g, kk, low, high = group[order], k[order], low[order], high[order]
    lane = np.cumsum(_group(g, kk)) - 1
    big = int(high.max()) + 1
    top = np.maximum.accumulate(high + lane * big) - lane * big
    fresh = _group(lane)
    fresh[1:] |= low[1:] > top[:-1]
    at = np.flatnonzero(fresh)
    g, low = g[at], low[at]
    high = top[np.append(at[1:], len(top)) - 1]
    # Coverage.
    place = np.concatenate([low, high])
    step = np.concatenate([np.ones(len(low), np.int64), -np.ones(len(low), np.int64)])
    owner = np.concatenate([g, g])
    order = np.lexsort((-step, place, owner))
    place, step, owner = place[order], step[order], owner[order]
    depth = np.cumsum(step)
    up = np.flatnonzero((depth == enough) & (step == 1))
    down = np.flatnonzero((depth == enough - 1) & (step == -1))
    xs, xe, of = place[up], place[down], owner[up]
    long = xe - xs >= width
    xs, xe, of = xs[long], xe[long], of[long]
    return pair[begin][of], xs, xe, np.maximum(xs + d_low[of], 0), xe + d_high[of]


def verify(x: np.ndarray, a: np.ndarray, width: int, similarity: float) -> list[tuple[int, int, int, float]]:
    """Compare two passages: begin and end in ``x``, begin in ``a`` and similarity of what is alike.

    Both are cut back to the stretch between their first and last shared shingle. If that is
    too unlike as a whole, its dense stretches and its long unbroken ones are tried.
    """
    x, a = x[x != 0], a[a != 0]
    if not len(a):
        return []
    # The shingles of ``a`` are numbered, and looked up once for all stretches.
    order = np.argsort(a, kind="stable")
    ordered = a[order]
    new = _group(ordered)
    number = np.empty(len(a), np.int64)
    number[order] = np.cumsum(new) - 1
    low = np.minimum(np.searchsorted(ordered, x), len(a) - 1)
    known = ordered[low] == x
    single = known & np.append(new[1:], True)[low]
    there = (x, a, known, single, order[low], number)
    hit = np.flatnonzero(known)
    if len(hit) < similarity * width:
        return []
    whole = (int(hit[0]), int(hit[-1]) + 1)
    found = _alike(there, *whole, width, similarity)
    if not found:
        begin = np.flatnonzero(np.diff(hit, prepend=-2) > 1)
        runs = list(zip(hit[begin].tolist(), (hit[np.append(begin[1:], len(hit)) - 1] + 1).tolist(), strict=True))
        for s, e in _dense(runs, 2 * similarity / (1 - similarity)):
            if (s, e) != whole:
                found += _alike(there, s, e, width, similarity)
        for s, e in runs:
            if e - s >= width and not any(b <= s and e <= f for b, f, *_ in found):
                found += _alike(there, s, e, width, similarity)
    return found


def _dense(runs: list[tuple[int, int]], price: float) -> list[tuple[int, int]]:
    """The longest stretches from run to run whose gaps, times ``price``, are outweighed by their runs; none lies in another."""
    begin, end = np.array(runs).T
    known = np.cumsum(end - begin)
    up, down = (1 + price) * known - price * end, (1 + price) * (known - (end - begin)) - price * begin
    # The last end that outweighs a begin, among the ends from it on: its own at least.
    most = np.maximum.accumulate(up[::-1])[::-1]
    last = len(runs) - 1 - np.searchsorted(most[::-1], down - 1e-6)
    out, reached = [], -1
    for i, j in enumerate(last.tolist()):
        if j > reached:
            out.append((int(begin[i]), int(end[j])))
            reached = j
    return out


def _alike(there, s, e, width, similarity):
    """``there``: both passages, and for each shingle of ``x`` whether ``a`` has it, has it once, and where first; the shingles of ``a`` by number."""
    if e - s < width:
        return []
    x, a, known, single, first, number = there
    x, known, first = x[s:e], known[s:e], first[s:e]
    unlike = len(set(x[~known].tolist()))
    if np.count_nonzero(known) < similarity * (np.count_nonzero(known) + unlike):
        return []
    # Where the other passage lies: by shingles that occur once in it, since others do not tell.
    once = np.flatnonzero(single[s:e])
    if not len(once):
        once = np.flatnonzero(known)
    place = first[once]
    apart = np.sort(place - once)
    shift = int((apart[(len(apart) - 1) // 2] + apart[len(apart) // 2]) / 2)
    near = np.abs(place - once - shift) <= width
    at = np.arange(e - s) + shift
    inside = (at >= 0) & (at < len(a))
    straight = at[inside][a[at[inside]] == x[inside]]
    found = np.concatenate([place[near], straight])
    if not len(found):
        return []
    b, f = int(found.min()), int(found.max()) + 1
    part, other = np.zeros(len(a), bool), np.zeros(len(a), bool)
    part[number[first[known]]] = True
    other[number[b:f]] = True
    both = int((part & other).sum())
    score = both / (int(part.sum()) + unlike + int(other.sum()) - both)
    return [(s, e, b, score)] if score >= similarity else []


def _number(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct tuple of keys, and a place where each occurs."""
    order = np.lexsort(keys)
    new = _group(*(k[order] for k in keys))
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


class Finder:
    """The parameters, and what a task does with the rows it reads."""

    def __init__(self, shingle=SHINGLE, passage=PASSAGE, similarity=SIMILARITY, hashes=HASHES, enough=ENOUGH):
        self.shingle, self.similarity, self.hashes, self.enough = shingle, similarity, hashes, enough
        self.passage, self.width = passage, passage - shingle + 1
        self.shift = max(1, self.width // 4)

    def windows(self, column: pa.Array) -> tuple[np.ndarray, ...]:
        """``row, k, c, l, r, signature`` of all texts of a column, a run of rows at a time; the signature's last bits are those of the context."""
        out = []
        for a, b in pieces(text_ends(column), STEP_BYTES):
            h, first, _ = shingle_hashes(column.slice(a, b - a), self.shingle)
            for k in range(self.hashes):
                hk = np.where(h > 0, mix(h * np.uint64(2 * k + 3) + np.uint64(k)) | np.uint64(1), np.uint64(0))
                row, c, left, right, value = thinned(*compact_windows(hk, first, self.width), self.width // 2)
                low, high = self.around(c, left, right)
                same = run_hashes(h, first[row] + low, first[row] + high + 1) ^ mix((c - low).astype(np.uint64))
                low_bits = np.uint64(CONTEXT_BITS)
                sign = (mix(value + np.uint64(k)) >> low_bits << low_bits) | (same >> (np.uint64(64) - low_bits))
                out.append((row + a, np.full(len(row), k), c, left, right, sign.view(np.int64)))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else ()

    def around(self, c, left, right):
        """The part of a window that the shortest passages reach."""
        return np.maximum(left, c - self.width), np.minimum(right, c + self.width)

    def seeds(self, column: pa.Array) -> tuple[np.ndarray, ...]:
        """``row, c, signature, context, need`` of longer shingles, one at least in every run of ``RUN`` words, and where each row's words begin.

        ``need``: a shingle of which passages hold as many words is explained; 0 if others are linked to it only.

        Shingles within a row of up to ``PERIOD`` words that repeat have one context, so all are linked to the first: one such row is as alike to the next as to any.
        Only a row as long as a passage has to be explained by itself. A shorter one is part of a passage with other words. If those are
        more than ``RUN - RUN_SHINGLE`` on one side, there are shingles that hold them; if fewer on both, the passage is little more than the row (an
        unlike word would cost more shingles than are left), and the shingles that reach one word beyond the row's ends are given, too.
        """
        out, firsts = [], [np.zeros(1, np.int64)]
        passage, slack = self.width + self.shingle - 1, RUN - RUN_SHINGLE
        for a, b in pieces(text_ends(column), STEP_BYTES):
            words_h, words = word_hashes(column.slice(a, b - a))
            first = words.first
            firsts.append(first[1:] + firsts[-1][-1])
            h = shingles_of(words_h, words, RUN_SHINGLE)
            at = smallest(h, slack + 1)
            need = np.full(len(at), RUN_SHINGLE)
            same, more, more_need = np.zeros(len(at), bool), [], []
            for low, high, step in repeats(words_h, first, RUN_SHINGLE):
                of = np.searchsorted(low, at, "right") - 1
                inside = np.flatnonzero(of >= 0)
                inside = inside[(at[inside] + RUN_SHINGLE <= high[of[inside]]) & ~same[inside]]
                same[inside] = True
                # Of the places within a row, the first, the last and some between; of a short one, for others to be linked to.
                of = of[inside]
                new = _group(of)
                turn = np.arange(len(of)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(of) else of
                stays = (turn % (slack // step + 1) == 0) | np.append(new[1:], True)[: len(of)]
                need[inside] = np.where(~stays, -1, np.where(high[of] - low[of] < passage, 0, RUN_SHINGLE))
                row = np.searchsorted(first, low, "right") - 1
                before, after = np.flatnonzero(low > first[row]), np.flatnonzero(high < first[row + 1])
                ends = np.append(before, after)
                more.append(np.append(low[before] - 1, high[after] - RUN_SHINGLE + 1))
                more_need.append(np.where((high - low)[ends] < passage - 2 * slack, 0, RUN_SHINGLE - 1))
            stays = need >= 0
            at, need, same = at[stays], need[stays], same[stays]
            more, more_need = np.concatenate(more), np.concatenate(more_need)
            order = np.lexsort((-more_need, more))
            order = order[_group(more[order])]
            order = order[~np.isin(more[order], at)]
            at, need = np.append(at, more[order]), np.append(need, more_need[order])
            same = np.append(same, np.zeros(len(order), bool))
            row = np.searchsorted(first, at, "right") - 1
            c = at - first[row]
            left, right = np.maximum(c - 2 * self.width, 0), np.minimum(c + RUN_SHINGLE + 2 * self.width, words.counts[row])
            around = run_hashes(words_h, first[row] + left, first[row] + right) ^ mix((c - left).astype(np.uint64))
            around[same] = 0
            out.append((row + a, c, h[at], around, need))
        return (*(np.concatenate(x) for x in zip(*out, strict=True)), np.concatenate(firsts)) if out else ()


def parts_of(sign: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bits of the window and those of its context."""
    return sign >> CONTEXT_BITS, sign & ((1 << CONTEXT_BITS) - 1)


def copies(sign, context, doc, key) -> tuple[np.ndarray, np.ndarray]:
    """For rows in the order of their texts: the first row of the same signature and context, and whether it is of another text."""
    order = np.lexsort((np.arange(len(sign)), context, sign))
    new = _group(sign[order], context[order])
    lead = np.empty(len(order), np.int64)
    lead[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return lead, (doc != doc[lead]) | (key != key[lead])


class Linker:
    """Links the windows of each signature as they come, by signature, document and place; holds a bounded number of them."""

    def __init__(self, finder: Finder) -> None:
        self.finder = finder
        self.carried: list[np.ndarray] | None = None

    def links(self, sign, context, doc, key, k, c, left, right) -> Iterator[dict]:
        number = np.zeros(len(sign), np.int64)
        rows, old = [sign, context, doc, key, k, c, left, right, number], 0
        if self.carried is not None and self.carried[0][-1] == sign[0]:
            old = len(self.carried[0])
            rows = [np.concatenate([v, w]) for v, w in zip(self.carried, rows, strict=True)]
        sign, context, doc, key, k, c, left, right, number = rows
        fresh = np.arange(len(sign)) >= old
        lead, copy = copies(sign, context, doc, key)
        x = np.flatnonzero(copy & fresh)
        low, high = self.finder.around(c[x], left[x], right[x])
        a = lead[x]
        yield {"x": (doc[x], key[x]), "a": (doc[a], key[a]), "k": k[x] + COPY, "xc": c[x], "xl": low, "xr": high, "ac": c[a], "al": c[a] - (c[x] - low), "ar": c[a] + (high - c[x])}
        # Copies are done with; the others are numbered within their signature, after those carried.
        item = np.flatnonzero(~(copy & fresh))
        sign, context, doc, key, k, c, left, right, number, fresh = (v[item] for v in (*rows, fresh))
        new = _group(sign)
        begin = np.flatnonzero(new)[np.cumsum(new) - 1]
        kept = int((~fresh).sum())
        place = np.arange(len(sign))
        number = np.where(fresh, place - begin, number)
        if kept:
            ahead = fresh & (begin == 0)
            number[ahead] = number[kept - 1] + 1 + place[ahead] - kept
        at, to = [], []
        for lag in range(1, NEAREST + 1):
            i = np.flatnonzero(fresh & (place - begin >= lag))
            j = i - lag
            good = number[i] - number[j] == lag
            at.append(i[good])
            to.append(j[good])
        many = fresh & (number > NEAREST)
        at.append(np.flatnonzero(many))
        to.append(begin[many])
        x, a = np.concatenate(at), np.concatenate(to)
        good = (doc[x] != doc[a]) | (key[x] != key[a])
        x, a = x[good], a[good]
        yield {"x": (doc[x], key[x]), "a": (doc[a], key[a]), "k": k[x], "xc": c[x], "xl": left[x], "xr": right[x], "ac": c[a], "al": left[a], "ar": right[a]}
        # With the first window that is one too many, those before it are named, too.
        turn = np.flatnonzero(many & (number == NEAREST + 1))
        x = np.concatenate([np.flatnonzero(many), (turn[:, None] - np.arange(1, NEAREST + 2)).ravel()])
        yield {"x": (doc[x], key[x]), "k": np.full(len(x), REST), "xc": c[x], "a_doc": sign[x]}
        last = np.flatnonzero(sign == sign[-1])
        last = np.append(last[:1], last[1:][-CARRIED:])
        self.carried = [v[last] for v in (sign, context, doc, key, k, c, left, right, number)]


_NONE = np.iinfo(np.int64).max


def _ids(column: pa.Array) -> np.ndarray:
    """Ids with the largest number for NULL, so that it comes last."""
    return column.cast(pa.int64()).fill_null(_NONE).to_numpy(zero_copy_only=False)


def _back(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, mask=ids == _NONE)


def find_passages(docs: DataFrame, **parameters) -> DataFrame:
    """``doc_id, text_key, start, length, source_id, source_key, source_start, similarity``.

    One row per passage of a document that is a near copy of a passage of an earlier one:
    ``length`` words from word ``start``, at least ``passage`` of them, whose shingle sets have
    a Jaccard similarity of ``similarity`` or more. Earlier is by doc_id, NULL last, then by
    hash of the text. Words are compared without ASCII case. Rows of equal id and text are one
    document; equal texts of different ids are passages of each other; repeats inside one
    document are left. NULL texts and texts shorter than a passage give no rows, as do empty
    tables; other columns are not read.

    Every window that differs from those of its signature in the words around it is linked to all of them, or if they are many and
    no passage found with the nearest ones holds it, to all that have a run of words in common with it. A passage has at least one
    source, the first of those that are copies of each other; further ones are given as far as they were compared.

    Two shuffles carry windows and links, and one the texts; texts with windows of many others are read once more.
    """
    finder = Finder(**parameters)
    narrow = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string"))

    # 1. Windows; copies within one run of rows are linked at once, and the first of them goes on.
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", TOGETHER_BYTES)):
            doc, key = _ids(batch.column("doc_id")), batch.column("text_key").to_numpy(zero_copy_only=False)
            found = finder.windows(batch.column("text"))
            if not found or not len(found[0]):
                continue
            order = np.lexsort((found[2], key[found[0]], doc[found[0]]))
            row, k, c, left, right, sign = (v[order] for v in found)
            doc, key = doc[row], key[row]
            lead, copy = copies(*parts_of(sign), doc, key)
            low, high = finder.around(c, left, right)
            kept = np.flatnonzero(~copy)
            yield _table(WINDOW, sign=sign[kept], x_doc=_back(doc[kept]), x_key=key[kept], k=k[kept], xc=c[kept], xl=left[kept], xr=right[kept])
            x, a = np.flatnonzero(copy), lead[copy]
            if len(x):
                # Partitioned by the text instead, so that a signature of many copies does not fill one task.
                yield _table(WINDOW, sign=key[x], x_doc=_back(doc[x]), x_key=key[x], a_doc=_back(doc[a]), a_key=key[a], k=k[x] + COPY, xc=c[x], xl=low[x], xr=high[x], ac=c[a])

    # 2. One signature's windows from different tasks meet, and are linked.
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linker = Linker(finder)
        for batch in batches:
            done = pc.is_valid(batch.column("a_key"))
            if pc.any(done).as_py():
                part = batch.filter(done)
                xc, xl, xr, ac = (part.column(n).to_numpy() for n in ("xc", "xl", "xr", "ac"))
                yield _table(LINK, **{n: part.column(n) for n in (*PAIR_KEYS, "k", "xc", "xl", "xr", "ac")}, al=ac - (xc - xl), ar=ac + (xr - xc))
                batch = batch.filter(pc.invert(done))
            if not len(batch):
                continue
            doc, key = _ids(batch.column("x_doc")), batch.column("x_key").to_numpy(zero_copy_only=False)
            sign, *rest = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("sign", "k", "xc", "xl", "xr"))
            for found in linker.links(*parts_of(sign), doc, key, *rest):
                (x_doc, x_key), (a_doc, a_key) = found.pop("x"), found.pop("a", (None, None))
                if len(x_doc):
                    sources = {} if a_key is None else {"a_doc": _back(a_doc), "a_key": a_key}
                    yield _table(LINK, x_doc=_back(x_doc), x_key=x_key, **sources, **found)

    links = (
        narrow.mapInArrow(released(made), WINDOW)
        .repartition(F.shiftright("sign", CONTEXT_BITS))
        .sortWithinPartitions(F.shiftright("sign", CONTEXT_BITS), F.col("x_doc").asc_nulls_last(), "x_key", "xc")
        .mapInArrow(released(linked), LINK)
    )
    found = checkpointed(_candidates(links, finder, finder.enough))
    first = _compared(found.where("a_key is not null"), narrow, finder).distinct()
    rest = found.where("a_key is null")
    if not rest.take(1):
        return first
    first = checkpointed(first)
    return first.union(_compared(checkpointed(_candidates(_rest_links(rest, first, narrow, finder), finder, 1)), narrow, finder)).distinct()


def _candidates(links: DataFrame, finder: Finder, enough: int) -> DataFrame:
    """The links of a pair of texts meet, and give the passages to compare; places of windows that are one of many pass through."""

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches, PAIR_KEYS):
            rest = pc.is_null(batch.column("a_key"))
            if pc.any(rest).as_py():
                part = batch.filter(rest)
                yield _table(CANDIDATE, x_doc=part.column("x_doc"), x_key=part.column("x_key"), a_doc=part.column("a_doc"), xs=part.column("xc"))
                batch = batch.filter(pc.invert(rest))
            if not len(batch):
                continue
            ids = [_ids(batch.column(n)) for n in PAIR_KEYS]
            pair, at = _number(*ids)
            k, *rest = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("k", "xc", "xl", "xr", "ac", "al", "ar"))
            # A link between copies counts as many times as is enough.
            again = np.concatenate([np.arange(len(k)), *[np.flatnonzero(k >= COPY)] * (enough - 1)])
            lane = np.concatenate([k, *(k[k >= COPY] + i * COPY for i in range(1, enough))])
            p, xs, xe, as_, ae = passages(pair[again], lane, *(v[again] for v in rest), finder.width, enough, finder.shift)
            if len(p):
                xd, xk, ad, ak = (v[at][p] for v in ids)
                # Snapped outwards, the passages that many texts ask of one are few.
                yield _table(CANDIDATE, x_doc=_back(xd), x_key=xk, a_doc=_back(ad), a_key=ak, xs=xs, xe=xe, **{"as": as_ // 64 * 64, "ae": -(-ae // 64) * 64})

    return links.repartition(*PAIR_KEYS).sortWithinPartitions(*PAIR_KEYS).mapInArrow(released(grouped), CANDIDATE)


def _rest_links(rest: DataFrame, first: DataFrame, narrow: DataFrame, finder: Finder) -> DataFrame:
    """Links of what the passages found so far leave open, to texts with a run of words in common.

    Of seeds with the same words around them, all are linked to the first; that one is compared with the others of its signature,
    and linked to the sources whose passages reach furthest.
    """
    reach = 2 * finder.width
    spans = first.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "length")).alias("spans")).toDF("s_doc", "s_key", "spans")
    # Only signatures of several texts matter, of which a place is not explained.
    side = (RUN - finder.shingle) // 2
    inside = F.exists("spans", lambda p: (p["start"] <= F.greatest(F.col("xs") - side, F.lit(0))) & (p["start"] + p["length"] >= F.col("xs") + finder.shingle + side))
    order = F.struct(F.coalesce("x_doc", F.lit(_NONE)), "x_key")
    placed = (
        rest.join(spans, F.col("x_doc").eqNullSafe(F.col("s_doc")) & (F.col("x_key") == F.col("s_key")), "left")
        .select("x_doc", "x_key", "xs", F.col("a_doc").alias("sign"), order.alias("order"), (~F.coalesce(inside, F.lit(False))).alias("open"))
    )
    signs = placed.groupBy("sign").agg(F.max("open").alias("any"), F.min("order").alias("least"), F.max("order").alias("most"))
    placed = placed.join(signs.where("any and least < most").select("sign"), "sign", "left_semi")
    places = checkpointed(placed.groupBy("x_doc", "x_key").agg(F.collect_set("xs").alias("places")))
    asked = places.join(spans, F.col("x_doc").eqNullSafe(F.col("s_doc")) & (F.col("x_key") == F.col("s_key")), "left").select("x_doc", "x_key", "places", "spans")
    texts = semi_reduce(narrow, "text_key", places, "x_key").join(asked, F.col("doc_id").eqNullSafe(F.col("x_doc")) & (F.col("text_key") == F.col("x_key")))

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", STEP_BYTES)):
            found = finder.seeds(batch.column("text"))
            if not found or not len(found[0]):
                continue
            row, c, sign, same, need, first = found
            of, flat = _flat(batch.column("places"))
            at = flat.to_numpy(zero_copy_only=False).astype(np.int64)
            near = _marked(first, of, at - reach, at + finder.shingle + reach)
            of, flat = _flat(batch.column("spans"))
            start, length = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            held = np.append(0, np.cumsum(_marked(first, of, start, start + length)))
            at = first[row] + c
            wide = np.flatnonzero(near[at])
            row, c, sign, same, need, at = (v[wide] for v in (row, c, sign, same, need, at))
            yield _table(
                SEED, sign=sign.view(np.int64), context=same.view(np.int64), doc=_back(_ids(batch.column("doc_id"))[row]), key=batch.column("text_key").take(pa.array(row)),
                c=c, open=held[at + RUN_SHINGLE] - held[at] < need,
            )

    order = F.struct(F.coalesce("doc", F.lit(_NONE)).alias("order"), "key")
    made = texts.select("doc_id", "text_key", "text", "places", "spans").mapInArrow(released(seeded), SEED)
    with shuffles_removed(made.sparkSession), staged(made, "seeds") as seeds:
        # A signature that only one text has, or in which nothing is open, links nothing.
        signs = seeds.select("sign", "open", F.xxhash64("doc", "key").alias("text")).groupBy("sign").agg(F.max("open").alias("any"), F.min("text").alias("least"), F.max("text").alias("most"))
        signs = checkpointed(signs.where("any and least < most").select("sign"))
        seeds = checkpointed(semi_reduce(seeds, "sign", signs, "sign").withColumn("text", order))
    leads = seeds.groupBy("sign", "context").agg(F.min(F.struct("text", "c", "doc")).alias("a")).toDF("a_sign", "a_context", "a")
    same = seeds.join(leads, (F.col("sign") == F.col("a_sign")) & (F.col("context") == F.col("a_context")))
    copy = same.where("open and a.text < text").select(
        F.col("doc").alias("x_doc"), F.col("text.key").alias("x_key"), F.col("a.doc").alias("a_doc"), F.col("a.text.key").alias("a_key"),
        F.col("c").alias("xc"), F.col("a.c").alias("ac"),
    )
    # The others are the first of their context, or in the same text as it.
    other = same.where("a.text = text").groupBy("doc", "key").agg(F.collect_set(F.struct("sign", "c", "open")).alias("seeds"))
    pairs = copy.union(_sources(checkpointed(other.toDF("s_doc", "s_key", "seeds")), narrow, finder).select(copy.columns))
    reached = {"xl": F.greatest(F.col("xc") - reach, F.lit(0)), "xr": F.col("xc") + reach, "al": F.greatest(F.col("ac") - reach, F.lit(0)), "ar": F.col("ac") + reach}
    return pairs.select(*PAIR_KEYS, F.lit(0).alias("k"), "xc", reached["xl"].alias("xl"), reached["xr"].alias("xr"), "ac", reached["al"].alias("al"), reached["ar"].alias("ar"))


def _sources(asked: DataFrame, narrow: DataFrame, finder: Finder) -> DataFrame:
    """``x_doc, x_key, a_doc, a_key, xc, ac``: for open seeds, those of earlier texts and the same signature whose surroundings hold the furthest-reaching passages.

    The seeds of a signature meet in one task, more than ``MEMBERS`` of them in tiles of so many that ask and so many that answer.
    """
    sizes = asked.select(F.explode("seeds").alias("seed")).groupBy("seed.sign").agg(F.count("*").alias("all"), F.count_if("seed.open").alias("open"))
    # At most one signature for every MEMBERS seeds.
    tiles = {r.sign: (-(-r.open // MEMBERS), -(-r.all // MEMBERS)) for r in sizes.where(F.col("all") > MEMBERS).collect()}
    texts = semi_reduce(narrow, "text_key", asked, "s_key").join(asked, F.col("doc_id").eqNullSafe(F.col("s_doc")) & (F.col("text_key") == F.col("s_key")))
    before, size = finder.passage - RUN_SHINGLE, 2 * finder.passage - RUN_SHINGLE

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", STEP_BYTES)):
            h, words = word_hashes(batch.column("text"))
            of, flat = _flat(batch.column("seeds"))
            sign, c, is_open = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            doc, key = _ids(batch.column("doc_id"))[of], batch.column("text_key").to_numpy(zero_copy_only=False)[of]
            short = np.append((h >> np.uint64(32)).astype(np.uint32) | np.uint32(1), np.uint32(0))
            rows, tile, asks, answers = (np.concatenate(v) for v in zip(*_tiled(sign, doc, key, is_open, tiles), strict=True))
            for low in range(0, len(rows), MEMBERS):
                at = rows[low : low + MEMBERS]
                place = (c[at].astype(np.int64) - before)[:, None] + np.arange(size)
                inside = (place >= 0) & (place < words.counts[of[at]][:, None])
                around = short[np.where(inside, place + words.first[of[at]][:, None], len(h))]
                around = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.arange(0, 4 * size * len(at) + 1, 4 * size, dtype=np.int32)), pa.py_buffer(around)])
                some = slice(low, low + MEMBERS)
                yield _table(AROUND, sign=sign[at], tile=tile[some], doc=_back(doc[at]), key=key[at], c=c[at], asks=asks[some], answers=answers[some], words=around)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole_groups(batches, ["sign", "tile"]):
            group = np.cumsum(_group(_ids(whole.column("sign")), _ids(whole.column("tile"))))
            # Whole groups, some thousand rows at a time.
            ends = np.searchsorted(group, np.arange(1, group[-1] + 1), "right")
            for low, high in pieces(ends, MEMBERS):
                a, b = int(ends[low - 1]) if low else 0, int(ends[high - 1])
                batch = whole.slice(a, b - a)
                doc, key = _ids(batch.column("doc")), _ids(batch.column("key"))
                asks, answers = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("asks", "answers"))
                words = np.frombuffer(b"".join(batch.column("words").to_pylist()), np.uint32).reshape(len(batch), size)
                x, y = furthest(finder, group[a:b], doc, key, asks, answers, words)
                if len(x):
                    c = batch.column("c").to_numpy(zero_copy_only=False)
                    yield _table(SOURCE, x_doc=_back(doc[x]), x_key=key[x], a_doc=_back(doc[y]), a_key=key[y], xc=c[x], ac=c[y])

    order = ["sign", "tile", F.col("doc").asc_nulls_last(), "key", "c"]
    around = texts.select("doc_id", "text_key", "text", "seeds").mapInArrow(released(placed), AROUND)
    return around.repartition("sign", "tile").sortWithinPartitions(*order).mapInArrow(released(compared), SOURCE)


def _tiled(sign, doc, key, is_open, tiles: dict[int, tuple[int, int]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Seeds, the tile of their signature that they go to, and whether they ask and answer there."""
    many = np.isin(sign, np.fromiter(tiles, np.int64, len(tiles)))
    one = np.flatnonzero(~many)
    yield one, np.zeros(len(one), np.int64), is_open[one].astype(bool), np.ones(len(one), bool)
    lot = mix(doc.view(np.uint64) ^ mix(key.view(np.uint64)))
    for i in np.flatnonzero(many).tolist():
        across, down = tiles[int(sign[i])]
        if is_open[i]:
            to = int(lot[i] % np.uint64(across)) * down + np.arange(down)
            yield np.full(down, i), to, np.ones(down, bool), np.zeros(down, bool)
        to = np.arange(across) * down + int(mix(lot[i : i + 1])[0] % np.uint64(down))
        yield np.full(across, i), to, np.zeros(across, bool), np.ones(across, bool)


def furthest(finder: Finder, group, doc, key, asks, answers, words) -> tuple[np.ndarray, np.ndarray]:
    """For rows by group and text: rows that ask, and the rows of earlier texts of their group they are linked to.

    ``words`` are those around a seed that the shortest passages with it reach. Of all rows whose passage holds the seed,
    those are given that reach furthest before and behind it, so that together they cover what any of them covers.
    """
    width = finder.width
    total = np.zeros((len(words), words.shape[1] - finder.shingle + 1), np.uint64)
    there = np.ones(total.shape, bool)
    for k in range(finder.shingle):
        part = words[:, k : k + total.shape[1]]
        total = total * _ODD + part
        there &= part > 0
    shingles = np.where(there, (mix(total) >> np.uint64(32)).astype(np.uint32) | np.uint32(1), np.uint32(0))
    slot = np.where(there, shingles >> np.uint32(1) & np.uint32(SLOTS - 1), SLOTS).astype(np.int64)
    table = np.zeros((len(words), SLOTS + 1), bool)
    table[np.arange(len(words))[:, None], slot] = True
    table[:, SLOTS] = False
    # A shingle that a text repeats counts against it once: where each stood before.
    order = np.argsort(shingles, axis=1, kind="stable")
    ordered = np.take_along_axis(shingles, order, axis=1)
    before = np.full(total.shape, -1, np.int16)
    np.put_along_axis(before, order[:, 1:], np.where((ordered[:, 1:] == ordered[:, :-1]) & (ordered[:, 1:] > 0), order[:, :-1], -1).astype(np.int16), axis=1)
    again = before >= 0
    # The rows that may answer are those before the first of the same text.
    answer = np.flatnonzero(answers)
    held = np.append(0, np.cumsum(answers))
    begin, text = (np.flatnonzero(new)[np.cumsum(new) - 1] for new in (_group(group), _group(group, doc, key)))
    x = np.flatnonzero(asks & (held[begin] < held[text]))
    count = held[text[x]] - held[begin[x]]
    enough = math.ceil(finder.similarity * width - 1e-9)
    flat, row = table.ravel(), np.arange(len(words)) * (SLOTS + 1)
    found: tuple[list, list] = ([], [])
    for a, b in pieces(np.cumsum(count), PAIRS):
        i = np.repeat(x[a:b], count[a:b])
        j = answer[run_ranges(held[begin[x[a:b]]], count[a:b])]
        hit = flat[slot[i] + row[j][:, None]] | again[i]
        sums = np.zeros((len(i), hit.shape[1] + 1), np.int16)
        np.cumsum(hit, axis=1, dtype=np.int16, out=sums[:, 1:])
        good = sums[:, width:] - sums[:, :-width] >= enough
        some = np.flatnonzero(good.any(axis=1))
        some = some[_likely(finder, shingles, before, i[some], j[some])]
        i, j, good = i[some], j[some], good[some]
        low, high = good.argmax(axis=1), good.shape[1] - 1 - good[:, ::-1].argmax(axis=1)
        new = np.append(np.flatnonzero(_group(i)), len(i)) if len(i) else np.zeros(1, np.int64)
        for s, e in zip(new[:-1].tolist(), new[1:].tolist(), strict=True):
            _chosen(finder, shingles, int(i[s]), j[s:e], low[s:e], high[s:e], found)
    return np.array(found[0], np.int64), np.array(found[1], np.int64)


def _likely(finder: Finder, shingles, before, x, a) -> np.ndarray:
    """Which pairs have a stretch of the shortest length with few different shingles unlike, also counting those of the other text between what stands in both."""
    width, good, step = finder.width, np.zeros(len(x), bool), PAIRS // 16
    for k in range(0, len(x), step):
        i, j = x[k : k + step], a[k : k + step]
        mine, other, earlier, earlier_there = shingles[i], shingles[j], before[i], before[j]
        equal = mine[:, :, None] == other[:, None, :]
        there, straight = mine > 0, (mine == other) & (mine > 0)
        hit = equal.any(axis=2) & there
        unlike, strange = ~hit & there, ~equal.any(axis=1) & (other > 0)
        # From the first to the last that stands in both.
        long = hit.shape[1] - hit[:, ::-1].argmax(axis=1) - hit.argmax(axis=1) >= width
        # Without repeats, a passage ends with what stands in both, so all that lies in between counts.
        single = ((earlier < 0).all(axis=1) & (earlier_there < 0).all(axis=1))[:, None]
        for s in range(hit.shape[1] - width + 1):
            part = slice(s, s + width)
            new = earlier[:, part] < s
            alike, gone = (np.count_nonzero(v[:, part] & new, axis=1) for v in (hit, unlike))
            low = s + straight[:, part].argmax(axis=1)
            inside = np.logical_or.accumulate(straight[:, part], axis=1) & np.logical_or.accumulate(straight[:, part][:, ::-1], axis=1)[:, ::-1]
            added = np.count_nonzero(strange[:, part] & (inside | single) & (earlier_there[:, part] < low[:, None]), axis=1)
            whole = there[:, s] & there[:, s + width - 1] & long
            good[k : k + step] |= whole & (alike >= (finder.similarity - SLACK) * (alike + gone + added))
    return good


def _chosen(finder: Finder, shingles, x: int, rows, low, high, found) -> None:
    """Of the rows that may hold a passage, the first that does in the order of either reach."""
    seen: dict[int, bool] = {}
    last = -1
    for order in (np.lexsort((np.arange(len(rows)), low)), np.lexsort((np.arange(len(rows)), -high))):
        if last >= 0 and high[last] == high[order[0]]:
            break
        for n in order.tolist():
            if n not in seen:
                seen[n] = bool(verify(shingles[x], shingles[rows[n]], finder.width, finder.similarity))
                if seen[n]:
                    found[0].append(x)
                    found[1].append(int(rows[n]))
            if seen[n]:
                last = n
                break


def _flat(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of each element, and the elements."""
    return pc.list_parent_indices(lists).to_numpy(zero_copy_only=False), lists.flatten()


def _marked(first: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which words lie in one of the ranges of places within a row."""
    size = (first[1:] - first[:-1])[row]
    mark = np.zeros(int(first[-1]) + 1, np.int64)
    np.add.at(mark, first[row] + np.clip(start, 0, size), 1)
    np.add.at(mark, first[row] + np.clip(end, 0, size), -1)
    return np.cumsum(mark)[:-1] > 0


def _compared(pending: DataFrame, narrow: DataFrame, finder: Finder) -> DataFrame:
    """The shingles of passages are fetched from the texts, and compared."""
    candidate = F.struct(*PAIR_KEYS, "xs", "as").alias("candidate")
    roles = pending.select("x_doc", "x_key", "xs", "xe", candidate, F.lit(True).alias("is_x")).toDF("doc", "key", "s", "e", "candidate", "is_x").union(
        pending.select("a_doc", "a_key", "as", "ae", candidate, F.lit(False))
    )
    wanted = roles.select("doc", "key", "s", "e").distinct().groupBy("doc", "key").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    texts = semi_reduce(narrow, "text_key", wanted, "key").join(wanted, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("text_key") == F.col("key")))

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", STEP_BYTES):
                h, first, words = shingle_hashes(batch.column("text"), finder.shingle)
                spans = batch.column("spans")
                row = pc.list_parent_indices(spans).to_numpy(zero_copy_only=False)
                flat = spans.flatten()
                s, e = (np.minimum(flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64), words.counts[row]) for i in (0, 1))
                at = run_ranges(first[row] + s, e - s)
                yield pa.record_batch(
                    {
                        "f_doc": batch.column("doc_id").take(pa.array(row)),
                        "f_key": batch.column("text_key").take(pa.array(row)),
                        "f_s": flat.field(0),
                        "f_e": flat.field(1),
                        "shingles": pa.ListArray.from_arrays(
                            pa.array(np.append(0, np.cumsum(e - s)).astype(np.int32)), pa.array((h[at] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                        ),
                    }
                )

    parts = texts.select("doc_id", "text_key", "text", "spans").mapInArrow(released(fetched), "f_doc long, f_key long, f_s int, f_e int, shingles array<int>")
    both = (
        roles.join(parts, F.col("doc").eqNullSafe(F.col("f_doc")) & (F.col("key") == F.col("f_key")) & (F.col("s") == F.col("f_s")) & (F.col("e") == F.col("f_e")))
        .groupBy("candidate")
        .agg(
            F.first(F.when(F.col("is_x"), F.col("shingles")), ignorenulls=True).alias("x"),
            F.first(F.when(~F.col("is_x"), F.col("shingles")), ignorenulls=True).alias("a"),
        )
        .select("candidate.*", "x", "a")
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, as_ = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("xs", "as"))
            left, right = batch.column("x"), batch.column("a")
            good = [
                (i, xs[i] + s, e - s + finder.shingle - 1, as_[i] + b, score)
                for i in range(len(batch))
                for s, e, b, score in verify(left[i].values.to_numpy(), right[i].values.to_numpy(), finder.width, finder.similarity)
            ]
            if good:
                i, start, length, source, score = zip(*good, strict=True)
                part = batch.take(pa.array(i))
                yield _table(
                    PASSAGE_ROW, doc_id=part.column("x_doc"), text_key=part.column("x_key"), start=start, length=length,
                    source_id=part.column("a_doc"), source_key=part.column("a_key"), source_start=source, similarity=score,
                )

    return both.mapInArrow(released(compared), PASSAGE_ROW)


PAIR_KEYS = ["x_doc", "x_key", "a_doc", "a_key"]


def _table(schema: str, **columns) -> pa.RecordBatch:
    """A batch with the columns of a schema string, NULL where none is given."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}
    n = len(next(iter(columns.values())))
    names, arrays = [], []
    for part in schema.split(", "):
        name, kind = part.split(" ")
        value = columns.get(name)
        names.append(name)
        if value is None:
            arrays.append(pa.nulls(n, kinds[kind]))
        elif isinstance(value, pa.Array):
            arrays.append(value)
        else:
            arrays.append(pa.array(np.asarray(value), kinds[kind]))
    return pa.RecordBatch.from_arrays(arrays, names)


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rearrange sorted batches so that no group of equal keys is cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        new = _group(*(_ids(batch.column(k)) for k in keys))
        cuts = np.flatnonzero(new)
        begins = not held or any(_ids(held[-1].column(k))[-1] != _ids(batch.column(k))[0] for k in keys)
        if begins and held:
            yield _joined(held)
            held = []
        if len(cuts) > 1:
            yield _joined([*held, batch.slice(0, int(cuts[-1]))])
            held = [batch.slice(int(cuts[-1]))]
        else:
            held.append(batch)
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def cut_passages(docs: DataFrame, **parameters) -> DataFrame:
    """The documents with repeated passages cut out of all but the earliest text that holds them.

    A text of which no word is left goes; ``n_chars`` follows the text. Texts without a
    repeated passage, NULL ones included, stay as they are.
    """
    spans = (
        find_passages(docs, **parameters)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("start", "length")).alias("_spans"))
        .select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "_spans")
    )
    held = docs.select(F.col("doc_id").cast("long").alias("row_id"), F.xxhash64("text").alias("row_key"), whole_row(docs))
    joined = held.join(spans, F.col("row_id").eqNullSafe(F.col("_doc")) & (F.col("row_key") == F.col("_key")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, spans = text_of(batch.column("row")).to_pylist(), batch.column("_spans").to_pylist()
            kept = []
            for i, found in enumerate(spans):
                if found:
                    text[i] = without(text[i], [(p["start"], p["start"] + p["length"]) for p in found])
                    if not text[i].strip(" \t\n\v\f\r"):
                        continue
                kept.append(i)
            columns = [batch.column("row"), pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "cut"]).take(pa.array(kept, pa.int64()))

    cut = joined.select("row", "_spans").mapInArrow(released(run), StructType([StructField("row", docs.schema), StructField("cut", StringType())]))
    changed = ~F.col("cut").eqNullSafe(F.col("row.text").cast("string"))
    made = {"text": F.col("cut")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(changed, F.char_length("cut")).otherwise(F.col("row.n_chars"))
    return cut.select(
        *[made[f.name].cast(f.dataType).alias(f.name) if f.name in made else F.col(f"row.`{f.name}`") for f in docs.schema.fields]
    )


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of these spans and the white space after each of them."""
    words = find_words(*batch_bytes(pa.array([text])))
    gone = np.zeros(len(words) + 1, np.int64)
    for a, b in spans:
        gone[a] += 1
        gone[min(b, len(words))] -= 1
    out = (np.cumsum(gone[:-1]) > 0).astype(np.int8)
    edges = np.diff(out, prepend=0, append=0)
    raw, parts, at = words.data.tobytes(), [], 0
    for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
        parts.append(raw[at : words.starts[a]])
        at = words.starts[b] if b < len(words) else len(raw)
    return b"".join([*parts, raw[at:]]).decode()
