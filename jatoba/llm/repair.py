"""Repair of conversation structure by a square-root checkpointed dynamic programme.

A conversation is to read ``(s?(ua)+)?`` by the initials of its roles. Each row is kept (0), given the role
that is due (1) or deleted (2); an empty row of the role due may be inserted (5); a truncated row that stays
costs 5 more; blank and repeated rows must go. Four states say what stood last, and the cost to the end from
each of them is a vector of four numbers that is worked out backwards.

Rows stand in order in blocks of about the square root of the longest conversation. Backward vectors are kept
only where a conversation meets a block's end: a block gives the transfer matrix of its first
and its last conversation, a scan over the blocks of a conversation gives the vectors there. Each
block then works out its inner vectors anew, itself with checkpoints at square-root distance, and
walks forward along the cheapest edits, the ASCII-least first. What a task holds is a block, however long a conversation is;
only its repaired text, whose hash has one order, streams through one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import ceil, isqrt, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jatoba.session import stage

WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
NEVER = 1 << 40
# States: nothing yet, after the system's row, after the user's, after the assistant's.
DUE = ("user", "user", "assistant", "user")
NEXT = (2, 2, 3, 2)
"""The state after a row of the role that is due."""
DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5
FITTING = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
"""By role (s, u, a, another): the state that a kept row leads to from each state where it fits."""
SOUND, TRUNCATED, GONE = 0, 4, 8
"""A symbol is one of these and the number of the role."""
LEAST_BLOCK, MOST_BLOCK = 10, 20
"""Bits of the length of a block."""


def _closed(vector: list[int]) -> list[int]:
    """Costs with inserted rows before whatever comes."""
    out = list(vector)
    for _ in range(3):
        out = [min(out[q], INSERT + out[NEXT[q]]) for q in range(4)]
    return out


END = _closed([0, NEVER, NEVER, 0])


def _edits(symbol: int) -> list[list[tuple[str, int, int]]]:
    """By state: the edits of a row in ASCII order, as initial, cost and next state."""
    role, kind = symbol % 4, symbol - symbol % 4
    more = CUT if kind == TRUNCATED else 0
    found = []
    for q in range(4):
        edits = [("D", DELETE, q)]
        if kind != GONE:
            if q in FITTING[role]:
                edits.append(("K", more, FITTING[role][q]))
            edits.append(("R", REROLE + more, NEXT[q]))
        found.append(edits)
    return found


EDITS = [_edits(symbol) for symbol in range(12)]


def back(symbol: int, after: list[int]) -> list[int]:
    """The vector before a row from the one after it."""
    return _closed([min(cost + after[to] for _, cost, to in edits) for edits in EDITS[symbol]])


def _matrices() -> np.ndarray:
    out = np.full((12, 4, 4), NEVER, np.int64)
    for symbol in range(12):
        for to in range(4):
            after = [NEVER] * 4
            after[to] = 0
            out[symbol, :, to] = np.minimum(back(symbol, after), NEVER)
    return out


MATRICES = _matrices()


def transfer(symbols: np.ndarray) -> np.ndarray:
    """The least cost from each state before some rows to each state after them: a product of matrices, in pairs."""
    made = MATRICES[symbols]
    while len(made) > 1:
        rest = made[len(made) & ~1 :]
        made = (made[: len(made) & ~1 : 2, :, :, None] + made[1::2, None, :, :]).min(axis=2)
        made = np.minimum(np.concatenate([made, rest]), NEVER)
    return made[0]


def walk(symbols: list[int], end: list[int], last: bool, starts: tuple[int, ...]) -> tuple[list[str], list[int]]:
    """The ASCII-least cheapest edits from each start, and the states they lead to.

    ``end`` is the vector after the rows; ``last`` says that the conversation ends there. Vectors
    are stored at every square root of the rows and worked out anew between two of them.
    """
    step = max(1, isqrt(len(symbols)))
    stored, vector = {}, end
    for i in range(len(symbols) - 1, -1, -1):
        if (i + 1) % step == 0:
            stored[i + 1] = vector
        vector = back(symbols[i], vector)
    stored[0], stored[len(symbols)] = vector, end
    letters, states = [[] for _ in starts], list(starts)
    for first in range(0, len(symbols), step):
        stop = min(first + step, len(symbols))
        vectors = [stored[stop]]
        for i in range(stop - 1, first - 1, -1):
            vectors.append(back(symbols[i], vectors[-1]))
        vectors.reverse()
        for i in range(first, stop):
            here, after = vectors[i - first], vectors[i - first + 1]
            for k, q in enumerate(states):
                (_, cost, _), *others = EDITS[symbols[i]][q]
                if cost + after[q] == here[q]:
                    letters[k].append("D")
                    continue
                while INSERT + here[NEXT[q]] == here[q]:
                    letters[k].append("I")
                    q = NEXT[q]
                    (_, cost, _), *others = EDITS[symbols[i]][q]
                    if cost + after[q] == here[q]:
                        letters[k].append("D")
                        break
                else:
                    letter, q = next((x, to) for x, price, to in others if price + after[to] == here[q])
                    letters[k].append(letter)
                states[k] = q
    if last:
        for k, q in enumerate(states):
            while end[q]:
                letters[k].append("I")
                q = NEXT[q]
            states[k] = q
    return ["".join(x) for x in letters], states


def damaged(talks: DataFrame) -> DataFrame:
    """The rows as ``conv_id, turn, role, text`` without NULLs in the last two, with faults dealt out by ``crc32(conv_id:turn) % 20``."""
    space = F.lit(" ")
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    key = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    return talks.where(kind != 0).select(
        conv.alias("conv_id"), turn.alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


ORDER = ("turn", "role", "digest", "row")


def _prepared(rows: DataFrame) -> DataFrame:
    """Rows with what the edits depend on, written once: a row's number must not change from one reading to the next."""
    shown = F.rtrim("text", F.lit(WHITE))
    role = F.substring("role", 1, 1)
    number = F.when(role == "s", 0).when(role == "u", 1).when(role == "a", 2).otherwise(3)
    fault = F.when(shown == "", GONE).when(F.right(shown, F.lit(1)).isin(*ENDS), SOUND).otherwise(TRUNCATED)
    return rows.select(
        _name(F.col("conv_id")).alias("name"), F.col("turn").cast("long").alias("turn"), "role", "text",
        F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row"), number.alias("number"), fault.alias("fault"),
    )


def _name(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("-"))


def _segments(table: pa.Table) -> tuple[pa.Table, list[int], list[str]]:
    """The rows of a block in order, where its conversations begin (and its end), and their names."""
    table = table.sort_by("id")
    names = table.column("name").to_pylist()
    cuts = [k for k in range(len(names)) if not k or names[k] != names[k - 1]] + [len(names)]
    return table, cuts, names


def _edges(table: pa.Table) -> pa.Table:
    """Transfer matrices of the first and the last conversation of a block."""
    table, cuts, names = _segments(table)
    symbols, block = table.column("symbol").to_numpy(), table.column("block")[0].as_py()
    rows = []
    for k in sorted({0, len(cuts) - 2}):
        rows.append((names[cuts[k]], block, transfer(symbols[cuts[k] : cuts[k + 1]]).ravel().tolist()))
    columns = zip(*rows, strict=True)
    types = (pa.string(), pa.int64(), pa.list_(pa.int64()))
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["name", "block", "matrix"])


def _vectors(table: pa.Table) -> pa.Table:
    """Backward over the blocks of one conversation: the vector at each block's end."""
    table = table.sort_by([("block", "descending")])
    vector, ends = np.array(END), []
    for matrix in table.column("matrix").to_pylist():
        ends.append(vector.tolist())
        vector = (np.array(matrix).reshape(4, 4) + vector).min(axis=1)
    last = [k == 0 for k in range(len(ends))]
    return pa.table(
        [table.column("name"), table.column("block"), pa.array(ends, pa.list_(pa.int64())), pa.array(last)],
        ["name", "block", "end", "last"],
    )


SEGMENT = "name string, block long, turn long, role string, digest binary, row long, faults string, letters array<string>, states array<int>"


def _walks(table: pa.Table, ends: pa.Table) -> pa.Table:
    """The edits of every conversation in a block; of those that may begin or go on elsewhere, from each of the four states."""
    table, cuts, names = _segments(table)
    symbols, block = table.column("symbol").to_pylist(), table.column("block")[0].as_py()
    repeated = table.column("repeated").to_pylist()
    blank = table.column("blank").to_pylist()
    known = {x["name"]: (x["end"], x["last"]) for x in ends.to_pylist()}
    rows = []
    for a, b in zip(cuts, cuts[1:]):
        name = names[a]
        end, last = known.get(name, (END, True))
        found, states = walk(symbols[a:b], end, last, (0, 1, 2, 3) if name in known else (0,))
        faults = "".join("b" if blank[k] else "d" if repeated[k] else "t" if symbols[k] >= TRUNCATED else "-" for k in range(a, b))
        rows.append((name, block, faults, found, states))
    columns = list(zip(*rows, strict=True))
    first = table.select(ORDER).take(pa.array(cuts[:-1]))
    return pa.table(
        [
            pa.array(columns[0]), pa.array(columns[1], pa.int64()), *first.columns, pa.array(columns[2]),
            pa.array(columns[3], pa.list_(pa.string())), pa.array(columns[4], pa.list_(pa.int32())),
        ],
        ["name", "block", *ORDER, "faults", "letters", "states"],
    )


def _starts(table: pa.Table) -> pa.Table:
    """Forward over the blocks of one conversation: the state in which each begins."""
    table = table.sort_by("block")
    state, starts = 0, []
    for states in table.column("states").to_pylist():
        starts.append(state)
        state = states[state]
    return pa.table([table.column("name"), table.column("block"), pa.array(starts, pa.int32())], ["_name", "_block", "start"])


def edits(rows: DataFrame) -> DataFrame:
    """The edits of prepared rows, one row per conversation and block: the order keys of its first row, ``faults`` and ``letters``."""
    keys = [F.col(c).asc_nulls_first() for c in ("name", *ORDER)]
    light = rows.select("name", *ORDER, "number", "fault")
    placed = light.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("id", F.monotonically_increasing_id()).checkpoint()
    longest = placed.groupBy("name").count().agg(F.max("count")).first()[0] or 1
    bits = min(MOST_BLOCK, max(LEAST_BLOCK, ceil(log2(longest) / 2)))
    # The first row of each content is known by its number, so the join has one row a key however often a content recurs.
    first = placed.groupBy("name", "digest").agg(F.min("id").alias("first")).select("first")
    joined = placed.join(first.hint("merge"), F.col("id") == F.col("first"), "left")
    blank, repeated = F.col("fault") == GONE, F.col("first").isNull()
    marked = joined.select(
        "name", *ORDER, "id", F.shiftright("id", bits).alias("block"), blank.alias("blank"), repeated.alias("repeated"),
        (F.col("number") + F.when(repeated, GONE).otherwise(F.col("fault"))).cast("int").alias("symbol"),
    ).checkpoint()
    edges = marked.select("name", "id", "block", "symbol").groupBy("block").applyInArrow(
        _edges, "name string, block long, matrix array<long>"
    )
    vectors = edges.groupBy("name").applyInArrow(_vectors, "name string, block long, end array<long>, last boolean")
    walked = marked.groupBy("block").cogroup(vectors.groupBy("block")).applyInArrow(_walks, SEGMENT).checkpoint()
    open_ones = walked.where(F.size("states") == 4)
    starts = open_ones.select("name", "block", "states").groupBy("name").applyInArrow(
        _starts, "_name string, _block long, start int"
    )
    met = (F.col("name") == F.col("_name")) & (F.col("block") == F.col("_block"))
    started = walked.join(starts, met, "left")
    return started.select("name", *ORDER, "faults", F.get("letters", F.coalesce("start", F.lit(0))).alias("letters"))


class _Talk:
    """One conversation as its rows stream by."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.turns = self.illegal = self.cost = self.state = self.rows = 0
        self.low = self.high = self.initial = None
        self.letters: list[str] = []
        self.faults = {"b": 0, "d": 0, "t": 0, "-": 0}
        self.hash, self.written = sha256(), False
        self.pending, self.at, self.marks, self.mark = "", 0, "", 0

    def edit(self, letters: str, faults: str) -> None:
        """The edits of the rows that follow."""
        self.pending, self.at, self.marks, self.mark = letters, 0, faults, 0
        self.letters.append(letters)

    def _write(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.written else ''}{role}:{text}".encode())
        self.written = True

    def _insert(self) -> None:
        while self.at < len(self.pending) and self.pending[self.at] == "I":
            self._write(DUE[self.state], "")
            self.state, self.cost, self.at = NEXT[self.state], self.cost + INSERT, self.at + 1

    def row(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.initial is not None:
            self.illegal += self.initial + role[:1] not in ("su", "ua", "au")
        self.initial = role[:1]
        fault = self.marks[self.mark]
        self.mark += 1
        self.faults[fault] += 1
        self._insert()
        letter, self.at = self.pending[self.at], self.at + 1
        if letter == "D":
            self.cost += DELETE
            return
        self.cost += (CUT if fault == "t" else 0) + (REROLE if letter == "R" else 0)
        self._write(DUE[self.state] if letter == "R" else role, text)
        self.state = 1 if letter == "K" and role[0] == "s" else NEXT[self.state]

    def result(self) -> tuple:
        self._insert()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        found = (self.faults[x] for x in "bdt")
        return (self.conv_id, gaps, *found, self.illegal, self.cost, "".join(self.letters), self.hash.hexdigest())


RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    names = [field.split()[0] for field in RESULT.split(", ")]

    def made(done: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names)

    talk = None
    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in ("kind", "conv_id", "turn", "role", "text", "letters", "faults")]
        for kind, conv_id, turn, role, text, letters, faults in zip(*columns, strict=True):
            if kind == 2:
                talk.row(turn, role, text)
            elif kind == 1:
                talk.edit(letters, faults)
            else:
                if talk is not None:
                    done.append(talk.result())
                talk = _Talk(conv_id)
        if done:
            yield made(done)
    if talk is not None:
        yield made([talk.result()])


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each id in ``conversations``, with the faults, edits and repaired hash of its ``rows``.

    ``rows`` are ``conv_id, turn, role, text``, the last two without NULLs. Rows without conv_id are one
    conversation; rows without turn come first in theirs; rows with one turn are ordered by role, then by a
    digest of role and text; of equal rows the first may stay, the others are repeats; texts of any length are
    read whole; a conversation without rows has zeros, no edits and the hash of no text; no conversations
    give no rows; other columns are not read.
    """
    written = stage(_prepared(rows), "repair-rows")
    found = edits(written)
    heads = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    parts = (
        heads.select(_name(F.col("conv_id")).alias("name"), "conv_id", F.lit(0).alias("kind")),
        found.withColumn("kind", F.lit(1)),
        written.select("name", *ORDER, "text", F.lit(2).alias("kind")),
    )
    together = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    head = (F.col("kind") > 0).alias("after")
    order = [head, *[F.col(c).asc_nulls_first() for c in ORDER], F.col("kind")]
    dealt = together.repartition("name").sortWithinPartitions("name", *order)
    return dealt.select("kind", "conv_id", "turn", "role", "text", "letters", "faults").mapInArrow(_stream, RESULT)


def repair_damaged(talks: DataFrame) -> DataFrame:
    """Conversations damaged by :func:`damaged`, repaired; every id of the table keeps its row. See :func:`repair` for the awkward cases."""
    return repair(damaged(talks), talks)
