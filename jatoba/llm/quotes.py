"""Reply order from quotations.

Messages are parsed into what their author wrote and what is quoted, at which level. Quoted
passages are normalised and hashed, and joined to the first message of the conversation that
holds the passage as its own text. A message replies to the one from which it quotes most words
at the first level; threads are the trees that this makes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_MARK = re.compile(r"^[ \t]*((?:>[ \t]?)+)(.*)$")
_ATTRIBUTION = re.compile(r"^.*\b(?:wrote|writes|schrieb|a écrit|escribió)[ \t]*:[ \t]*$", re.IGNORECASE)


def normal(passage: str) -> str:
    """Lower case, with one space between runs of letters and digits."""
    return " ".join(re.findall(r"\w+", passage.lower()))


def _hash(text: str) -> str:
    return hashlib.blake2b(text.encode(), digest_size=16).hexdigest()


def parse(text: str | None) -> tuple[str | None, list[str], list[tuple[int, str, int]]]:
    """The text without quotes, the hashes of its own passages, and (level, hash, words) of the quoted ones.

    A passage is a run of lines of one level between blank lines. Own passages are hashed
    whole and by line, quoted ones whole, and by line if there are several. A line that says
    who wrote what follows goes with the quote.
    """
    if text is None:
        return None, [], []
    runs: list[tuple[int, list[str]]] = []
    kept: list[str] = []
    for line in text.split("\n"):
        found = _MARK.match(line)
        level, body = (found[1].count(">"), found[2]) if found else (0, line)
        if level:
            while kept and not kept[-1].strip():
                kept.pop()
            if kept and _ATTRIBUTION.match(kept[-1]):
                said = kept.pop()
                for _, lines in reversed(runs):
                    if said in lines:
                        lines.remove(said)
                        break
        else:
            kept.append(line)
        if not body.strip() or not runs or runs[-1][0] != level or not runs[-1][1]:
            runs.append((level, [body] if body.strip() else []))
        else:
            runs[-1][1].append(body)
    own: dict[str, None] = {}
    quotes: list[tuple[int, str, int]] = []
    for level, lines in runs:
        units = [normal(" ".join(lines))] + ([normal(x) for x in lines] if len(lines) > 1 else [])
        for unit in filter(None, units):
            if level:
                quotes.append((level, _hash(unit), len(unit.split())))
            else:
                own[_hash(unit)] = None
    return "\n".join(kept).strip("\n"), list(own), quotes


def link(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, n_quotes, n_linked, parent_turn, root_turn, level`` of ``messages (conv_id, turn, role, text)``.

    One row per row of messages, without quotes in ``text``; sorted by conversation, root and
    turn they are in reply order, since a reply comes after what it quotes. A quoted passage
    belongs to the earliest message of the conversation that holds it, if that is earlier than
    the quoting one; ties between originals go to the later. Messages that quote nothing known
    are roots (their own ``root_turn``, level 0). NULL texts stay NULL; rows without conv_id or
    turn neither quote nor are quoted; rows that repeat a turn are quoted as one message and
    quote as one; no rows give no rows; other columns are not read.

    Passages are joined to one message each, the first of its hash, so a phrase that everybody
    writes makes no pairs; hashes are aggregated before they are shuffled, and hot ones are
    split by AQE's skew join. Roots are found by doubling the distance that a pointer spans.
    """
    rows = messages.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.string()), ("words", pa.int32())]))
        for batch in batches:
            clean, own, quotes = [], [], []
            for text in batch.column("text").to_pylist():
                c, o, q = parse(text)
                clean.append(c)
                own.append(o)
                quotes.append([{"level": a, "hash": b, "words": n} for a, b, n in q])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), batch.column("role"), pa.array(clean, pa.string()), pa.array(own, pa.list_(pa.string())), pa.array(quotes, kind)],
                ["conv_id", "turn", "role", "text", "own", "quotes"],
            )

    parsed = rows.mapInArrow(
        run, "conv_id long, turn long, role string, text string, own array<string>, quotes array<struct<level:int,hash:string,words:int>>"
    )
    known = parsed.where("conv_id is not null and turn is not null")
    originals = (
        known.select("conv_id", "turn", F.explode("own").alias("hash"))
        .groupBy(F.col("conv_id").alias("o_conv"), F.col("hash").alias("o_hash"))
        .agg(F.min("turn").alias("o_turn"))
    )
    quoted = known.select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.*")
    linked = (
        quoted.join(originals, (F.col("conv_id") == F.col("o_conv")) & (F.col("hash") == F.col("o_hash")) & (F.col("o_turn") < F.col("turn")))
        .groupBy("conv_id", "turn", "o_turn")
        .agg(F.count("*").alias("passages"), F.sum(F.when(F.col("level") == 1, F.col("words")).otherwise(0)).alias("words"))
    )
    parents = (
        linked.groupBy("conv_id", "turn")
        .agg(F.sum("passages").alias("n_linked"), F.max(F.struct("words", "o_turn")).alias("best"))
        .select("conv_id", "turn", "n_linked", F.when(F.col("best.words") > 0, F.col("best.o_turn")).alias("parent_turn"))
        .checkpoint()
    )
    joined = parsed.join(
        parents.join(roots(parents), ["conv_id", "turn"], "left").select(
            F.col("conv_id").alias("p_conv"), F.col("turn").alias("p_turn"), "n_linked", "parent_turn", "root_turn", "level"
        ),
        (F.col("conv_id") == F.col("p_conv")) & (F.col("turn") == F.col("p_turn")),
        "left",
    )
    return joined.select(
        "conv_id", "turn", "role", "text", F.size("quotes").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("level", F.lit(0)).cast("long").alias("level"),
    )


def roots(parents: DataFrame) -> DataFrame:
    """``conv_id, turn, root_turn, level`` of the messages that have a parent."""
    jumps = parents.where("parent_turn is not null").select("conv_id", "turn", F.col("parent_turn").alias("up"), F.lit(1).cast("long").alias("steps"))
    jumps = jumps.checkpoint()
    while True:
        above = jumps.select(F.col("conv_id").alias("a_conv"), F.col("turn").alias("a_turn"), F.col("up").alias("a_up"), F.col("steps").alias("a_steps"))
        if not jumps.join(above, (F.col("conv_id") == F.col("a_conv")) & (F.col("up") == F.col("a_turn")), "left_semi").take(1):
            return jumps.select("conv_id", "turn", F.col("up").alias("root_turn"), F.col("steps").alias("level"))
        jumps = (
            jumps.join(above, (F.col("conv_id") == F.col("a_conv")) & (F.col("up") == F.col("a_turn")), "left")
            .select("conv_id", "turn", F.coalesce("a_up", "up").alias("up"), (F.col("steps") + F.coalesce("a_steps", F.lit(0))).alias("steps"))
            .checkpoint()
        )


def in_reply_order(linked: DataFrame) -> DataFrame:
    """The messages sorted by conversation, thread and turn, with ``position``: the place in the thread.

    Messages are counted per stretch of 4,096 turns of a thread before they are numbered
    inside one, so that a long thread is not numbered by one task.
    """
    stretch = F.floor(F.col("turn") / 4096)
    placed = linked.withColumn("_stretch", stretch)
    counts = placed.groupBy("conv_id", "root_turn", "_stretch").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("conv_id", "root_turn").orderBy("_stretch")) - F.col("_n")
    offsets = counts.select(
        F.col("conv_id").alias("_c"), F.col("root_turn").alias("_r"), F.col("_stretch").alias("_s"), before.alias("_before")
    )
    nth = F.row_number().over(Window.partitionBy("conv_id", "root_turn", "_stretch").orderBy("turn", "level", "role", "text"))
    return (
        placed.withColumn("_nth", nth)
        .join(offsets, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("root_turn").eqNullSafe(F.col("_r")) & F.col("_stretch").eqNullSafe(F.col("_s")))
        .withColumn("position", F.col("_before") + F.col("_nth") - 1)
        .drop("_stretch", "_c", "_r", "_s", "_before", "_nth")
        .orderBy("conv_id", "root_turn", "turn", "position")
    )
