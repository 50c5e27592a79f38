"""Faults, cheapest edits and repaired texts against a plain model."""

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from jatoba.llm import repair

TALKS = "conv_id long, turn long, role string, text string"
DUE, NEXT = ["user", "user", "assistant", "user"], [2, 2, 3, 2]


def cheapest(symbols):
    """The edits of the whole conversation by suffixes: (cost, letters) from each state."""

    def with_inserts(best):
        for _ in range(4):
            best = [min(best[q], (5 + best[NEXT[q]][0], "I" + best[NEXT[q]][1])) for q in range(4)]
        return best

    never = (10**9, "")
    best = with_inserts([(0, ""), never, never, (0, "")])
    for role, fault in reversed(symbols):
        new = []
        for q in range(4):
            ways = [(2 + best[q][0], "D" + best[q][1])]
            if fault not in "bd":
                more = 5 if fault == "t" else 0
                to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role, q))
                if to is not None:
                    ways.append((more + best[to][0], "K" + best[to][1]))
                ways.append((1 + more + best[NEXT[q]][0], "R" + best[NEXT[q]][1]))
            new.append(min(ways))
        best = with_inserts(new)
    return best[0]


def model(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        for _ in range(0 if kind == 0 else 2 if kind == 3 else 1):
            talks[conv].append((turn, "user" if kind == 4 else role, text))
    out = []
    for conv, found in talks.items():
        digest = lambda r: sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r)))
        seen, faults = set(), ""
        for _, role, text in found:
            shown = text.strip(" \t\n\x0b\x0c\r")
            faults += "b" if not shown else "d" if (role, text) in seen else "-" if shown[-1] in ".!?" else "t"
            seen.add((role, text))
        cost, audit = cheapest([(r[1][:1], f) for r, f in zip(found, faults)]) if found else (0, "")
        rows_left, lines, state = iter(found), [], 0
        for letter in audit:
            if letter == "I":
                lines.append(DUE[state] + ":")
            else:
                _, role, text = next(rows_left)
                if letter == "D":
                    continue
                lines.append(f"{DUE[state] if letter == 'R' else role}:{text}")
                if letter == "K" and role[0] == "s":
                    state = 1
                    continue
            state = NEXT[state]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        turns = {t for t, *_ in found if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[1][:1] for r in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((conv, gaps, *(faults.count(x) for x in "bdt"), illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest()))
    return out


def agree(spark, rows, parts=4):
    frame = spark.createDataFrame(rows, TALKS).withColumns({c: F.lit("x") for c in ("name", "row", "kind", "digest", "letters", "id")})
    got = [tuple(r) for r in repair.repair_damaged(frame.repartition(parts)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, model(rows)))


def text(rng):
    return rng.choice(["", " ", "same.", "open", "é!", "no end . x", "x?\n", None, "a\tb.", f"t{rng.randint(0, 9)}.", f"t{rng.random()}."])


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "ürgh", "User"]


def test_random_conversations(spark):
    rng = random.Random(4)
    rows = []
    for conv in [*range(300), None]:
        for turn in range(rng.randint(1, 12)):
            rows.append((conv, rng.choice([turn, turn, turn, turn * 3, None, 2]), rng.choice(ROLES), text(rng)))
    agree(spark, rows)


def test_sound_conversations_of_any_length_and_long_texts(spark):
    rows = [(c, t, "system" if c % 3 == 0 and t == 0 else ("user", "assistant")[(t - (c % 3 == 0)) % 2], f"Turn {c} {t}.") for c in range(60) for t in range(c)]
    rows += [(99, 0, "user", "long " * 200_000 + "."), (99, 1, "assistant", "x" * 1_000_000)]
    agree(spark, rows)


@pytest.mark.parametrize("conv", [7, None])
def test_a_conversation_of_many_blocks(spark, conv):
    rng = random.Random(6)
    rows = [(conv, t, rng.choice(ROLES[:5]), f"t{t}{rng.choice('.!? x')}") for t in range(9000)]
    rows += [(c, t, rng.choice(ROLES), text(rng)) for c in range(20) for t in range(5)] + [(conv, 5, "user", "again.")] * 3000
    agree(spark, rows)


def test_no_rows(spark):
    assert repair.repair_damaged(spark.createDataFrame([], TALKS)).collect() == []
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    agree(spark, [(1, gone, "user", "a."), (2, -5, "user", None)])


def test_checkpoints_do_not_change_the_walk():
    rng = random.Random(8)
    for _ in range(300):
        symbols = [rng.randrange(12) for _ in range(rng.randint(0, 40))]
        (letters,), _ = repair.walk(symbols, repair.END, True, (0,))
        faults = ["-", "t", "d"]
        cost, want = cheapest([("sua?"[s % 4], faults[s // 4]) for s in symbols])
        assert letters == want
        vector = repair.END
        for s in reversed(symbols):
            vector = repair.back(s, vector)
        assert vector[0] == cost
        if symbols:
            whole = repair.transfer(__import__("numpy").array(symbols))
            assert (whole + repair.END).min(axis=1).tolist() == vector
