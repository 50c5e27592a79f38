from jatoba.llm import quotes
from tests.llm.frames import with_clashing_columns

MESSAGES = "conv_id long, turn long, role string, text string"


def messages(spark, rows):
    return spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], MESSAGES)


ROWS = [
    (1, 0, "Shall we meet?\nAt noon maybe.\n\nBring the papers."),
    (1, 1, "On Monday A wrote:\n> Shall we MEET?\n> At noon, maybe.\n\nYes, gladly."),
    (1, 2, "> Bring the papers.\n\nWhich ones?"),
    (1, 3, "A wrote:\n>> Bring the papers.\n> Which ones?\nThe blue ones."),
    (1, 4, "Another matter."),
    (1, 5, ">nobody said this\nStrange."),
    (1, 6, "> > Yes, gladly.\n> The blue ones.\nFine."),
    (2, 0, "> Shall we meet?\nQuoted from elsewhere."),
    (2, 1, None),
    (2, 2, ""),
    (None, 0, "> Yes, gladly."),
    (3, None, "Shall we meet?"),
    (4, 0, "twice"),
    (4, 1, "twice"),
    (4, 2, "> twice"),
    (4, 2, "> twice"),
]


def test_parse():
    assert quotes.parse(None) == (None, [], [])
    clean, own, found = quotes.parse("Hi\n\nB wrote:\n> one two\n> three\n>\n>> deeper\n\nmine\n> a b")
    assert clean == "Hi\n\nmine"
    assert [(level, n) for level, _, n in found] == [(1, 3), (1, 2), (1, 1), (2, 1), (1, 2)]
    assert own == [quotes._hash("hi"), quotes._hash("mine")]
    assert quotes.parse("a > b\n-> c")[2] == []


def test_threads(spark):
    found = quotes.in_reply_order(quotes.link(with_clashing_columns(messages(spark, ROWS)).drop("level"))).collect()
    assert len(found) == len(ROWS)
    got = {(r.conv_id, r.turn): (r.parent_turn, r.root_turn, r.level, r.n_linked) for r in found}
    assert got[1, 0] == (None, 0, 0, 0)
    assert got[1, 1] == (0, 0, 1, 3)
    assert got[1, 2] == (0, 0, 1, 1)
    assert got[1, 3] == (2, 0, 2, 2)
    assert got[1, 4] == (None, 4, 0, 0)
    assert got[1, 5] == (None, 5, 0, 0)
    assert got[1, 6] == (3, 0, 3, 2)
    assert got[2, 0][0] is None and got[None, 0] == (None, 0, 0, 0) and got[3, None] == (None, None, 0, 0)
    assert got[4, 2][0] == 0
    first = [(r.turn, r.position) for r in found if r.conv_id == 1 and r.root_turn == 0]
    assert first == [(0, 0), (1, 1), (2, 2), (3, 3), (6, 4)]
    texts = {(r.conv_id, r.turn): r.text for r in found}
    assert texts[1, 1] == "Yes, gladly." and texts[1, 3] == "The blue ones." and texts[2, 1] is None and texts[2, 2] == ""
    assert quotes.link(messages(spark, [])).collect() == []


def test_long_chains_and_a_hot_phrase(spark):
    rows = [(1, 0, "word 0")] + [(1, i, f"> word {i - 1}\nword {i}\nthanks") for i in range(1, 40)]
    rows += [(2, i, f"> thanks\nthanks\nown {i}") for i in range(50)]
    found = {(r.conv_id, r.turn): r for r in quotes.in_reply_order(quotes.link(messages(spark, rows))).collect()}
    assert all((found[1, i].level, found[1, i].root_turn, found[1, i].position) == (i, 0, i) for i in range(40))
    assert all(found[2, i].parent_turn == 0 for i in range(1, 50)) and found[2, 0].parent_turn is None
