"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def prose(rng: random.Random, words: int, alphabet: str = "abcdefghij") -> str:
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 7))) for _ in range(words))


AWKWARD = [
    (900, None), (901, ""), (902, " \t\n\v\f\r "), (903, "one"), (904, "one two"), (905, "!!! 123 ..."),
    (906, "x" * 5000), (907, "é ß ñ — 字 字 字"), (908, "same text here again"), (908, "same text here again"),
    (908, "another text under the id"), (None, "no id at all"), (None, None), (909, "a b\x1c\x85c"),
]
"""NULLs, blanks, one word, no letters, a long word, repeated rows, a repeated id, no id, odd spaces."""


def with_clashing_columns(df):
    """The same rows with columns named like those the operators make."""
    from pyspark.sql import functions as F

    names = ["text_key", "fp", "component_id", "taken", "size", "score", "row", "n", "_size", "_key", "bucket", "ids", "label_pred", "pair", "class", "_doc", "_spans", "_letter", "_text_key", "_id", "_source", "target", "_copy", "_times", "lang_pred", "spans", "query", "part", "turns", "own"]
    return df.withColumns({n: F.lit("clash") for n in names if n not in df.columns})
