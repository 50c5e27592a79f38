"""Merkle manifest of a dataset, proved by octopus multiproofs.

Every row is a leaf. The leaves of a group (a tree) stand in order; eight neighbours at a time
become a node until one is left, the subroot. The subroots, ordered by group, are the leaves of
one more tree, whose last node is the root.

A leaf partition is an aligned block of ``BLOCK`` leaves. It works out which nodes its proofs
need beyond what follows from its own leaves (the octopus: the union over all its proofs,
level by level), fetches these once, derives the shared interior nodes and expands
the proof of each leaf where it stands. A tree of any size is thus cut into blocks, so a group
that holds most rows is no larger a task than others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jatoba.operators.joins import lookup_left_join

FANOUT = 8
BLOCK_LEVELS = 5
BLOCK = FANOUT**BLOCK_LEVELS
"""Leaves of a block: what a task holds at a time, whatever the size of a group."""
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = ""
"""The name of the tree over the subroots."""

NODE = "tree string, n long, level int, idx long, digest string"


def digest_of(texts: list[str]) -> str:
    return sha256("".join(texts).encode()).hexdigest()


def width(n: int, level: int) -> int:
    """Nodes that a tree of ``n`` leaves has at a level."""
    return -(-n // FANOUT**level)


def height(n: int) -> int:
    """The level of the last node."""
    level = 0
    while width(n, level) > 1:
        level += 1
    return level


def run_of(index: int, n: int, level: int) -> range:
    """The neighbours, the node itself included, that become one node."""
    first = index - index % FANOUT
    return range(first, min(first + FANOUT, width(n, level)))


def octopus(places: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The fewest node coordinates from which, with the leaves at ``places``, all their proofs follow."""
    missing, known = [], np.unique(places)
    for level in range(height(n)):
        above = np.unique(known // FANOUT)
        members = (above[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        needed = np.setdiff1d(members[members < width(n, level)], known, assume_unique=True)
        missing += [(level, int(i)) for i in needed]
        known = above
    return missing


def expand(
    leaves: dict[int, str], n: int, fetched: dict[tuple[int, int], str], wanted: list[int]
) -> Iterator[list[tuple[str, str]]]:
    """The proof of each wanted leaf: the siblings to the left and to the right, as text, level by level."""
    sides: list[dict[int, tuple[str, str]]] = []
    known = dict(leaves)
    for level in range(height(n)):
        known.update({i: digest for (at, i), digest in fetched.items() if at == level})
        here, above = {}, {}
        for run in {i // FANOUT for i in known}:
            members = [known.get(i) for i in run_of(run * FANOUT, n, level)]
            if None in members:
                continue
            above[run] = digest_of(members)
            for k in range(len(members)):
                here[run * FANOUT + k] = "".join(members[:k]), "".join(members[k + 1 :])
        sides.append(here)
        known = above
    for place in wanted:
        yield [sides[level][place // FANOUT**level] for level in range(len(sides))]


def fold(leaf: str, proof: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in proof:
        leaf = sha256(f"{left}{leaf}{right}".encode()).hexdigest()
    return leaf


def leaf_digest(fields: list[Column]) -> Column:
    """``H`` of the fields, each ``-`` if NULL, else its UTF-8 length, a colon and its value."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def tree_name(group: Column) -> Column:
    """A text that orders as the groups do, NULL first and the others bytewise; it is never TOP."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def in_order(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` of many trees with ``n``, the leaves of the tree, and ``idx``, the place in it from 0.

    ``rows`` should be cheap to read: the bounds of the ranges are sampled from it first. The
    rows are dealt out by range of (tree, order, position in the files), so no range is hot, not
    even of equal rows. What is counted in one place is a row per range and tree.
    """
    keys = ["tree", *order, "_spread"]
    placed = (
        rows.withColumn("_spread", F.monotonically_increasing_id())
        .repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys])
        .sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys])
        .drop("_spread")
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_range", F.concat(F.shiftright("_id", 33).cast("string"), F.lit(":"), "tree"))
        .checkpoint()
    )
    ranges = placed.groupBy("tree", "_range").agg(F.count("*").alias("rows"), F.min("_id").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(tree.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select(
        F.col("_range").alias("_of"), F.sum("rows").over(tree).alias("n"), (F.col("first") - before).alias("_shift")
    )
    joined = lookup_left_join(placed, ranges, "_range", "_of", lookup_scan=False)
    return joined.withColumn("idx", F.col("_id") - F.col("_shift")).drop("_id", "_range", "_of", "_shift")


def _grow(table: pa.Table) -> pa.Table:
    """The nodes over one block of nodes, as far up as they follow from it alone."""
    table = table.sort_by("idx")
    tree, n, level, first = (table.column(c)[0].as_py() for c in ("tree", "n", "level", "idx"))
    digests, rows = table.column("digest").to_pylist(), []
    for step in range(1, BLOCK_LEVELS + 1):
        if width(n, level + step - 1) == 1:
            break
        digests = [digest_of(digests[k : k + FANOUT]) for k in range(0, len(digests), FANOUT)]
        start = first // FANOUT**step
        rows += [(tree, n, level + step, start + k, digest) for k, digest in enumerate(digests)]
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string())
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["tree", "n", "level", "idx", "digest"])


def build(leaves: DataFrame) -> DataFrame:
    """All nodes above the leaves (``tree, n, idx, digest``), a few levels a round: one round per factor of BLOCK in the largest tree."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes, base = [], leaves.select("tree", "n", F.lit(0).alias("level"), "idx", "digest")
    for level in range(0, max(1, height(most)), BLOCK_LEVELS):
        grown = base.groupBy("tree", F.floor(F.col("idx") / BLOCK).alias("block")).applyInArrow(_grow, NODE).checkpoint()
        nodes.append(grown)
        base = grown.where(F.col("level") == level + BLOCK_LEVELS)
    return reduce(DataFrame.unionAll, nodes)


def last_nodes(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """The subroot of each tree; a lone leaf is its own."""
    single = leaves.where("n = 1").select("tree", "digest")
    return single.unionAll(nodes.where(F.col("n") <= F.pow(F.lit(float(FANOUT)), "level")).select("tree", "digest"))


def _missing(table: pa.Table) -> pa.Table:
    """What a block lacks: one row, with the coordinates."""
    tree, n, block = (table.column(c)[0].as_py() for c in ("tree", "n", "block"))
    found = octopus(table.column("idx").to_numpy(), n)
    wanted = [f"{level}/{idx}/{tree}" for level, idx in found]
    return pa.table(
        [pa.array([tree]), pa.array([block], pa.int64()), pa.array([wanted], pa.list_(pa.string()))], ["tree", "block", "wanted"]
    )


def fetch(wanted: DataFrame, leaves: DataFrame, nodes: DataFrame, whole: bool) -> DataFrame:
    """``tree, block, nodes``: for each block of the wanted leaves the nodes that its proofs need, each asked for once.

    ``whole`` says that ``wanted`` are all leaves; then no leaf is ever asked for.
    """
    blocks = wanted.select("tree", "n", "block", "idx").groupBy("tree", "block").applyInArrow(
        _missing, "tree string, block long, wanted array<string>"
    )
    asked = blocks.select("tree", "block", F.explode_outer("wanted").alias("wanted"))
    at = nodes if whole else nodes.unionByName(leaves.select("tree", "n", F.lit(0).alias("level"), "idx", "digest"))
    lookup = at.select(F.concat_ws("/", "level", "idx", "tree").alias("coordinate"), "level", "idx", "digest")
    found = lookup_left_join(asked, lookup, "wanted", "coordinate", rows_scan=False)
    node = F.when(F.col("digest").isNotNull(), F.struct("level", "idx", "digest"))
    return found.groupBy("tree", "block").agg(F.collect_list(node).alias("nodes"))


def _proofs(table: pa.Table, found: pa.Table) -> Iterator[tuple[int, list[tuple[str, str]]]]:
    """Row number and proof of each leaf of a block."""
    nodes = {(x["level"], x["idx"]): x["digest"] for x in found.column("nodes")[0].as_py()}
    places = table.column("idx").to_pylist()
    leaves = dict(zip(places, table.column("digest").to_pylist(), strict=True))
    return enumerate(expand(leaves, table.column("n")[0].as_py(), nodes, places))


STEP = pa.struct([("left", pa.string()), ("right", pa.string())])


def _steps(table: pa.Table, found: pa.Table) -> pa.Table:
    steps = [[{"left": left, "right": right} for left, right in proof] for _, proof in _proofs(table, found)]
    return pa.table([table.column("name"), pa.array(steps, pa.list_(STEP))], ["name", "steps"])


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (``tree, n, idx, digest`` and what was carried), ``nodes`` above them, ``tops`` (``name, subroot, steps``) and the root."""

    leaves: DataFrame
    nodes: DataFrame
    tops: DataFrame
    root: str | None


def blocked(leaves: DataFrame) -> DataFrame:
    return leaves.withColumn("block", F.floor(F.col("idx") / BLOCK))


def manifest(rows: DataFrame, *order: str) -> Manifest:
    """The trees of ``rows`` (``tree, digest``, the order, more is carried), and the tree over their subroots."""
    leaves = in_order(rows.checkpoint(), *order, "digest")
    nodes = build(leaves)
    subroots = last_nodes(leaves, nodes).select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "digest")
    top = in_order(subroots.checkpoint(), "name")
    above = build(top)
    root = last_nodes(top, above).first()
    top = blocked(top)
    proofs = top.groupBy("tree", "block").cogroup(fetch(top, top, above, whole=True).groupBy("tree", "block")).applyInArrow(
        _steps, "name string, steps array<struct<left string, right string>>"
    )
    tops = proofs.join(subroots.select(F.col("name").alias("_name"), F.col("digest").alias("subroot")), F.col("name") == F.col("_name")).drop("_name")
    return Manifest(leaves, nodes, tops, root["digest"] if root else None)


PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
SIBLINGS = ", siblings array<string>"


def prove(built: Manifest, wanted: DataFrame | None = None, with_siblings: bool = False) -> DataFrame:
    """Proofs of leaves, folded from ``claimed``, the digest that a leaf is said to have (NULL: the one it has).

    ``wanted`` are rows of ``built.leaves``, all of them unless given. Returned are ``doc_id, leaf,
    subroot, root, proof_sha256`` (of the siblings), ``folded_root`` and ``verified``; with
    ``with_siblings`` also the siblings themselves, a text of digests per level.
    """
    leaves = blocked(built.leaves if wanted is None else wanted)
    fetched = fetch(leaves, built.leaves, built.nodes, whole=wanted is None)
    found = lookup_left_join(fetched, built.tops, "tree", "name", rows_scan=False, lookup_scan=False).drop("name")
    root = built.root
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.list_(pa.string())][: 8 if with_siblings else 7]
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "siblings"][: len(kinds)]

    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        top = [(step["left"], step["right"]) for step in found.column("steps")[0].as_py()]
        subroot = found.column("subroot")[0].as_py()
        ids, digests, claims = (table.column(c).to_pylist() for c in ("doc_id", "digest", "claimed"))
        rows = []
        for k, proof in _proofs(table, found):
            proof = proof + top
            siblings = [left + right for left, right in proof]
            folded = fold(claims[k] or digests[k], proof)
            rows.append((ids[k], digests[k], subroot, root, digest_of(siblings), folded, folded == root, siblings)[: len(kinds)])
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return leaves.groupBy("tree", "block").cogroup(found.groupBy("tree", "block")).applyInArrow(
        run, PROOF + (SIBLINGS if with_siblings else "")
    )


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``tree, doc_id, digest, claimed``: the leaf of each document, and of its tampered text where ``tampered`` holds."""
    fields = [F.col(c) for c in FIELDS]
    lowered = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claimed = F.when(tampered, leaf_digest([*fields[:-1], lowered])) if tampered is not None else F.lit(None).cast("string")
    return docs.select(
        tree_name(F.col("lang")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(fields).alias("digest"), claimed.alias("claimed"),
    )


def third_of(key: Column) -> Column:
    """Whether 3 divides the unsigned crc32 of a number in decimals; a NULL has none."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def check_documents(docs: DataFrame, with_siblings: bool = False) -> DataFrame:
    """The manifest of ``docs`` by language, and every document proved against it, a third of them after tampering.

    Where 3 divides ``crc32(doc_id)`` the text's A-Z are lower-cased before its leaf is folded. A NULL
    field is a field of its own, not an empty one; rows without doc_id come first in their language and are not tampered with;
    rows with one doc_id are ordered by digest, and equal rows are leaves of their own; texts of any
    length are hashed whole where they are read, and only digests move; no rows give no rows; other columns are not read.
    """
    return prove(manifest(document_leaves(docs, third_of(F.col("doc_id"))), "doc_id"), with_siblings=with_siblings)


# sha256 is the engine's own; the crc32 is folded bit by bit.
SQL = """
WITH RECURSIVE rows AS (
    SELECT doc_id, coalesce('=' || lang, '-') AS tree, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
               || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
               || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text,
           coalesce(strlen(text) || ':' || text, '-') AS tail
    FROM documents
), leaves AS (
    SELECT doc_id, tree, sha256(head || tail) AS digest,
           sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS lowered,
           coalesce(xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
               lambda c, b: list_reduce(list_prepend(xor(c, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
                   lambda s, z: xor(s >> 1, 3988292384::UBIGINT * (s & 1::UBIGINT)))), 4294967295::UBIGINT) % 3 = 0, false) AS touched
    FROM rows
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n,
           row_number() OVER () AS row FROM leaves
), nodes AS (
    SELECT tree, 0 AS level, idx, n AS width, digest FROM placed
    UNION ALL
    SELECT tree, level + 1, idx // 8, any_value((width + 7) // 8), sha256(string_agg(digest, '' ORDER BY idx))
    FROM nodes WHERE width > 1 GROUP BY tree, level, idx // 8
), subroots AS (
    SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE width = 1
), tops AS (
    SELECT 0 AS level, idx, n AS width, digest FROM subroots
    UNION ALL
    SELECT level + 1, idx // 8, any_value((width + 7) // 8), sha256(string_agg(digest, '' ORDER BY idx))
    FROM tops WHERE width > 1 GROUP BY level, idx // 8
), paths AS (
    SELECT p.row, o.level, m.idx, m.idx = o.idx AS own, m.digest
    FROM placed p JOIN nodes o ON o.tree = p.tree AND o.idx = p.idx // (8 ** o.level)::BIGINT AND o.width > 1
    JOIN nodes m ON m.tree = o.tree AND m.level = o.level AND m.idx // 8 = o.idx // 8
    UNION ALL
    SELECT p.row, 100 + o.level, m.idx, m.idx = o.idx, m.digest
    FROM placed p JOIN subroots s ON s.tree = p.tree JOIN tops o ON o.idx = s.idx // (8 ** o.level)::BIGINT AND o.width > 1
    JOIN tops m ON m.level = o.level AND m.idx // 8 = o.idx // 8
), steps AS (
    SELECT row, row_number() OVER (PARTITION BY row ORDER BY level) AS step, coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx < me), '') AS lefts,
           coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx > me), '') AS rights
    FROM (SELECT *, max(CASE WHEN own THEN idx END) OVER (PARTITION BY row, level) AS me FROM paths) GROUP BY row, level
), folded AS (
    SELECT row, 0 AS done, CASE WHEN touched THEN lowered ELSE digest END AS digest FROM placed
    UNION ALL
    SELECT f.row, done + 1, sha256(lefts || f.digest || rights) FROM folded f JOIN steps s ON s.row = f.row AND s.step = done + 1
), ends AS (SELECT row, arg_max(digest, done) AS folded_root FROM folded GROUP BY row),
proofs AS (SELECT row, sha256(string_agg(lefts || rights, '' ORDER BY step)) AS proof FROM steps GROUP BY row)
SELECT doc_id, p.digest AS leaf, s.digest AS subroot, r.digest AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root,
       folded_root = r.digest AS verified
FROM placed p JOIN subroots s USING (tree) JOIN ends USING (row) LEFT JOIN proofs USING (row)
CROSS JOIN (SELECT digest FROM tops WHERE width = 1) r
"""
