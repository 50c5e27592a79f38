"""Near-duplicate vectors by product quantisation.

Vectors are scaled to length 1 and put in the inverted list of their nearest coarse centroid;
what remains after the centroid is coded per subspace. Two vectors link at a cosine of t or
more, which is a distance of r = sqrt(2 - 2t) or less. A vector probes every list that may
hold one so near: those whose cell begins within r of it. There, table lookups give the
distance to each code; since a vector lies within its coding error of its code, no vector whose
code is further than r plus that error can link. The others are compared by exact cosine. So
the lists, the codes and the bounds only save work and lose no link.

The lists of a label stand one after the other in blocks of bounded size. A vector is sent once to each
block that holds a list it probes, not to each list; a pair of blocks is compared once, for both sides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from jatoba.llm.graph import components
from jatoba.llm.text import released
from jatoba.llm.vectors import kmeans, matrix, sample, squared_distances, usable
from jatoba.session import checkpointed

LIST_SIZE = 4096
"""Vectors per coarse list that the number of lists aims at."""
MOST_LISTS = 1024
SAMPLE = 16_384
SUBSPACES = 8
CODES = 64
BLOCK = 32_768
"""Vectors of one label that a block holds about; a group is one block, and those of one other that probe it."""
ROUTED = 2048
"""Vectors whose lists are looked for in one go."""
SENT = 1 << 14
"""Rows of a batch that a task sends on."""
STEP = 256
TOLERANCE = 1e-9


@dataclass
class Quantiser:
    """Coarse centroids, and a codebook for each subspace of the residuals."""

    centroids: np.ndarray
    books: list[np.ndarray]

    @property
    def cuts(self) -> np.ndarray:
        return np.linspace(0, self.centroids.shape[1], len(self.books) + 1).astype(int)

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and coding error of each vector."""
        home = squared_distances(unit, self.centroids).argmin(axis=1)
        rest = unit - self.centroids[home]
        codes = np.empty((len(unit), len(self.books)), np.int64)
        error = np.zeros(len(unit))
        for s, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:], strict=True)):
            codes[:, s] = squared_distances(rest[:, a:b], self.books[s]).argmin(axis=1)
            error += ((rest[:, a:b] - self.books[s][codes[:, s]]) ** 2).sum(axis=1)
        return home, codes, np.sqrt(error)

    def probes(self, unit: np.ndarray, radius: float) -> np.ndarray:
        """Which lists may hold a vector within the radius: no bisector parts them by more than it."""
        square = squared_distances(unit, self.centroids)
        apart = np.sqrt(squared_distances(self.centroids, self.centroids))
        home = square.argmin(axis=1)
        beyond = (square - square[np.arange(len(unit)), home][:, None]) / np.maximum(2 * apart[home], 1e-12)
        return beyond <= radius + TOLERANCE

    def tables(self, unit: np.ndarray, of_list: int) -> np.ndarray:
        """Squared distance of each vector's residual to each code, by subspace."""
        rest = unit - self.centroids[of_list]
        return np.stack([squared_distances(rest[:, a:b], book) for a, b, book in zip(self.cuts[:-1], self.cuts[1:], self.books, strict=True)], axis=1)


def quantiser(vectors: np.ndarray, lists: int) -> Quantiser:
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    centroids = kmeans(unit, max(1, min(lists, len(unit) // 8)))
    rest = unit - centroids[squared_distances(unit, centroids).argmin(axis=1)]
    cuts = np.linspace(0, unit.shape[1], min(SUBSPACES, unit.shape[1]) + 1).astype(int)
    return Quantiser(centroids, [kmeans(rest[:, a:b], CODES, seed=s) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))])


def _plain(dimension: int) -> Quantiser:
    """One list and one code, for dimensions that the sample does not hold."""
    return Quantiser(np.zeros((1, dimension)), [np.zeros((1, dimension))])


def linked_pairs(model: Quantiser, of_list: int, x: np.ndarray, y: np.ndarray, threshold: float):
    """Pairs (row of x, row of y) with a cosine of at least ``threshold``, in pieces."""
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    ux, uy = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    rest = uy - model.centroids[of_list]
    codes = np.stack([squared_distances(rest[:, a:b], book).argmin(axis=1) for a, b, book in zip(model.cuts[:-1], model.cuts[1:], model.books, strict=True)], axis=1)
    decoded = np.concatenate([book[codes[:, s]] for s, book in enumerate(model.books)], axis=1)
    reach = (radius + np.linalg.norm(rest - decoded, axis=1) + TOLERANCE) ** 2 + TOLERANCE
    lx, ly = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    for k in range(0, len(x), STEP):
        table = model.tables(ux[k : k + STEP], of_list)
        square = table[:, 0, codes[:, 0]]
        for s in range(1, codes.shape[1]):
            square += table[:, s, codes[:, s]]
        i, j = np.nonzero(square <= reach)
        for p in range(0, len(i), 1 << 16):
            a, b = i[p : p + (1 << 16)] + k, j[p : p + (1 << 16)]
            cosine = (x[a] * y[b]).sum(axis=1) / (lx[a] * ly[b])
            good = cosine >= threshold
            yield a[good], b[good]


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node and smallest node of its component, for the nodes of the links a-b."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new


@dataclass
class Layout:
    """Where the lists of one label and dimension begin if they stand one after the other, cut into blocks."""

    starts: np.ndarray
    size: int

    @property
    def blocks(self) -> int:
        return max(1, -(-int(self.starts[-1]) // self.size))

    def own(self, home: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The block of each vector; those of a list that is cut are spread by a hash."""
        share = (classes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.float64) / (1 << 24)
        place = self.starts[home] + share * (self.starts[home + 1] - self.starts[home])
        return np.minimum(place.astype(np.int64) // self.size, self.blocks - 1)

    def holding(self) -> np.ndarray:
        """Which blocks hold vectors of which list."""
        at = np.arange(self.blocks)
        low, high = self.starts[:-1, None] // self.size, (self.starts[1:, None] - 1) // self.size
        return (low <= at) & (at <= high) & (self.starts[1:] > self.starts[:-1])[:, None]


def placed(model: Quantiser, layout: Layout | None, x: np.ndarray, classes: np.ndarray, radius: float):
    """List and block of some vectors, and the row and block of every block after its own that a vector probes."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    home = squared_distances(unit, model.centroids).argmin(axis=1)
    if layout is None or layout.blocks == 1:
        return home, np.zeros(len(x), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    own = layout.own(home, classes)
    asked = model.probes(unit, radius).astype(np.float32) @ layout.holding().astype(np.float32) > 0
    row, block = np.nonzero(asked & (np.arange(layout.blocks) > own[:, None]))
    return home, own, row, block


def sent(own: np.ndarray, row: np.ndarray, block: np.ndarray, asking: list[np.ndarray]):
    """Pieces of the rows to send: row, block, the block it comes from, and whether it probes. ``asking``: from which blocks a block is probed."""
    count = np.array([len(a) for a in asking])[own]
    mine = np.repeat(np.arange(len(own)), count + 1)
    parts = np.concatenate([np.append(asking[b], b) for b in own.tolist()]) if len(own) else mine
    at, to = np.concatenate([mine, row]), np.concatenate([own[mine], block])
    parts, probe = np.concatenate([parts, own[row]]), np.arange(len(at)) >= len(mine)
    for k in range(0, len(at), SENT):
        yield at[k : k + SENT], to[k : k + SENT], parts[k : k + SENT], probe[k : k + SENT]


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, list_size: int = LIST_SIZE, sample_size: int = SAMPLE) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per row of ``vectors (vec_id, embedding, label)``.

    Vectors of one label and one dimension link at a cosine of ``threshold`` or more, taken in
    double precision. Vectors that are NULL, zero or hold NULL or non-finite components, and
    rows without label or vec_id, link with nothing. Equal vectors of a label are one class:
    they count as links of one another, and meet others once. ``component_id`` is the smallest
    vec_id reachable and ``kept`` marks it; rows that repeat a vec_id count singly. Empty
    tables give no rows; other columns are not read.

    A group compares about 32,768 vectors with as many that probe their lists, however many
    either are, and sends on counts and a spanning star of what it found linked, no pairs.
    """
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    # What is single precision is sent as such; it is compared in double precision.
    kind = "array<float>" if vectors.schema["embedding"].dataType == ArrayType(FloatType()) else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(kind), "label")
    fit = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    classes = checkpointed(
        rows.where(fit)
        .groupBy(F.col("label").cast("string").alias("label"), "embedding")
        .agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"))
        .withColumn("class", F.monotonically_increasing_id())
    )
    place = ["label", F.size("embedding").alias("dim")]
    labels = classes.groupBy(*place).agg(F.count("*").alias("n"))
    total, largest = (x or 0 for x in labels.agg(F.sum("n"), F.max("n")).first())
    lists = max(1, min(MOST_LISTS, math.ceil(largest / list_size)))
    models = {d: quantiser(v, lists) for d, v in sample(classes, total, sample_size, "pq").items()}
    size = BLOCK

    def model_of(dimension: int) -> Quantiser:
        return models.get(dimension) or _plain(dimension)

    def runs(batches):
        """Runs of rows of one label and dimension, with their vectors."""
        for batch in batches:
            key = pc.dictionary_encode(batch.column("label")).indices.to_numpy(zero_copy_only=False).astype(np.int64)
            dims = np.array(batch.column("embedding").value_lengths()).astype(np.int64)
            for code in np.unique(np.stack([key, dims]), axis=1).T:
                at = np.flatnonzero((key == code[0]) & (dims == code[1]))
                for k in range(0, len(at), ROUTED):
                    part = batch.take(pa.array(at[k : k + ROUTED]))
                    yield part, part.column("label")[0].as_py(), int(code[1]), matrix(part.column("embedding")), part.column("class").to_numpy()

    # Of labels of more than a block, at most one for every BLOCK vectors: the size of the lists, then which blocks probe which.
    large = F.broadcast(labels.where(F.col("n") > size).select(F.col("label").alias("_label"), F.col("dim").alias("_dim")))
    cut = classes.join(large, (F.col("label") == F.col("_label")) & (F.size("embedding") == F.col("_dim"))).select("label", "class", "embedding")

    def listed(batches):
        for _, label, dim, x, c in runs(batches):
            home, counts = np.unique(placed(model_of(dim), None, x, c, radius)[0], return_counts=True)
            yield pa.record_batch({"label": pa.array([label] * len(home), pa.string()), "dim": pa.array([dim] * len(home), pa.int32()), "list": pa.array(home), "n": pa.array(counts)})

    layouts: dict[tuple, Layout] = {}
    asking: dict[tuple, list[np.ndarray]] = {}
    if largest > size:
        for r in cut.mapInArrow(listed, "label string, dim int, list long, n long").groupBy("label", "dim", "list").agg(F.sum("n").alias("n")).collect():
            layout = layouts.setdefault((r.label, r.dim), Layout(np.zeros(len(model_of(r.dim).centroids) + 1, np.int64), size))
            layout.starts[r.list + 1] = r.n
        for layout in layouts.values():
            layout.starts = np.cumsum(layout.starts)

        def pairs(batches):
            for _, label, dim, x, c in runs(batches):
                _, own, row, block = placed(model_of(dim), layouts[label, dim], x, c, radius)
                found = np.unique(np.stack([own[row], block]), axis=1)
                n = found.shape[1]
                yield pa.record_batch({"label": pa.array([label] * n, pa.string()), "dim": pa.array([dim] * n, pa.int32()), "part": pa.array(found[0]), "block": pa.array(found[1])})

        probing = cut.mapInArrow(pairs, "label string, dim int, part long, block long").distinct().collect()
        asking = {key: [np.array([r.part for r in probing if (r.label, r.dim, r.block) == (*key, b)], np.int64) for b in range(layout.blocks)] for key, layout in layouts.items()}

    def routed(batches):
        for part, label, dim, x, c in runs(batches):
            home, own, row, block = placed(model_of(dim), layouts.get((label, dim)), x, c, radius)
            for at, to, of, probe in sent(own, row, block, asking.get((label, dim), [np.zeros(0, np.int64)])):
                some = pa.array(at)
                yield pa.record_batch(
                    {
                        "label": part.column("label").take(some), "dim": pa.array(np.full(len(at), dim), pa.int32()), "block": pa.array(to, pa.int32()), "part": pa.array(of, pa.int32()),
                        "probe": pa.array(probe), "list": pa.array(home[at], pa.int32()), "class": part.column("class").take(some), "n": part.column("n").take(some),
                        "embedding": part.column("embedding").take(some),
                    }
                )

    spread = classes.select("label", "class", "n", "embedding").mapInArrow(
        released(routed), f"label string, dim int, block int, part int, probe boolean, list int, class long, n long, embedding {kind}"
    )

    def compared(table: pa.Table) -> pa.Table:
        probe = table.column("probe").to_numpy()
        both = table.column("block")[0] == table.column("part")[0]
        sides = [table.filter(pa.array(m)) for m in (probe, ~probe)]
        if both:
            sides[0] = sides[1]
        found = {"class": [], "links": [], "root": []}
        if all(len(s) for s in sides):
            x, y = (matrix(s.column("embedding")) for s in sides)
            cx, cy = (s.column("class").to_numpy() for s in sides)
            nx, ny = (s.column("n").to_numpy() for s in sides)
            of_list = sides[1].column("list").to_numpy()
            model = model_of(x.shape[1])
            held = np.unique(of_list)
            asked = np.concatenate([model.probes(v / np.linalg.norm(v, axis=1, keepdims=True), radius)[:, held] for v in (x[k : k + ROUTED] for k in range(0, len(x), ROUTED))])
            to_x, to_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
            star_a, star_b = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for k, number in enumerate(held.tolist()):
                at_x, at_y = np.flatnonzero(asked[:, k]), np.flatnonzero(of_list == number)
                if not len(at_x):
                    continue
                for i, j in linked_pairs(model, number, x[at_x], y[at_y], threshold):
                    i, j = at_x[i], at_y[j]
                    other = cx[i] != cy[j]
                    i, j = i[other], j[other]
                    to_x += np.bincount(i, ny[j], len(x)).astype(np.int64)
                    if not both:
                        to_y += np.bincount(j, nx[i], len(y)).astype(np.int64)
                    star_a, star_b = _stars(np.concatenate([star_a, cx[i]]), np.concatenate([star_b, cy[j]]))
            hit_x, hit_y = to_x > 0, to_y > 0
            none = np.zeros(len(star_a), np.int64)
            found = {
                "class": np.concatenate([cx[hit_x], cy[hit_y], star_a]),
                "links": np.concatenate([to_x[hit_x], to_y[hit_y], none]),
                "root": np.concatenate([cx[hit_x], cy[hit_y], star_b]),
            }
        return pa.table({k: pa.array(v, pa.int64()) for k, v in found.items()})

    found = checkpointed(spread.groupBy("label", "dim", "block", "part").applyInArrow(compared, "class long, links long, root long"))
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    linked = components(found.where("class <> root").select(F.col("class").alias("a"), F.col("root").alias("b")))
    nodes = linked.select("node", "component").union(linked.select("component", "component").distinct())
    ids = classes.select("class", "vec_id")
    roots = nodes.join(ids, F.col("node") == F.col("class")).groupBy("component").agg(F.min("vec_id").alias("root"))
    named = nodes.join(roots, "component").select(F.col("node").alias("class"), "root")
    result = (
        classes.join(counts, "class", "left")
        .join(named, "class", "left")
        .select(
            F.col("label").alias("_label"), F.col("embedding").alias("_embedding"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "vec_id").alias("root"),
        )
    )
    joined = rows.withColumn("_fit", fit).join(
        result, F.col("_fit") & (F.col("label").cast("string") == F.col("_label")) & (F.col("embedding") == F.col("_embedding")), "left"
    )
    component = F.coalesce("root", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
