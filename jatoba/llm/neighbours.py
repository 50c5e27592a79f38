"""Approximate nearest neighbours by learned partitions.

On a sample, the graph of nearest neighbours is cut into equally large parts with few edges
between them. A small network learns which parts the neighbours of a vector lie in. Every row
is indexed in the part that is most probable for it; a query goes to its several most probable
parts and is ranked there by exact inner products.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jatoba.llm.vectors import kmeans, matrix, sample, squared_distances, usable

SAMPLE = 8192
PARTS = 16
PROBES = 12
NEIGHBOURS = 16
HIDDEN = 128
BLOCK = 16_384
QUERY_SLICE = 2048
STEP = 256


@dataclass
class Router:
    """One hidden layer from a vector's direction to scores of the parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.maximum(unit @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def ranked(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k rows with the largest inner product for each row, itself excepted."""
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), STEP):
        near = x[a : a + STEP] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        out[a : a + STEP] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 20) -> np.ndarray:
    """Parts of equal capacity: a first guess by centroids, then moves to where most neighbours are."""
    room = -(-len(x) * 21 // (20 * parts))

    def fill(gain: np.ndarray) -> np.ndarray:
        """Give each row the best part that has room, the most decided rows first."""
        part, left = np.full(len(gain), -1), np.full(parts, room)
        order = np.argsort(-gain, axis=1, kind="stable")
        top = np.take_along_axis(gain, order, axis=1)
        for i in np.argsort(top[:, 1] - top[:, 0], kind="stable") if parts > 1 else range(len(gain)):
            for p in order[i]:
                if left[p]:
                    part[i], left[p] = p, left[p] - 1
                    break
        return part

    part = fill(-squared_distances(x, kmeans(x, parts)))
    # Neighbours in either direction count.
    u = np.concatenate([np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()])
    v = np.concatenate([graph.ravel(), np.repeat(np.arange(len(x)), graph.shape[1])])
    best, kept = -1, part
    for _ in range(rounds):
        count = np.zeros((len(x), parts))
        np.add.at(count, (u, part[v]), 1)
        inside = count[np.arange(len(x)), part].sum()
        if inside <= best:
            break
        best, kept = inside, part
        count[np.arange(len(x)), part] += 0.5
        part = fill(count)
    return kept


def fit(x: np.ndarray, parts: int = PARTS, neighbours: int = NEIGHBOURS, epochs: int = 40, seed: int = 7) -> Router:
    rng = np.random.default_rng(seed)
    k = min(neighbours, len(x) - 1)
    parts = max(1, min(parts, len(x) // 8))
    if k < 1 or parts == 1:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    graph = neighbour_graph(x, k)
    part = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), k), part[graph].ravel()), 1 / (2 * k))
    target[np.arange(len(x)), part] += 0.5
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    weights = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 512):
            rows = order[a : a + 512]
            hidden = np.maximum(unit[rows] @ weights[0] + weights[1], 0)
            score = hidden @ weights[2] + weights[3]
            p = np.exp(score - score.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            d = (p - target[rows]) / len(rows)
            back = (d @ weights[2].T) * (hidden > 0)
            step += 1
            for w, m, s, g in zip(weights, first, second, (unit[rows].T @ back, back.sum(0), hidden.T @ d, d.sum(0)), strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                w -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Router(*weights)


def nearest(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, top: int):
    """For each query its ``top`` rows of x by inner product, ties to the smaller id: index of query, id, score."""
    out = []
    repeats = int(np.unique(ids, return_counts=True)[1].max())
    for a in range(0, len(queries), STEP):
        q = queries[a : a + STEP]
        rough = q @ x.T
        rough[query_ids[a : a + STEP][:, None] == ids[None, :]] = -np.inf
        k = min(top * repeats, len(x))
        least = -np.partition(-rough, k - 1, axis=1)[:, k - 1]
        margin = 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
        i, j = np.nonzero((rough >= (least - margin)[:, None]) & np.isfinite(rough))
        score = (q[i] * x[j]).sum(axis=1)
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        if repeats > 1:
            once = np.sort(np.unique(np.stack([i, ids[j]]), axis=1, return_index=True)[1])
            i, j, score = i[once], j[once], score[once]
        nth = np.arange(len(i)) - np.searchsorted(i, i)
        out.append((i[nth < top] + a, ids[j[nth < top]], score[nth < top]))
    return tuple(np.concatenate(v) for v in zip(*out, strict=True))


def search(
    vectors: DataFrame, is_query, top: int = 20, parts: int = PARTS, probes: int = PROBES, sample_size: int = SAMPLE
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` rows with the largest inner product found for each query.

    ``is_query`` is a condition on the columns of ``vectors (vec_id, embedding)``; candidates
    are all rows with another vec_id. Scores are inner products in double precision of the
    vectors as they stand, ties go to the smaller vec_id. Vectors that are NULL, zero or hold
    NULL or non-finite components, and rows without vec_id, take no part; vectors of different
    dimension do not meet; rows that repeat a vec_id are one query and one candidate, with the
    best score of any of them. No rows give no rows; other columns are not read.

    The router is fitted on about ``sample_size`` vectors; every row is indexed. A group holds
    about 16,384 rows of one part and 2,048 queries, however large the part.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.coalesce(is_query, F.lit(False)).alias("query"))
    rows = rows.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    total = rows.count()
    routers = {d: fit(x, parts) for d, x in sample(rows, total, sample_size, "parts").items()}

    def routed(batches):
        for batch in batches:
            dims = np.array(batch.column("embedding").value_lengths())
            asked = np.array(batch.column("query").to_pylist(), bool)
            for d in np.unique(dims):
                here = dims == d
                part = batch.filter(pa.array(here))
                x = matrix(part.column("embedding"))
                ranked = routers[d].ranked(x) if d in routers else np.zeros((len(x), 1), np.int64)
                chosen = ranked[:, :probes]
                row = np.repeat(np.flatnonzero(asked[here]), chosen.shape[1])
                at = np.concatenate([np.arange(len(x)), row])
                yield pa.record_batch(
                    {
                        "dim": pa.array(np.full(len(at), d), pa.int32()),
                        "part": pa.array(np.concatenate([ranked[:, 0], chosen[asked[here]].ravel()]), pa.int32()),
                        "query": pa.array(np.arange(len(at)) >= len(x)),
                        "vec_id": part.column("vec_id").take(pa.array(at)),
                        "embedding": part.column("embedding").take(pa.array(at)),
                    }
                )

    members = rows.mapInArrow(routed, "dim int, part int, query boolean, vec_id long, embedding array<double>")
    place = ["dim", "part"]
    blocks = members.groupBy(*place).agg(
        F.ceil(F.count_if(~F.col("query")) / BLOCK).cast("int").alias("blocks"), F.ceil(F.count_if("query") / QUERY_SLICE).cast("int").alias("slices")
    ).where("blocks > 0 and slices > 0")
    blocks = blocks.select(*[F.col(c).alias(f"_{c}") for c in place], "blocks", "slices")
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    spread = (
        members.join(blocks, [F.col(c) == F.col(f"_{c}") for c in place])
        .withColumn("block", F.explode(F.when(F.col("query"), every("blocks")).otherwise(F.array(own("blocks")))))
        .withColumn("slice", F.explode(F.when(F.col("query"), F.array(own("slices"))).otherwise(every("slices"))))
        .select(*place, "block", "slice", "query", "vec_id", "embedding")
    )

    def ranked(table: pa.Table) -> pa.Table:
        asked = np.array(table.column("query").to_pylist(), bool)
        queries, index = table.filter(pa.array(asked)), table.filter(pa.array(~asked))
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if len(queries) and len(index):
            ids = queries.column("vec_id").to_numpy()
            i, near, score = nearest(matrix(queries.column("embedding")), ids, matrix(index.column("embedding")), index.column("vec_id").to_numpy(), top)
            found = (ids[i], near, score)
        return pa.table({"query_id": pa.array(found[0]), "vec_id": pa.array(found[1]), "score": pa.array(found[2])})

    found = spread.groupBy(*place, "block", "slice").applyInArrow(ranked, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
