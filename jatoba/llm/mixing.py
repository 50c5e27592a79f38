"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key divided by its quality weight. Within a source the keys
order the documents, and a prefix sum of their sizes finds the key at which the token budget
is met. A source whose target exceeds its size first takes complete epochs of all its
documents; the keys select for the rest.

The prefix sum never sorts a source in one task: sizes are summed per slot of the key range
first, and only the documents of the slot in which the budget ends are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jatoba.llm.text import whole_row
from jatoba.operators.joins import is_small

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SLOTS = 1 << 14


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_of(text: Column, size: Column) -> Column:
    """1 for texts whose mean word is three to ten characters long, as prose has it, else 1/4."""
    mean = F.char_length(text) / F.when(size > 0, size)
    return F.when(mean.between(3, 10), F.lit(1.0)).otherwise(F.lit(0.25))


def uniform(doc_id: Column, seed: int) -> Column:
    """A number above 0 and up to 1 from the document's id."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")))).cast("string")
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1) / F.lit(float(1 << 52))


def keyed(docs: DataFrame, seed: int) -> DataFrame:
    """``doc_id, source, _size``, the sampling key ``_key``, its slot ``_slot``, and the whole ``row``."""
    text = F.col("text").cast("string")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size_of(text).alias("_size"), whole_row(docs)
    )
    key = -F.log(uniform(F.col("doc_id"), seed)) / quality_of(F.col("row.text").cast("string"), F.col("_size"))
    return sized.withColumn("_key", key).withColumn(
        "_slot", F.floor((1 - F.exp(-F.col("_key"))) * SLOTS).cast("int")
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``_source, source_size, target`` from one row per source.

    Water filling in closed form: sources in the order in which they reach their cap, each
    capped if the share that is left to it and those after it is more than its cap.
    """
    ranked = sizes.withColumn("_n", F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1)
    weight = F.lit(weights[-1])
    for i, w in enumerate(weights[:-1]):
        weight = F.when(F.col("_n") % len(weights) == i, F.lit(w)).otherwise(weight)
    ranked = ranked.withColumn("_w", weight.cast("long")).withColumn("_cap", most * F.col("source_size"))
    filling = Window.orderBy(F.col("_cap") / F.col("_w"), "_n")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("_w").over(after)
    levelled = ranked.withColumn("_level", level).withColumn("_at", F.row_number().over(filling))
    first_free = F.min(F.when(F.col("_cap") / F.col("_w") > F.col("_level"), F.struct("_at", "_level"))).over(everything)
    return levelled.withColumn("_share", first_free["_level"]).select(
        "_source",
        "source_size",
        F.coalesce(F.least(F.col("_cap").cast("double"), F.col("_share") * F.col("_w")), F.col("_cap").cast("double")).alias("target"),
    )


def plan(narrow: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """What each source takes: ``_source, source_size, target, _epochs, _end_slot, _end``.

    After ``_epochs`` whole passes, documents in slots before ``_end_slot`` are taken once
    more, and in that slot those up to ``_end``, a (key, doc_id) pair. The document on the
    budget's edge is taken if that comes nearer to the target. ``narrow`` is read three times.
    """
    slots = narrow.groupBy(F.col("source").alias("_source"), "_slot").agg(F.sum("_size").alias("_sum")).checkpoint()
    wanted = targets(slots.groupBy("_source").agg(F.sum("_sum").alias("source_size")), weights, most)
    wanted = wanted.withColumn(
        "_epochs", F.coalesce(F.floor(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))), F.lit(0))
    ).withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
    sums = slots.withColumn(
        "_until", F.sum("_sum").over(Window.partitionBy("_source").orderBy("_slot"))
    ).withColumnRenamed("_source", "_of")
    reached = (
        sums.join(wanted, F.col("_of").eqNullSafe(F.col("_source")))
        .where("_until >= _rest and _rest > 0")
        .groupBy("_source")
        .agg(F.min_by(F.struct(F.col("_slot").alias("_end_slot"), (F.col("_until") - F.col("_sum")).alias("_before"), "_rest"), "_slot").alias("_at"))
        .select(F.col("_source").alias("_of"), "_at.*")
    )
    edge = narrow.join(reached, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_slot") == F.col("_end_slot")))
    ties = edge.groupBy("_of", "_key", "doc_id").agg(F.sum("_size").alias("_size"), F.first("_before").alias("_before"), F.first("_rest").alias("_rest"))
    order = Window.partitionBy("_of").orderBy("_key", "doc_id")
    ends = (
        ties.withColumn("_until", F.col("_before") + F.sum("_size").over(order))
        .where("_until - _size / 2 <= _rest")
        .groupBy("_of")
        .agg(F.max(F.struct("_key", "doc_id")).alias("_end"))
        .withColumnRenamed("_of", "_ended")
    )
    return (
        wanted.join(reached.drop("_rest", "_before"), F.col("_source").eqNullSafe(F.col("_of")), "left")
        .join(ends, F.col("_source").eqNullSafe(F.col("_ended")), "left")
        .select("_source", "source_size", "target", "_epochs", F.coalesce("_end_slot", F.lit(-1)).alias("_end_slot"), "_end")
    )


def mix(
    docs: DataFrame, seed: int = 8, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, whole: bool = True
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, times``, and ``row`` with all columns if ``whole``.

    One row per row of ``docs``.
    Size is the number of words (NULL text: 0, taken as often as its key says, at no cost).
    Sources are ordered by code point with NULL, a source of its own, last; they weigh
    ``weights`` in turn and share all words; a target stops at ``most`` times its source's
    words and the excess goes to the others by weight. The draw is a function of doc_id and
    seed, so reruns agree; rows with one doc_id draw alike and are taken together. Sources
    without words have target 0. No rows give no rows.
    """
    narrow = keyed(docs.select("doc_id", "source", "text"), seed).drop("row").checkpoint()
    taken = plan(narrow, weights, most).checkpoint()
    if is_small(taken):
        taken = F.broadcast(taken)
    again = F.when(F.col("_slot") < F.col("_end_slot"), True).when(
        F.col("_slot") == F.col("_end_slot"), F.coalesce(F.struct("_key", "doc_id") <= F.col("_end"), F.lit(False))
    ).otherwise(False)
    times = (F.col("_epochs") + again.cast("long")).cast("int")
    return (keyed(docs, seed) if whole else narrow).join(taken, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", F.col("_size").alias("size"), "source_size", "target",
        (F.col("_size") * times).alias("taken"), times.alias("times"), *(["row"] if whole else []),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents as the mix holds them: each as often as it is taken."""
    taken = mix(docs, **options).where("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size, length(text) AS chars FROM documents
), keyed AS (
  SELECT doc_id, source, size,
    -ln((('0x' || substr(md5('8:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 1) / 4503599627370496.0)
      / CASE WHEN size > 0 AND chars::DOUBLE / size BETWEEN 3 AND 10 THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END AS k
  FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM keyed GROUP BY source
), weighed AS (
  SELECT *, (CASE n % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::BIGINT AS w, 3 * source_size AS cap FROM sources
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(w) OVER (ORDER BY cap::DOUBLE / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level,
    row_number() OVER (ORDER BY cap::DOUBLE / w, n) AS nth FROM weighed
), free AS (
  SELECT level AS share FROM levels WHERE cap::DOUBLE / w > level ORDER BY nth LIMIT 1
), shared AS (
  SELECT levels.*, share FROM levels LEFT JOIN free ON true
), wanted AS (
  SELECT source, source_size, coalesce(least(cap::DOUBLE, share * w), cap::DOUBLE) AS target FROM shared
), planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM wanted
), summed AS (
  SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.k, k.doc_id RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until,
    sum(k.size) OVER (PARTITION BY k.source, k.k, k.doc_id) AS tied
  FROM keyed k JOIN planned p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN rest > 0 AND until - tied / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM summed
"""
