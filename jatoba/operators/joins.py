"""Equi joins that hold up when one key owns a large share of the rows.

1. A lookup is measured and broadcast when it is small.
2. Otherwise both sides shuffle on the key, and the hot keys found by
   :func:`find_hot_keys` are cut into slices: a row of a hot key goes to one slice of its
   own side and is copied to all slices of the other side.
3. AQE's skew join splits what lies below the slicing threshold.

The number of slices of a key follows its share of the rows, so the slices of one side
stay within four per shuffle partition plus two per hot key. A key that is hot on both sides keeps
the product of its slices; :func:`balanced` deals them to the sides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

MAX_HOT_KEYS = 2000
"""A key is hot from 1/MAX_HOT_KEYS of the rows on, so there are at most this many."""
TRACKED_KEYS = 20_000
"""Counters of the frequent-items sketch; its error is a fifth of 1/MAX_HOT_KEYS."""
MERGE_TASKS = 128
"""Tasks that merge sketches before the last step."""
MIN_HOT_ROWS = 1_000_000
"""Below this many rows a key is not worth cutting."""
BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_ROWS = 500_000
BLOOM_BITS = 1 << 27
"""Size of the largest key filter, 16 MiB."""
BLOOM_HASHES = 4
WORD = 64
SPREAD = "_spread"


@dataclass(frozen=True)
class HotKeys:
    """Hot keys by number of slices, and about how many rows each has. ``None`` stands for the NULL key."""

    slices: dict[int, list]
    rows: dict = field(default_factory=dict, compare=False)

    @classmethod
    def of(cls, counts: dict, rows: dict | None = None) -> HotKeys:
        """From the number of slices of each key."""
        slices: dict[int, list] = {}
        for key, n in counts.items():
            slices.setdefault(n, []).append(key)
        return cls(slices, rows or {})

    def counts(self) -> dict:
        return {key: n for n, keys in self.slices.items() for key in keys}

    def __bool__(self) -> bool:
        return bool(self.slices)

    def slice_count(self, key: Column, with_null: bool) -> Column:
        count = F.lit(1)
        for n, keys in self.slices.items():
            named = [k for k in keys if k is not None]
            if named:
                count = F.when(key.isin(named), F.lit(n)).otherwise(count)
            if with_null and len(named) < len(keys):
                count = F.when(key.isNull(), F.lit(n)).otherwise(count)
        return count

    def contains(self, key: Column) -> Column:
        named = [k for keys in self.slices.values() for k in keys if k is not None]
        return F.coalesce(key.isin(named), F.lit(False)) if named else F.lit(False)


NO_HOT_KEYS = HotKeys({})


@dataclass(frozen=True)
class Profile:
    """What one pass tells of some columns: hot values, and for each column its values and the length of them as text."""

    hot: dict[str, HotKeys]
    sizes: dict[str, tuple[int, int]]


def find_hot_keys(df: DataFrame, *columns: str, min_rows: int = MIN_HOT_ROWS) -> dict[str, HotKeys]:
    return profile(df, *columns, min_rows=min_rows).hot


def profile(df: DataFrame, *columns: str, min_rows: int = MIN_HOT_ROWS) -> Profile:
    """Frequent values of each column and the number of rows, from one pass with a small sketch per task.

    No shuffle on the key: only sketches move. Those of up to MERGE_TASKS tasks merge at once,
    more in two steps whose fan-in is about the root of the number of tasks. One row with at most MAX_HOT_KEYS values per column
    comes to the driver. The sketch decides how rows are spread, never which rows are kept.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = df.rdd.getNumPartitions()
    text = {c: F.octet_length(F.col(f"`{c}`").cast("string")) for c in columns}
    count = F.struct(
        F.count(F.lit(1)).alias("rows"),
        *[F.struct(F.count(t).alias("n"), F.sum(t).alias("length")).alias(c) for c, t in text.items()],
    )
    sketches = {c: f"approx_top_k_accumulate(`{c}`, {TRACKED_KEYS})" for c in columns}
    top = f"approx_top_k_estimate({{}}, {MAX_HOT_KEYS})"
    # Grouped by a constant, because a combine without grouping fails on an empty partition.
    if tasks <= MERGE_TASKS:
        row = df.groupBy(F.lit("all")).agg(count.alias("_size"), *[F.expr(top.format(s)).alias(c) for c, s in sketches.items()]).first()
    else:
        merges = max(MERGE_TASKS, math.isqrt(tasks))
        merged = df.groupBy((F.spark_partition_id() % merges).alias("_merge")).agg(
            count.alias("_size"), *[F.expr(s).alias(c) for c, s in sketches.items()]
        )
        combined = f"approx_top_k_combine(`{{}}`, {TRACKED_KEYS})"
        row = merged.groupBy(F.lit("all")).agg(
            F.struct(
                F.sum("_size.rows").alias("rows"),
                *[F.struct(F.sum(f"_size.`{c}`.n").alias("n"), F.sum(f"_size.`{c}`.length").alias("length")).alias(c) for c in columns],
            ).alias("_size"),
            *[F.expr(top.format(combined.format(c))).alias(c) for c in columns],
        ).first()
    if row is None:
        return Profile(dict.fromkeys(columns, NO_HOT_KEYS), dict.fromkeys(columns, (0, 0)))
    rows, *found = row["_size"]
    sizes = {c: (n, length or 0) for c, (n, length) in zip(columns, found, strict=True)}
    if rows < min_rows:
        return Profile(dict.fromkeys(columns, NO_HOT_KEYS), sizes)
    threshold = max(min_rows, rows / MAX_HOT_KEYS)
    hot = {}
    for c in columns:
        slices, counts = {}, {}
        for item, count in row[c]:
            if count >= threshold:
                share = 2 * partitions * count / rows
                slices[item] = 2 ** max(1, math.ceil(math.log2(share)))
                counts[item] = count
        hot[c] = HotKeys.of(slices, counts)
    return Profile(hot, sizes)


def with_spread(df: DataFrame) -> DataFrame:
    """Number the rows of a table scan, to spread hot keys evenly even over equal rows.

    Call it on a frame that only scans, filters and projects files. There the number
    depends on the file split alone, so a task that runs again numbers its rows alike.
    """
    return df.withColumn(SPREAD, F.monotonically_increasing_id())


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES, max_rows: int = BROADCAST_ROWS) -> bool:
    """Measure a frame in one pass: its rows, and the length of their values."""
    size = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, ArrayType | MapType | StructType):
            c = F.to_json(F.struct(c))
        elif not isinstance(field.dataType, StringType | BinaryType):
            c = F.lit(" " * 16)
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    rows, length = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return rows <= max_rows and (length or 0) <= max_bytes


def semi_reduce(
    rows: DataFrame,
    key: str,
    wanted: DataFrame,
    wanted_key: str,
    size: tuple[int, int] | None = None,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    broadcast_rows: int = BROADCAST_ROWS,
    bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """``rows`` without most of those whose key is not among the wanted ones, before they are aggregated or shuffled.

    A few wanted keys are broadcast, and then exactly their rows stay. More of them go into a
    Bloom filter, built by an aggregate and read as one value; a few other rows pass it, which
    a join later drops. Of more keys than half the filter's bits nothing would be held back, so all rows stay.
    NULL keys go in any case. ``size`` are the number and the length of the wanted keys, as :func:`profile`
    gives them, measured here if not given; ``wanted`` should be cheap to read.
    """
    keys = wanted.select(F.col(f"`{wanted_key}`").alias("_wanted")).where("_wanted is not null")
    n, length = size or profile(keys, "_wanted").sizes["_wanted"]
    if n <= broadcast_rows and length <= broadcast_bytes:
        return rows.join(F.broadcast(keys), F.col(f"`{key}`") == F.col("_wanted"), "left_semi")
    if 2 * n > bloom_bits:
        return rows.where(F.col(f"`{key}`").isNotNull())
    bits = min(bloom_bits, 1 << max(10, math.ceil(math.log2(16 * n))))
    held = rows.where(F.col(f"`{key}`").isNotNull()).withColumn("_words", bloom_filter(keys, "_wanted", bits).scalar())
    hits = [F.get("_words", (p / WORD).cast("int")).bitwiseAND(_bit(p)) != 0 for p in _bloom_places(F.col(f"`{key}`"), bits)]
    return held.where(reduce(Column.__and__, hits)).drop("_words")


def bloom_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """One row with the words of the filter as an array. Each task sets its bits first; what meets in one place is the filter itself."""
    places = keys.select(F.explode(F.array(*_bloom_places(F.col(key), bits))).alias("place"))
    set_words = places.groupBy((F.col("place") / WORD).cast("bigint").alias("at")).agg(F.bit_or(_bit(F.col("place"))).alias("word"))
    every = keys.sparkSession.range(bits // WORD).select(F.col("id").alias("at"), F.lit(0).cast("bigint").alias("word"))
    whole = every.unionAll(set_words).groupBy("at").agg(F.bit_or("word").alias("word"))
    return whole.agg(F.sort_array(F.collect_list(F.struct("at", "word")))["word"].alias("words"))


def _bloom_places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(BLOOM_HASHES)]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % WORD).cast("int"))


def sliced_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "left",
    *,
    left_hot: HotKeys = NO_HOT_KEYS,
    right_hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Left or inner join with the hot keys of either side cut into slices.

    Column names of the two sides must differ. A side with hot keys must carry the SPREAD
    column; it stays in the result for the left side and goes for the right one.
    """
    a, b = F.col(f"`{left_key}`"), F.col(f"`{right_key}`")
    on = a == b
    if left_hot:
        left = left.withColumn("_slice", _slice(left_hot.slice_count(a, with_null=True)))
        right = right.select("*", _copies(left_hot.slice_count(b, with_null=False)).alias("_slice_copy"))
        on = on & (F.col("_slice") == F.col("_slice_copy"))
    if right_hot:
        left = left.select("*", _copies(right_hot.slice_count(a, with_null=False)).alias("_part_copy"))
        right = right.withColumn("_part", _slice(right_hot.slice_count(b, with_null=True))).drop(SPREAD)
        on = on & (F.col("_part") == F.col("_part_copy"))
    joined = left.join(right, on, how)
    if right_hot and how == "left":
        # A hot key of the right side has rows there by definition, so an unmatched copy of
        # a left row only says that this slice is empty.
        joined = joined.where(~(right_hot.contains(a) & F.col("_part").isNull()))
    return joined.drop("_slice", "_slice_copy", "_part", "_part_copy")


def balanced(left: HotKeys, right: HotKeys) -> tuple[HotKeys, HotKeys]:
    """The same cells for the keys that are hot on both sides, cut so that the fewest rows are copied.

    Each side is copied to all slices of the other. With as many cells as before, the copies are fewest
    if a cell has about as many rows of either side: a side with few rows is then hardly cut at all.
    """
    of_left, of_right = left.counts(), right.counts()
    for key in (of_left.keys() & of_right.keys()) - {None}:
        if key in left.rows and key in right.rows:
            cells = of_left[key] * of_right[key]
            best = round(math.log2(cells * left.rows[key] / right.rows[key]) / 2)
            of_left[key] = min(cells, 2 ** max(0, best))
            of_right[key] = cells // of_left[key]
    cut = ({key: n for key, n in counts.items() if n > 1} for counts in (of_left, of_right))
    return tuple(HotKeys.of(counts, hot.rows) for counts, hot in zip(cut, (left, right), strict=True))


def _slice(count: Column) -> Column:
    return F.pmod(F.col(SPREAD), count).cast("int")


def _copies(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), count - 1))


def skew_safe_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "left",
    *,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Find the hot keys of two table scans and join them in slices."""
    left_hot = find_hot_keys(left, left_key, min_rows=min_hot_rows)[left_key]
    right_hot = find_hot_keys(right, right_key, min_rows=min_hot_rows)[right_key]
    left_hot, right_hot = balanced(left_hot, right_hot)
    joined = sliced_join(
        with_spread(left) if left_hot else left,
        with_spread(right) if right_hot else right,
        left_key,
        right_key,
        how,
        left_hot=left_hot,
        right_hot=right_hot,
    )
    return joined.drop(SPREAD)


def lookup_left_join(
    rows: DataFrame,
    lookup: DataFrame,
    rows_key: str,
    lookup_key: str,
    *,
    rows_scan: bool = True,
    lookup_scan: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Left join to a lookup: broadcast if the lookup measures small, sliced otherwise.

    The second way looks at both sides twice. ``*_scan`` says that a side only reads files;
    what has shuffles behind it is checkpointed, so that it is worked out once.
    """
    if not lookup_scan:
        lookup = lookup.checkpoint()
    if is_small(lookup, broadcast_bytes):
        return rows.join(F.broadcast(lookup), F.col(f"`{rows_key}`") == F.col(f"`{lookup_key}`"), "left")
    if not rows_scan:
        rows = rows.checkpoint()
    return skew_safe_join(rows, lookup.hint("merge"), rows_key, lookup_key, min_hot_rows=min_hot_rows)


def merge_left(left: DataFrame, right: DataFrame, on: str, *, null_keys_meet: bool = False, **options) -> DataFrame:
    """Left join on one column; other columns both sides have get the suffixes _x and _y.

    A NULL key meets nothing, as in SQL, unless ``null_keys_meet``: then NULL is a key like any
    other, which is found and sliced if it is hot on either side. Keys then meet by their text.
    """
    both = (set(left.columns) & set(right.columns)) - {on}

    def renamed(df: DataFrame, suffix: str, key: str) -> DataFrame:
        columns = [F.col(f"`{c}`").alias(key if c == on else f"{c}{suffix}" if c in both else c) for c in df.columns]
        if null_keys_meet:
            text = F.coalesce(F.concat(F.lit("="), F.col(f"`{on}`").cast("string")), F.lit("-"))
            columns.append(text.alias(f"_key{suffix}"))
        return df.select(columns)

    keys = ("_key_x", "_key_y") if null_keys_meet else (on, "_on")
    return skew_safe_join(renamed(left, "_x", on), renamed(right, "_y", "_on"), *keys, **options).drop("_on", "_key_x", "_key_y")
