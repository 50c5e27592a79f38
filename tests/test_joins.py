"""Skew-safe joins against brute force, with one key holding a third of the rows."""

import math

import pytest
from pyspark.sql import functions as F

from jatoba.operators import joins


def collected(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """3,000 rows: a third on 'hot', a third NULL, the rest thin; every row twice."""
    path = str(tmp_path_factory.mktemp("many") / "t")
    key = F.expr("case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else cast(id % 50 as string) end")
    rows = spark.range(1500).select(key.alias("k"), F.col("id").alias("v"))
    rows.union(rows).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def few(spark, tmp_path_factory):
    """Few rows per key, but for '11': that key is hot here and thin among the many."""
    path = str(tmp_path_factory.mktemp("few") / "t")
    rows = [("hot", "h1"), ("hot", "h2"), ("7", "x"), ("8", "y"), ("nobody", "z"), (None, "n"), (None, "n")]
    thick = spark.range(200).select(F.lit("11").alias("f"), F.concat(F.lit("t"), "id").alias("w"))
    spark.createDataFrame(rows, "f string, w string").union(thick).write.parquet(path)
    return spark.read.parquet(path)


def hot_keys(frame, key="k"):
    return joins.find_hot_keys(frame, key, min_rows=100)[key]


def test_hot_keys(spark, many):
    hot = hot_keys(many)
    # share of a third over 8 partitions: 2 * 8 / 3 slices, rounded up to a power of two
    assert {n: sorted(map(str, keys)) for n, keys in hot.slices.items()} == {8: ["None", "hot"]}
    assert not joins.find_hot_keys(many, "k", "v", min_rows=5000)["k"]


@pytest.mark.parametrize("at_once", [1, 128])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_keys_of_odd_frames(spark, monkeypatch, adaptive, at_once):
    monkeypatch.setattr(joins, "MERGE_TASKS", at_once)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        nothing = spark.range(0).select(F.lit("x").alias("k"))
        assert not joins.find_hot_keys(nothing, "k", min_rows=0)["k"]
        nulls = spark.range(100).select(F.lit(None).cast("string").alias("k"), "id")
        hot = joins.find_hot_keys(nulls, "k", "id", min_rows=10)
        assert [k for keys in hot["k"].slices.values() for k in keys] == [None] and not hot["id"]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("at_once", [1, 128])
def test_sketch_error_is_below_the_threshold(spark, monkeypatch, at_once):
    """A key with twice the threshold is found among very many thin keys."""
    monkeypatch.setattr(joins, "MERGE_TASKS", at_once)
    rows = spark.range(2_000_000).select(
        F.when(F.col("id") % 1000 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k")
    )
    hot = joins.find_hot_keys(rows, "k", min_rows=1)["k"]
    assert [k for keys in hot.slices.values() for k in keys] == [-1]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_sides", ["left", "right", "both", "none"])
@pytest.mark.parametrize("swap", [False, True])
def test_sliced_join_equals_plain_join(spark, many, few, how, hot_sides, swap):
    sides = [(many, "k"), (few, "f")]
    (left, a), (right, b) = reversed(sides) if swap else sides
    left_hot = hot_keys(left, a) if hot_sides in ("left", "both") else joins.NO_HOT_KEYS
    right_hot = hot_keys(right, b) if hot_sides in ("right", "both") else joins.NO_HOT_KEYS
    assert bool(left_hot) == (hot_sides in ("left", "both")) and bool(right_hot) == (hot_sides in ("right", "both"))
    plain = left.join(right, F.col(a) == F.col(b), how)
    sliced = joins.sliced_join(
        joins.with_spread(left) if left_hot else left, joins.with_spread(right) if right_hot else right, a, b, how,
        left_hot=left_hot, right_hot=right_hot,
    )
    columns = ("k", "v", "f", "w")
    assert collected(sliced, *columns) == collected(plain, *columns)
    safe = joins.skew_safe_join(left, right, a, b, how, min_hot_rows=100)
    assert safe.columns == plain.columns and collected(safe, *columns) == collected(plain, *columns)


def test_spread_is_the_same_on_every_run(spark, many):
    first, second = (joins.with_spread(many).collect() for _ in range(2))
    assert first == second


@pytest.mark.parametrize("how", ["left", "inner"])
def test_the_short_side_of_a_hot_key_is_hardly_cut(spark, how):
    """A key with 60 rows to one of the other side: the long side is cut, and copied no more."""
    long = spark.createDataFrame([(7 if i % 3 else i % 40, i) for i in range(6000)], "a int, x int")
    short = spark.createDataFrame([(7 if i % 5 == 0 else 100 + i % 7, i) for i in range(300)], "b int, y int")
    hot = (joins.find_hot_keys(long, "a", min_rows=50)["a"], joins.find_hot_keys(short, "b", min_rows=20)["b"])
    before, after = ([h.counts().get(7, 1) for h in pair] for pair in (hot, joins.balanced(*hot)))
    assert before[1] > 1 and math.prod(after) == math.prod(before)
    rows = long.where("a = 7").count(), short.where("b = 7").count()
    copied = [rows[0] * n[1] + rows[1] * n[0] for n in (before, after)]
    assert after[1] == 1 and copied[1] < copied[0] / 2
    plain = long.join(short, F.col("a") == F.col("b"), how)
    sliced = joins.skew_safe_join(long, short, "a", "b", how, min_hot_rows=20)
    assert collected(sliced, "a", "x", "b", "y") == collected(plain, "a", "x", "b", "y")
    back = joins.skew_safe_join(short, long, "b", "a", how, min_hot_rows=20)
    assert collected(back, "b", "y", "a", "x") == collected(short.join(long, F.col("a") == F.col("b"), how), "b", "y", "a", "x")


def test_merge_left_suffixes(spark, many, few):
    left = many.select(F.col("k").alias("key"), F.col("v").alias("value"), "v")
    right = few.select(F.col("f").alias("key"), F.col("w").alias("value"), "w")
    merged = joins.merge_left(left, right, "key", min_hot_rows=100)
    assert merged.columns == ["key", "value_x", "v", "value_y", "w"]
    plain = many.join(few, F.col("k") == F.col("f"), "left").select("k", "v", F.col("v").alias("b"), "w", "w")
    assert collected(merged, "*") == collected(plain, "*")


def test_no_task_gets_a_hot_key_whole(spark, many, few):
    hot = hot_keys(many)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sliced = joins.sliced_join(
            joins.with_spread(many), joins.with_spread(few), "k", "f", left_hot=hot, right_hot=hot_keys(few, "f")
        )
        loads = [r["n"] for r in sliced.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        plain = many.join(few, F.col("k") == F.col("f"), "left")
        whole = [r["n"] for r in plain.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(whole) >= 2000 and sum(loads) == sum(whole) == 4000 + 20 * 199
    assert max(loads) < max(whole) * 0.5


@pytest.mark.parametrize("limit", [1 << 20, 0])
@pytest.mark.parametrize("scan", [True, False])
def test_lookup_left_join(spark, many, few, limit, scan):
    joined = joins.lookup_left_join(
        many, few, "k", "f", rows_scan=scan, lookup_scan=scan, broadcast_bytes=limit, min_hot_rows=100
    )
    plain = many.join(few, F.col("k") == F.col("f"), "left")
    assert joined.columns == plain.columns
    assert collected(joined, "k", "v", "w") == collected(plain, "k", "v", "w")


def test_broadcast_needs_a_measured_size(spark):
    wide = spark.range(10).select(F.lit(1).alias("f"), F.repeat(F.lit("x"), 1000).alias("w"))
    assert joins.is_small(wide, max_bytes=20_000) and not joins.is_small(wide, max_bytes=9_000)
    assert not joins.is_small(wide, max_rows=9)
    assert joins.is_small(wide.where("f = 2"))
    nested = spark.range(10).select(F.array_repeat(F.lit("abcdefgh"), 100).alias("a"))
    assert joins.is_small(nested, max_bytes=20_000) and not joins.is_small(nested, max_bytes=9_000)


@pytest.mark.parametrize("options, most", [({}, 0), ({"broadcast_rows": 10}, 0.05), ({"broadcast_rows": 10, "bloom_bits": 512}, 1)])
def test_semi_reduce_keeps_the_wanted_and_few_others(spark, options, most):
    rows = spark.range(20_000).selectExpr("if(id % 10 = 0, null, concat('d', id % 4000)) k", "id")
    wanted = spark.range(0, 4000, 8).selectExpr("concat('d', id) w").union(spark.sql("select cast(null as string) w"))
    left = joins.semi_reduce(rows, "k", wanted, "w", **options)
    assert left.columns == ["k", "id"]
    kept = {r["id"]: r["k"] for r in left.collect()}
    sure = {r["id"] for r in rows.where("k is not null and cast(substr(k, 2) as int) % 8 = 0").collect()}
    others = len(kept) - len(sure)
    assert sure <= set(kept) and None not in kept.values() and others <= most * 20_000
    assert (others == 0) == (most == 0)


def test_semi_reduce_of_nothing_wanted(spark):
    rows = spark.range(100).selectExpr("cast(id as string) k")
    assert joins.semi_reduce(rows, "k", rows.where("k = 'x'"), "k").count() == 0


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hot", [5, 10**6])
def test_merge_with_null_keys_that_meet(spark, tmp_path, seed, hot):
    """Against a plain merge; NULL is hot on both sides in the sliced runs."""
    import random

    rng = random.Random(seed)
    sides = [[(rng.choice([None, None, "a", "b", "", "-", "=a", f"k{rng.randrange(9)}"]), n) for n in range(size)] for size in (60, 40)]
    frames = []
    for name, rows in zip("xy", sides):
        spark.createDataFrame(rows, "k string, v int").repartition(3).write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
    got = joins.merge_left(*frames, "k", null_keys_meet=True, min_hot_rows=hot)
    assert got.columns == ["k", "v_x", "v_y"]
    expected = []
    for k, v in sides[0]:
        expected += [(k, v, w) for o, w in sides[1] if o == k] or [(k, v, None)]
    assert collected(got, "k", "v_x", "v_y") == sorted(expected, key=str)
    if hot == 5:
        assert "_slice" in got._jdf.queryExecution().analyzed().toString()
