"""Frames, tiles, interval joins, groupings, sketches and comparisons of states against plain Python."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quotelake.operators.aggregates import by_sets, merge_sketches, rollup_sets, sketch
from quotelake.operators.joins import join_within
from quotelake.operators.merge import compare_states
from quotelake.operators.windows import framed, tiles

START = datetime(2024, 3, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def bars(spark, n=400):
    rng = random.Random(n)
    data = [(rng.choice(["HOT"] * 8 + ["A", "B", None]), rng.randrange(40), i, float(rng.randrange(9)) if rng.random() < 0.9 else None) for i in range(n)]
    return spark.createDataFrame(data, "ticker string, day int, id int, price double").repartition(5)


@pytest.mark.parametrize("block_rows", [3, 7, 100_000])
def test_frames_equal_whole_windows(spark, block_rows):
    def values(own):
        return {
            "one": F.lag("price").over(own), "three": F.lag("price", 3).over(own), "next": F.lead("id", 2).over(own),
            "total": F.sum("price").over(own.rowsBetween(-3, 0)), "around": F.count("price").over(own.rowsBetween(-1, 2)),
            "later": F.first("id").over(own.rowsBetween(1, 2)),
        }

    df = bars(spark)
    got = framed(df, ["ticker"], ["day", "id"], F.floor(F.col("day") / 7), values, before=3, after=2, block_rows=block_rows)
    whole = df.withColumns(values(Window.partitionBy("ticker").orderBy("day", "id")))
    assert got.columns == whole.columns and rows(got) == rows(whole)
    with pytest.raises(ValueError, match="one border"):
        framed(df, ["ticker"], ["id"], F.lit(1), values, before=5, block_rows=4)


def test_a_hot_ticker_is_cut_into_blocks(spark):
    df = spark.range(1000).select(F.lit("HOT").alias("ticker"), "id")
    seen = framed(df, ["ticker"], ["id"], F.floor(F.col("id") / 100), lambda w: {"held": F.max("_n").over(Window.partitionBy(
        "ticker", "_block")) - F.min("_n").over(Window.partitionBy("ticker", "_block")), "prev": F.lag("id").over(w)}, block_rows=50)
    assert seen.agg(F.max("held")).first()[0] <= 51 and seen.where("prev = id - 1").count() == 999


@pytest.mark.parametrize("count", [1, 4, 7, 1000])
def test_tiles_equal_ntile(spark, count):
    df = bars(spark)
    whole = df.withColumn("tile", F.ntile(count).over(Window.partitionBy("ticker").orderBy("day", "id")))
    assert rows(tiles(df, ["ticker"], ["day", "id"], F.floor(F.col("day") / 7), count)) == rows(whole)


@pytest.mark.parametrize("seconds", [0, 60, 3600])
def test_partners_within_an_interval(spark, seconds):
    rng = random.Random(seconds)
    moments = [None, *[START + timedelta(seconds=30 * rng.randrange(400), microseconds=rng.choice([0, 1])) for _ in range(60)]]
    left = [(i, rng.choice(["HOT", "A", None]), rng.choice(moments)) for i in range(120)]
    right = [(i, rng.choice(["HOT", "B", None]), rng.choice(moments)) for i in range(90)] + [(200, "HOT", datetime(1965, 1, 1))]
    a = spark.createDataFrame(left, "id int, ticker string, ts timestamp_ntz").repartition(3)
    b = spark.createDataFrame(right, "news int, ticker string, at timestamp_ntz").repartition(2)
    got = join_within(a, b, ["ticker"], "ts", "at", seconds)
    near = timedelta(seconds=seconds)
    expected = [(i, t, ts, j, at) for i, t, ts in left for j, u, at in right if t and t == u and ts and at and abs(ts - at) <= near]
    assert rows(got) == sorted(expected, key=str)
    plan = got._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError, match="share a name"):
        join_within(a, a, ["ticker"], "ts", "ts", seconds)


def test_groupings_in_one_pass(spark):
    df = bars(spark).withColumn("half", F.col("day") % 2)
    got = by_sets(df, rollup_sets(["ticker", "half"]), {"n": F.count(F.lit(1)), "low": F.min("price")})
    expected = Counter()
    for r in df.collect():
        for level, key in ((0, (r.ticker, r.half)), (1, (r.ticker, None)), (3, (None, None))):
            expected[(*key, level)] += 1
    assert {(r.ticker, r.half, r.level): r.n for r in got.collect()} == expected
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Expand") == 1


def test_sketches_of_days_merge_to_any_range(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") * 7919 % 5000).alias("user"), F.rand(3).alias("value"))
    stored = sketch(df, ["day"], "user", "value")
    for first, last in ((0, 29), (4, 9)):
        part = df.where(F.col("day").between(first, last))
        got = merge_sketches(stored.where(F.col("day").between(first, last)), [], {"median": 0.5, "high": 0.95}).first()
        users = part.select("user").distinct().count()
        assert got.n == part.count() and abs(got.n_distinct - users) <= 0.05 * users
        assert abs(got["median"] - 0.5) < 0.04 and abs(got["high"] - 0.95) < 0.03


def test_states_are_compared_as_bags(spark):
    schema = "k int, v string"
    old = [(1, "a"), (1, "a"), (2, "b"), (3, None), (None, "x"), (None, None), (5, "same"), (6, "c")]
    new = [(1, "a"), (2, "B"), (3, None), (None, "x"), (None, "y"), (5, "same"), (7, "n"), (7, "n")]
    got = compare_states(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema).select("v", "k"), ["k"])
    assert got.columns == ["change", "side", "times", "k", "v"]
    assert rows(got) == sorted([
        ("changed", "old", 1, 1, "a"), ("changed", "old", 1, 2, "b"), ("changed", "new", 1, 2, "B"), ("changed", "old", 1, None, None),
        ("changed", "new", 1, None, "y"), ("removed", "old", 1, 6, "c"), ("added", "new", 2, 7, "n"),
    ], key=str)
    assert compare_states(spark.createDataFrame(old, schema), spark.createDataFrame(old[::-1], schema), ["k"]).count() == 0
