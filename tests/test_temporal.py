"""As-of joins, bursts, and the streams that count posts, against plain Python."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quotelake.operators.temporal import as_of_join, by_hour, sessions
from quotelake.streaming.event_time import Bursts, HourlyPosts, bursts, hour_counts

START = datetime(2024, 3, 1)


def moment(rng, hours, step=60):
    return START + timedelta(seconds=step * rng.randrange(hours * 3600 // step))


@pytest.mark.parametrize("bucket", [None, by_hour, lambda t: F.lit(1)])
def test_as_of(spark, bucket):
    rng = random.Random(7)
    posts = [(i, rng.choice(["HOT", "HOT", "A", "B", None]), rng.choice([None, *[moment(rng, 100)] * 20])) for i in range(300)]
    bars = [(rng.choice(["HOT", "A", "C", None]), rng.choice([None, *[moment(rng, 100)] * 9]), rng.choice([None, 1.0, 2.0, 3.0])) for _ in range(120)]
    bars += bars[:30]
    left = spark.createDataFrame([(*p, "x") for p in posts], "id int, ticker string, ts timestamp_ntz, _bar string").repartition(4)
    right = spark.createDataFrame(bars, "ticker string, at timestamp_ntz, close double").repartition(3)
    options = {} if bucket is None else {"bucket": bucket}
    got = as_of_join(left, right, ["ticker"], "ts", "at", {"bar": "at", "price": "close"}, **options)
    assert got.columns == ["id", "ticker", "ts", "_bar", "bar", "price"]
    expected = {}
    for i, ticker, ts in posts:
        known = [(at, close is not None, close or 0.0) for t, at, close in bars if ticker and t == ticker and at and ts and at <= ts]
        best = max(known, default=(None, False, None))
        expected[i] = (best[0], best[2] if best[1] else None)
    assert {r.id: (r.bar, r.price) for r in got.collect()} == expected
    assert got.count() == len(posts)
    assert as_of_join(left.limit(0), right, ["ticker"], "ts", "at", {"price": "close"}).count() == 0
    assert as_of_join(left, right.limit(0), ["ticker"], "ts", "at", {"price": "close"}).where("price is not null").count() == 0
    with pytest.raises(ValueError, match="share a name"):
        as_of_join(left, right, ["ticker"], "ts", "at", {"Ts": "at"})


def test_as_of_plan(spark):
    left = spark.createDataFrame([(1, "A", START)], "id int, ticker string, ts timestamp_ntz")
    plan = as_of_join(left, left, ["ticker"], "ts", "ts", {"bar": "ts"})._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def brute_sessions(rows, gap):
    held = defaultdict(list)
    for key, ts in rows:
        if ts is not None:
            held[key].append(ts)
    out = Counter()
    for key, times in held.items():
        times.sort()
        begin, n = 0, len(times)
        for i in range(1, n + 1):
            if i == n or times[i] - times[i - 1] > timedelta(seconds=gap):
                out[key, times[begin], times[i - 1], i - begin] += 1
                begin = i
    return out


@pytest.mark.parametrize("gap, step", [(600, 7), (600, 60), (90_000, 3600)])
def test_sessions(spark, gap, step):
    """Bursts over several days, and rows just a gap apart."""
    rng = random.Random(gap)
    rows = [(rng.choice(["HOT"] * 5 + ["A", None]), rng.choice([None, *[moment(rng, 400, step)] * 30])) for _ in range(500)]
    rows += [("B", START + timedelta(seconds=gap * i)) for i in range(4)] + [("C", START + timedelta(seconds=(gap - 1) * i)) for i in range(300)]
    df = spark.createDataFrame(rows, "ticker string, ts timestamp_ntz").repartition(5)
    expected = brute_sessions(rows, gap)
    assert Counter(tuple(r) for r in sessions(df, ["ticker"], "ts", gap).collect()) == expected
    assert Counter(tuple(r) for r in bursts(df, ["ticker"], "ts", gap, "0 seconds").collect()) == expected
    assert sessions(df.limit(0), ["ticker"], "ts", gap).count() == 0


POSTS = "id int, ticker string, ts timestamp_ntz"


def feed(spark, folder, parts, stream):
    """The parts as files, `advance` after each."""
    for part in parts:
        spark.createDataFrame(part, POSTS).coalesce(1).write.mode("append").parquet(folder)
        stream.advance(lambda: spark.readStream.schema(POSTS).parquet(folder))
    return stream.table()


@pytest.mark.parametrize("files", [1, 3, 6])
def test_hours_do_not_depend_on_the_files(spark, tmp_path, files):
    rng = random.Random(9)
    posts = sorted(((i, rng.choice(["HOT", "A"]), moment(rng, 60)) for i in range(200)), key=lambda p: p[2] + timedelta(hours=rng.randrange(5)))
    size = -(-len(posts) // files)
    stream = HourlyPosts(spark, f"{tmp_path}/lake", {"ticker": "string"}, "ts", "6 hours")
    got = feed(spark, f"{tmp_path}/in", [posts[i : i + size] for i in range(0, len(posts), size)], stream)
    whole = hour_counts(spark.createDataFrame(posts, POSTS), ["ticker"], "ts", "6 hours")
    assert sorted(map(tuple, got.collect())) == sorted((*tuple(r), 0) for r in whole.collect())


def test_late_posts_are_counted_apart(spark, tmp_path):
    at = lambda h: START + timedelta(hours=h, minutes=1)
    parts = [
        [(1, "A", at(0)), (2, "A", at(10)), (3, "B", at(1))],
        [(4, "A", at(0)), (5, "A", at(9)), (6, None, at(2)), (7, "A", at(10)), (8, "A", None)],
        [(9, "A", at(0)), (10, "A", at(30))],
        [(11, "A", at(9)), (12, "A", at(29))],
    ]
    stream = HourlyPosts(spark, f"{tmp_path}/lake", {"ticker": "string"}, "ts", "2 hours")
    assert stream.table().count() == 0
    got = {(r.ticker, r.hour.day * 24 + r.hour.hour - 24): (r.n, r.late) for r in feed(spark, f"{tmp_path}/in", parts, stream).collect()}
    assert got == {("A", 0): (1, 2), ("A", 10): (2, 0), ("B", 1): (1, 0), ("A", 9): (1, 1), (None, 2): (0, 1), ("A", 30): (1, 0), ("A", 29): (1, 0)}


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    stream = HourlyPosts(spark, f"{tmp_path}/lake", {"ticker": "string"}, "ts", "1 hour")
    rows = spark.createDataFrame([(1, "A", START), (2, "A", START)], POSTS)
    for _ in range(2):
        stream._arrive(rows, 0)
    assert [r.n for r in stream.arrivals.read(spark).collect()] == [2]


@pytest.mark.parametrize("files", [1, 4])
def test_closed_bursts(spark, tmp_path, files):
    rng = random.Random(11)
    posts = sorted(((i, rng.choice(["HOT", "A", None]), moment(rng, 50)) for i in range(150)), key=lambda p: p[2])
    size = -(-len(posts) // files)
    stream = Bursts(spark, f"{tmp_path}/lake", {"ticker": "string"}, "ts", 1800, "3 hours")
    assert stream.table().count() == 0
    got = feed(spark, f"{tmp_path}/in", [posts[i : i + size] for i in range(0, len(posts), size)], stream)
    mark = posts[-1][2] - timedelta(hours=3)
    closed = {k: n for k, n in brute_sessions([p[1:] for p in posts], 1800).items() if k[2] + timedelta(seconds=1800) <= mark}
    assert Counter(tuple(r) for r in got.collect()) == closed and len(closed) > 20
