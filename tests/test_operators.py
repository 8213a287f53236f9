import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quotelake.operators import aggregates, filters, joins, merge, ordering, projection, quality, reshape, windows
from quotelake.schemas import schema


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- projections ---------------------------------------------------------------


@pytest.mark.parametrize(
    "name, expected",
    [
        ("Total Liab", "total_liab"), ("lastTradeDate", "last_trade_date"), ("BasicShares", "basic_shares"),
        ("Eps Revisions Up Last7Days", "eps_revisions_up_last7days"), ("EPS Estimate", "eps_estimate"),
        ("% Out", "out"), ("symbol", "symbol"),
    ],
)
def test_snake_case(name, expected):
    assert projection.snake_case(name) == expected


def test_names_that_collide_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="share a name"):
        projection.rename(df, {"a": "B"})
    with pytest.raises(ValueError, match="no such columns"):
        projection.rename(df, {"c": "d"})
    assert projection.rename(df, {"a": "A"}).columns == ["A", "b"]


def test_conform_adds_drops_orders_and_casts(spark):
    df = spark.createDataFrame([("1.239", "x", 5)], "m string, extra string, n int")
    out = projection.conform(df, schema("n bigint, gone string, m decimal(20,2)"))
    assert out.dtypes == [("n", "bigint"), ("gone", "string"), ("m", "decimal(20,2)")]
    assert rows(out) == [(5, None, Decimal("1.24"))]


def test_cast_columns_gives_null_for_what_does_not_fit(spark):
    df = spark.createDataFrame([(1.005, 1e30), (float("nan"), -0.125)], "a double, b double")
    out = projection.cast_columns(df, {"a": "decimal(20,2)", "b": "decimal(18,2)"})
    assert rows(out) == sorted([(Decimal("1.01"), None), (None, Decimal("-0.13"))], key=repr)


# -- reshaping -----------------------------------------------------------------


def test_stack_drops_a_ticker_without_values(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [("t1", 1.0, 2.0, nan, nan), ("t2", nan, 3.0, 4.0, None)],
        "ts string, A_Open double, A_Close double, B_B_Open double, B_B_Close double",
    )
    out = reshape.stack_matrix(df, ["ts"], ["Open", "Close"])
    assert out.columns == ["ts", "ticker", "Open", "Close"]
    assert rows(out) == [("t1", "A", 1.0, 2.0), ("t2", "A", None, 3.0), ("t2", "B_B", 4.0, None)]


def test_stack_needs_no_shuffle(spark):
    df = spark.createDataFrame([("t", 1.0, 2.0)], "ts string, A_Open double, B_Open double")
    plan = reshape.stack_matrix(df, ["ts"], ["Open"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_transpose_keeps_listed_metrics_only(spark):
    df = spark.createDataFrame(
        [("A", "cash", 1.0, 2.0), ("A", "other", 9.0, 9.0), ("B", "cash", 3.0, None)],
        "symbol string, metric string, `2021-12-31` double, `2020-12-31` double",
    )
    out = reshape.transpose_statement(df, ["symbol"], "metric", ["cash", "debt"])
    assert out.columns == ["symbol", "date", "cash", "debt"]
    assert rows(out) == [
        ("A", "2020-12-31", 2.0, None), ("A", "2021-12-31", 1.0, None), ("B", "2021-12-31", 3.0, None)
    ]


def test_explode_skips_empty_and_null_and_repeats(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, None)], "id int, tags array<string>")
    assert rows(reshape.explode_array(df, ["id"], "tags", "tag")) == [(1, "a"), (1, "b")]


# -- filters -------------------------------------------------------------------


def test_post_selection(spark):
    posts = spark.createDataFrame(
        [
            (1, "up #MMM and #aos #MMM", "en"), (2, "RT @a: #MMM", "en"), (3, "#MMM", "de"), (4, "MMM", "en"),
            (5, None, "en"), (6, "#MMMX", "en"), (7, "#MMM\u00e4 a#MMM #\u00df", "en"), (8, "(#mmm), #BRK.B.", "en"),
        ],
        "id int, text string, lang string",
    )
    universe = spark.createDataFrame([("MMM",), ("AOS",), ("AOS",), ("SS",), ("BRK.B",), (None,)], "Symbol string")
    picked = filters.select_posts(posts, universe, "text")
    assert rows(picked.select("id", "ticker")) == [(1, "AOS"), (1, "MMM"), (8, "BRK.B"), (8, "MMM")]


def test_nonempty_payload(spark):
    df = spark.createDataFrame([(1, [1], "a"), (2, [], "a"), (3, None, "a"), (4, [1], None)], "id int, p array<int>, l string")
    assert rows(filters.nonempty_payload(df, "p", "l").select("id")) == [(1,)]
    text = spark.createDataFrame([(1, "x"), (2, " "), (3, None)], "id int, p string")
    assert rows(filters.nonempty_payload(text, "p").select("id")) == [(1,)]


# -- joins ---------------------------------------------------------------------


def test_enrich_never_multiplies_rows(spark):
    left = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "k string")
    right = spark.createDataFrame([("A", 1), ("A", 2), (None, 3)], "k string, v int")
    assert rows(joins.enrich(left, right, "k", ["v"])) == sorted([("A", 2), ("A", 2), ("B", None), (None, None)], key=repr)


# -- windows -------------------------------------------------------------------


def hot_rows(spark, n=3000):
    """A third of the rows have one key, some have none."""
    make = random.Random(5)
    data = [
        (i, "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{make.randrange(1500)}", make.randrange(40), make.random())
        for i in range(n)
    ]
    return data, spark.createDataFrame(data, "id int, k string, day int, v double").repartition(8)


def test_group_stats_match_brute_force_on_hot_keys(spark):
    data, df = hot_rows(spark)
    out = windows.with_group_stats(df, ["k"], {"v": F.max("v"), "n": F.count("*")})
    by_key = {}
    for _, k, _, v in data:
        best, n = by_key.get(k, (v, 0))
        by_key[k] = (max(best, v), n + 1)
    assert out.columns == ["id", "k", "day", "v", "n"]
    assert rows(out) == sorted([(i, k, d, *by_key[k]) for i, k, d, _ in data], key=repr)


def test_bucketed_row_numbers_match_brute_force(spark):
    data, df = hot_rows(spark)
    out = windows.number_rows(df, ["k"], ["day", "id"], bucket=F.floor(F.col("day") / 4))
    plain = windows.number_rows(df, ["k"], ["day", "id"])
    expected, seen = [], {}
    for i, k, d, v in sorted(data, key=lambda r: (r[2], r[0])):
        seen[k] = seen.get(k, 0) + 1
        expected.append((i, k, d, v, seen[k]))
    assert rows(out) == rows(plain) == sorted(expected, key=repr)


@pytest.fixture
def shuffled_joins(spark):
    """Every join shuffles, and no partitions are merged afterwards."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100b",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def test_hot_keys_are_spread(spark, shuffled_joins):
    _, df = hot_rows(spark, 6000)
    assert largest_share(df.join(df.select("k").distinct(), "k")) > 0.33
    assert largest_share(windows.with_group_stats(df, ["k"], {"m": F.max("v")})) < 0.3
    assert largest_share(windows.number_rows(df, ["k"], ["day", "id"], bucket=F.col("day"))) < 0.2


def test_sorts_do_not_sample_whole_rows(spark):
    df = spark.createDataFrame([(1, "a long text", "x")], "k int, body string, title string")
    for ordered in (ordering.sort_asc(df, "k"), ordering.sort_desc(df, "k")):
        plan = ordered._jdf.queryExecution().executedPlan().toString()
        exchange = next(line for line in plan.splitlines() if "rangepartitioning" in line)
        assert "k#" in exchange and "body" not in exchange and "title" not in exchange


def test_positions_follow_the_sort(spark):
    data, df = hot_rows(spark)
    out = ordering.with_position(ordering.sort_desc(df.select("day", "id"), "day", "id")).collect()
    expected = sorted(((d, i) for i, _, d, _ in data), reverse=True)
    assert [(r["day"], r["id"]) for r in sorted(out, key=lambda r: r["position"])] == expected
    assert sorted(r["position"] for r in out) == list(range(1, len(data) + 1))


def test_sort_spreads_copies_of_a_row(spark, shuffled_joins):
    copies = spark.range(0, 16000, 1, 16).select(F.lit("same").alias("s"))
    assert largest_share(ordering.sort_asc(copies, "s")) < 0.3


def test_keep_latest_limits_groups_before_the_shuffle(spark):
    _, df = hot_rows(spark)
    plan = windows.keep_latest(df, ["k"], ["day"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# -- merge ---------------------------------------------------------------------

MERGE = "k string, part string, v int, note string"


def batch(spark, data):
    return spark.createDataFrame(data, MERGE)


def random_batch(seed, n=300, keys=60):
    make = random.Random(seed)
    return [
        (make.choice([None, *[f"k{i}" for i in range(keys)]]), make.choice("ab"), make.choice([None, 1, 2, 3]), make.choice("xyz"))
        for _ in range(n)
    ]


def test_newest_batch_wins_and_the_rest_stays(spark):
    old = batch(spark, [("a", "p", 9, "old"), ("b", "p", 1, "old")])
    new = batch(spark, [("a", "p", 1, "new"), ("c", "p", 1, "new")])
    for keyed in (False, True):
        out = merge.merge_latest(old, new, ["k", "part"], ["v"], existing_is_keyed=keyed)
        assert rows(out) == [("a", "p", 1, "new"), ("b", "p", 1, "old"), ("c", "p", 1, "new")]


def test_survivor_does_not_depend_on_order_or_partitions(spark):
    data = random_batch(1)
    shuffled = random.Random(2).sample(data, len(data))
    expected = rows(windows.keep_latest(batch(spark, data).coalesce(1), ["k", "part"], ["v"]))
    assert rows(windows.keep_latest(batch(spark, shuffled).repartition(8), ["k", "part"], ["v"])) == expected
    assert len({r[:2] for r in expected}) == len(expected)


def test_merge_properties(spark):
    keys = ["k", "part"]
    old, new = batch(spark, random_batch(3)), batch(spark, random_batch(4))
    stored = windows.keep_latest(old, keys, ["v"])
    assert rows(merge.merge_latest(None, old, keys, ["v"])) == rows(stored)
    assert rows(merge.merge_latest(stored, old, keys, ["v"])) == rows(stored)
    once = merge.merge_latest(stored, new, keys, ["v"])
    assert rows(once) == rows(merge.merge_latest(stored, new, keys, ["v"], existing_is_keyed=True))
    assert rows(once) == rows(merge.merge_latest(old, new, keys, ["v"]))
    assert rows(merge.merge_latest(once, new, keys, ["v"], existing_is_keyed=True)) == rows(once)


def test_merge_against_brute_force(spark):
    old, new = random_batch(6), random_batch(7)
    best = {}
    for age, data in enumerate((old, new)):
        for k, part, v, note in data:
            rank = (age, v is not None, v or 0, note)
            if (k, part) not in best or rank > best[k, part][0]:
                best[k, part] = (rank, (k, part, v, note))
    out = merge.merge_latest(batch(spark, old), batch(spark, new), ["k", "part"], ["v"])
    assert rows(out) == sorted((r for _, r in best.values()), key=repr)


def test_union_distinct_by_name(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "n int, s string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "s string, n int")
    assert rows(merge.union_distinct(a, b)) == [(1, "x"), (2, "y")]


# -- sorting and aggregates ----------------------------------------------------


def test_sorted_output(spark):
    data, df = hot_rows(spark)
    by_day = [(r["day"], r["id"]) for r in ordering.sort_asc(df.select("day", "id"), "day", "id").collect()]
    assert by_day == sorted(by_day)
    down = [(r["day"], r["id"]) for r in ordering.sort_desc(df.select("day", "id"), "day", "id").collect()]
    assert down == sorted(by_day, reverse=True)
    latest = [(r["day"], r["id"]) for r in ordering.latest_n(df.select("day", "id"), 10, ["day", "id"]).collect()]
    assert latest == sorted(by_day)[-10:]


def test_symbols_in_order(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "position int, Symbol string").repartition(3)
    assert aggregates.join_symbols(df, "Symbol", 2, order_by="position").first()["symbols"] == "a b"
    assert [r[0] for r in ordering.first_n_symbols(df, 2).collect()] == ["a", "b"]


# -- quality -------------------------------------------------------------------


def test_lake_report_and_checks(spark):
    good = spark.createDataFrame([(1, None), (2, "b")], "k int, s string")
    twice = spark.createDataFrame([(None, "a"), (None, "b"), (2, "b")], "k int, s string")
    empty = good.limit(0)
    report = quality.lake_report({"good": (good, ["k"]), "twice": (twice, ["k"]), "empty": (empty, ["k"])})
    assert rows(report) == [("empty", 0, 0), ("good", 2, 0), ("twice", 3, 1)]
    with pytest.raises(quality.QualityError, match="no entries in: empty"):
        quality.assert_quality(report)
    with pytest.raises(quality.QualityError, match=r"duplicate keys in: twice \(1\)"):
        quality.assert_quality(report.where("table_name <> 'empty'"))
    quality.assert_quality(report.where("table_name = 'good'"))
    with pytest.raises(quality.QualityError, match="no entries in: empty"):
        quality.assert_quality(quality.staging_report({"good": good, "empty": empty}))
