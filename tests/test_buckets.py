"""Tables in buckets: merges against plain ones, what is read, moved and rewritten."""

import random

import pytest
from pyspark.sql import functions as F

from quotelake.operators.merge import merge_co_located, merge_latest
from quotelake.operators.windows import keep_latest
from quotelake.plans.entities import ENTITIES
from quotelake.schemas import schema
from quotelake.sources.buckets import BUCKET, BucketedTable, bucket_of

DDL = "id string, kind int, value double, note string"
KEYS = ["id", "kind"]


def table(path, buckets=8):
    return BucketedTable(str(path), schema(DDL), keys=tuple(KEYS), buckets=buckets)


def update(spark, stored, rows):
    latest = lambda df: keep_latest(df, KEYS, ["value"])
    return stored.update(spark, rows, lambda old, new: merge_co_located(old, new, KEYS), latest)


def batch(spark, rng, n, ids, note):
    rows = [(rng.choice([None, *ids]), rng.choice([None, 1, 2]), float(rng.randrange(50)), note) for _ in range(n)]
    return spark.createDataFrame(rows, DDL).repartition(3)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_updates_equal_plain_merges(spark, tmp_path):
    rng, stored, expected = random.Random(1), table(tmp_path / "t"), None
    for number, (n, ids) in enumerate([(300, range(80)), (40, range(70, 90)), (0, [1]), (5, [3])]):
        rows_in = batch(spark, rng, n, [f"id{i}" for i in ids], f"batch {number}")
        written = update(spark, stored, rows_in)
        expected = merge_latest(expected, rows_in, KEYS, ["value"], existing_is_keyed=True).select("id", "kind", "value", "note")
        expected = spark.createDataFrame(expected.collect(), DDL)
        assert rows(stored.read(spark)) == rows(expected)
        assert written <= expected.count() and (written == 0) == (n == 0)
    assert len(stored.expire(spark, keep=1)) > 0
    assert rows(stored.read(spark)) == rows(expected)


def test_an_update_rewrites_its_buckets_only(spark, tmp_path):
    rng, stored = random.Random(2), table(tmp_path / "t", buckets=16)
    update(spark, stored, batch(spark, rng, 500, [f"id{i}" for i in range(200)], "old"))
    before = {f[1]: f[0] for f in stored._folders(spark, 1)}
    small = spark.createDataFrame([("id3", 1, 99.0, "new"), ("fresh", 2, 1.0, "new")], DDL)
    update(spark, stored, small)
    after = {f[1]: f[0] for f in stored._folders(spark, 2)}
    touched = {f"{BUCKET}={r[0]}" for r in small.select(bucket_of(tuple(KEYS), 16)).collect()}
    assert {f for f in after if after[f] != before.get(f)} == touched
    # The number of buckets is that of the stored table, whatever a later caller asks for.
    assert table(tmp_path / "t", buckets=4).count(spark) == 16
    update(spark, table(tmp_path / "t", buckets=4), small)
    assert {f for f, _ in stored._folders(spark, 3)} and stored.count(spark) == 16


def test_a_key_opens_one_bucket(spark, tmp_path):
    rng, stored = random.Random(3), table(tmp_path / "t", buckets=16)
    update(spark, stored, batch(spark, rng, 400, [f"id{i}" for i in range(200)], "old"))
    everything = stored.read(spark).collect()
    for key in [("id5", 1), ("id5", None), (None, None), ("nobody", 1)]:
        found = stored.find(spark, dict(zip(KEYS, key, strict=True)))
        assert rows(found) == sorted((tuple(r) for r in everything if (r.id, r.kind) == key), key=str)
        assert len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) <= 16
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert f"PartitionFilters: [isnotnull({BUCKET}#" in plan
    with pytest.raises(ValueError, match="a key has the columns"):
        stored.find(spark, {"id": "id5"})


def test_neither_side_of_a_merge_is_moved(spark, tmp_path):
    """Without broadcasts, rows with whole keys meet where they are stored."""
    rng, stored = random.Random(4), table(tmp_path / "t")
    plans = []

    def merge(old, new):
        merged = merge_co_located(old, new, KEYS)
        plans.append(merged._jdf.queryExecution().executedPlan().toString())
        return merged

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for note in ("old", "new"):
            stored.update(spark, batch(spark, rng, 200, [f"id{i}" for i in range(60)], note), merge, lambda df: keep_latest(df, KEYS, ["value"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    first = plans[0][: plans[0].index("LeftAnti", plans[0].index("LeftAnti") + 1)]
    assert "Bucketed: true" in first and "SortMergeJoin" in first and "Exchange" not in first
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_names_that_the_folders_need(tmp_path, spark):
    with pytest.raises(ValueError, match="is taken"):
        BucketedTable("x", schema("bucket int, id int"), keys=("id",))
    with pytest.raises(ValueError, match="no key"):
        BucketedTable("x", schema("id int"))


def test_contracts_are_stored_by_their_expiry(spark):
    symbols = [("MMM230120C00090000", "23-01"), ("BRKB251219P00400000", "25-12"), ("odd", None), ("", None), (None, None)]
    df = spark.createDataFrame(symbols, "contract_symbol string, month string")
    expiry = ENTITIES["tickers_options_fact"].partition_by["expiry"]()
    assert df.where(~F.col("month").eqNullSafe(expiry)).count() == 0
