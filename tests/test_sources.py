import json
import os

import pytest
from pyspark.sql import functions as F

from quotelake.operators.ordering import first_n_symbols
from quotelake.schemas import schema
from quotelake.sources import readers, writers
from quotelake.sources.snapshots import LakeTable

SCHEMA = "k bigint, day string, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def replace_by_key(existing, incoming):
    if existing is None:
        return incoming
    return existing.join(incoming.select("k", "day"), ["k", "day"], "left_anti").unionByName(incoming)


def test_universe_keeps_file_order(spark, tmp_path):
    symbols = [f"S{(i * 7919) % 5000:05d}" for i in range(5000)]
    (tmp_path / "u.csv").write_text("Symbol\n" + "\n".join(symbols) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        universe = readers.read_universe(spark, str(tmp_path / "u.csv"))
        assert universe.rdd.getNumPartitions() > 1
        assert [r[0] for r in first_n_symbols(universe, 2000).collect()] == symbols[:2000]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def inferred(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, payload string")
    out = readers.parse_payload(df, "payload")
    return out.dtypes[1:], [tuple(r)[1:] for r in out.orderBy("id").collect()]


def test_inferred_payload_types(spark):
    assert inferred(spark, '{"VOID": 1, "OBJECT": {"VOID": null}}') == (
        [("OBJECT", "struct<VOID:string>"), ("VOID", "bigint")], [((None,), 1)],
    )
    assert inferred(spark, '{"k": 1}', "[1, 2]", "7", None) == ([("k", "bigint")], [(1,), (None,), (None,), (None,)])
    assert inferred(spark, '{"k": 1.5}', '{"k": 2}') == ([("k", "double")], [(1.5,), (2.0,)])
    assert inferred(spark, '{"k": 1}', '{"k": "x"}', '{"k": [true]}') == ([("k", "string")], [("1",), ("x",), ("[true]",)])
    kinds, _ = inferred(spark, '{"a b": [{"c:d": 1.25, "e": {"f": true}}], "n": [[1]]}')
    assert kinds == [("a b", "array<struct<c:d:double,e:struct<f:boolean>>>"), ("n", "array<array<bigint>>")]


def test_inferred_payload_schema_sees_every_row(spark):
    texts = ['{"a": 1}'] * 50 + ['{"b": [{"c": "x"}], "a": null}', "not json", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, payload string")
    out = readers.parse_payload(df, "payload")
    assert out.dtypes == [("id", "int"), ("a", "bigint"), ("b", "array<struct<c:string>>")]
    assert out.where("b is not null").first()["b"][0]["c"] == "x"
    assert out.count() == len(texts)


@pytest.mark.parametrize("batch_rows", ["7", "10000"])
@pytest.mark.parametrize("chars, documents", [(3000, (11, 40)), (1 << 26, (2, 16)), (1, (1000, 1000))])
def test_json_documents_are_cut_by_their_size(spark, tmp_path, batch_rows, chars, documents):
    """Whatever the Arrow batches hold, a document has as many characters as asked for, or one record."""
    data = [(i, "hot" if i % 3 else "cold", f"v{i}") for i in range(1000)]
    df = spark.createDataFrame(data, "k bigint, grp string, v string")
    path = str(tmp_path / "docs")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        writers.write_json_documents(df, path, "grp", ["k"], chars)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    texts = [open(os.path.join(d, f)).read() for d, _, names in os.walk(path) for f in names if f.endswith(".txt")]
    sizes = [len(json.loads(t)) for t in texts]
    assert sum(sizes) == 1000 and documents[0] <= len(sizes) <= documents[1]
    assert all(len(t.strip()) <= chars + 2 or n == 1 for t, n in zip(texts, sizes, strict=True))
    back = readers.read_json_documents(spark, path, df.schema).select(df.columns)
    assert rows(back) == rows(df)


def test_partitioned_write_splits_hot_values(spark, tmp_path):
    df = spark.range(2000).selectExpr("id k", "if(id % 3 = 0, 'a', 'b') part")
    writers.write_partitioned(df, str(tmp_path / "t"), ["part"], ["k"])
    assert sorted(os.listdir(tmp_path / "t"))[-2:] == ["part=a", "part=b"]
    back = spark.read.schema("k bigint, part string").parquet(str(tmp_path / "t"))
    assert rows(back) == rows(df)


def test_snapshot_states(spark, tmp_path):
    table = LakeTable(str(tmp_path / "t"), schema(SCHEMA))
    assert table.read(spark) is None
    assert table.update(spark, frame(spark, [(1, "d1", "a"), (2, "d1", "b")]), replace_by_key) == 2
    first = table.read(spark)
    assert table.update(spark, frame(spark, [(2, "d1", "B"), (3, "d2", "c")]), replace_by_key) == 3
    assert rows(table.read(spark)) == [(1, "d1", "a"), (2, "d1", "B"), (3, "d2", "c")]
    assert rows(first) == [(1, "d1", "a"), (2, "d1", "b")]


def partitioned(path):
    return LakeTable(path, schema(SCHEMA), {"day": lambda: F.col("day")}, ("k",))


def test_update_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    table = partitioned(path)
    table.update(spark, frame(spark, [(1, "2022-12", "a"), (2, "2023-01", "b"), (4, None, "n")]), replace_by_key)
    assert table.update(spark, frame(spark, [(2, "2023-01", "B"), (3, "2023-01", "c")]), replace_by_key) == 2
    (second,) = (d for d in os.listdir(path) if d.startswith("snapshot=2-"))
    assert sorted(d for d in os.listdir(f"{path}/{second}") if "=" in d) == ["day=2023-01"]
    assert rows(table.read(spark)) == rows(
        frame(spark, [(1, "2022-12", "a"), (2, "2023-01", "B"), (3, "2023-01", "c"), (4, None, "n")])
    )
    assert table.read(spark).columns == ["k", "day", "v"]
    table.update(spark, frame(spark, [(5, "", "e")]), replace_by_key)
    assert rows(table.read(spark).where("day is null")) == [(4, None, "n"), (5, None, "e")]
    deleted = table.expire(spark, keep=1)
    assert any("snapshot=1-" in d and "/day=2023-01" in d for d in deleted) and not any("day=2022-12" in d for d in deleted)
    assert table.read(spark).count() == 5


def test_empty_batches(spark, tmp_path):
    for table in (partitioned(f"{tmp_path}/p"), LakeTable(f"{tmp_path}/u", schema(SCHEMA))):
        assert table.update(spark, frame(spark, []), replace_by_key) == 0
        assert rows(table.read(spark)) == []
        assert table.update(spark, frame(spark, [(1, "d1", "a")]), replace_by_key) == 1
        table.update(spark, frame(spark, []), replace_by_key)
        assert rows(table.read(spark)) == [(1, "d1", "a")]


def test_failed_write_leaves_the_old_state(spark, tmp_path):
    table = partitioned(str(tmp_path / "t"))
    table.update(spark, frame(spark, [(1, "d1", "a")]), replace_by_key)
    broken = frame(spark, [(1, "d1", "x")]).withColumn("v", F.raise_error(F.lit("broken row")))
    with pytest.raises(Exception, match="broken row"):
        table.update(spark, broken, replace_by_key)
    assert rows(table.read(spark)) == [(1, "d1", "a")]
    table.update(spark, frame(spark, [(1, "d1", "b")]), replace_by_key)
    assert rows(table.read(spark)) == [(1, "d1", "b")]


def test_an_update_based_on_an_old_state_is_refused(spark, tmp_path):
    table = LakeTable(str(tmp_path / "t"), schema(SCHEMA))
    table.update(spark, frame(spark, [(1, "d1", "a")]), replace_by_key)

    def overtaken(existing, incoming):
        table.update(spark, frame(spark, [(2, "d1", "b")]), replace_by_key)
        return replace_by_key(existing, incoming)

    with pytest.raises(RuntimeError, match="run the update again"):
        table.update(spark, frame(spark, [(3, "d1", "c")]), overtaken)
    assert rows(table.read(spark)) == [(1, "d1", "a"), (2, "d1", "b")]
    table.update(spark, frame(spark, [(3, "d1", "c")]), replace_by_key)
    assert rows(table.read(spark)) == [(1, "d1", "a"), (2, "d1", "b"), (3, "d1", "c")]
    table.expire(spark, keep=1)
    assert table.read(spark).count() == 3


def test_interval_like_partition_values_stay_text(spark, tmp_path):
    table = LakeTable(str(tmp_path / "t"), schema("interval string, v int"), {"interval": lambda: F.col("interval")})
    df = spark.createDataFrame([("1d", 1), ("1h", 2), ("1m", 3)], "interval string, v int")
    table.update(spark, df, lambda old, new: new)
    assert rows(table.read(spark)) == [("1d", 1), ("1h", 2), ("1m", 3)]
