"""Equal texts against plain grouping."""

import random
from collections import Counter, defaultdict

import pytest

from quotelake.llm import exact_dedup
from quotelake.llm.catalog import ORACLES, QUERIES
from tests.oracle_check import compare, connect


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = Counter()
    for ids in groups.values():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        for n, doc_id in enumerate(ids):
            out[doc_id, ids[-1], len(ids), n == len(ids) - 1] += 1
    return out


def found(df):
    return Counter(tuple(r) for r in exact_dedup.exact_groups(df).select("doc_id", "keep_id", "group_size", "kept").collect())


@pytest.mark.parametrize("parts", [1, 5])
def test_groups_of_equal_texts(spark, parts):
    rng = random.Random(parts)
    long = "x" * 300
    texts = [None, "", " ", "a", "A", "ä", "ä", "a\n", long + "1", long + "2", long + "2", "y" * 200_000, "y" * 200_000]
    rows = [(i, rng.choice(texts)) for i in range(400)]
    rows += [(None, "a"), (None, "only null ids"), (None, "only null ids"), (7, "once"), (900, "twice"), (900, "twice"), (-5, "")]
    rows += [(1000 + i, "hot") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    assert found(df) == expected(rows)


def test_rows_that_stay(spark):
    rows = [(1, "a", "u", 1), (2, "a", "v", 2), (2, "a", "w", 3), (3, "b", "x", 4), (None, None, "y", 5), (4, "", "z", 6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, full string, whole int").repartition(3)
    kept = exact_dedup.drop_exact_copies(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id, r.text, r.full, r.whole) for r in kept.collect())
    assert [g[:2] for g in got] == [(2, "a"), (3, "b"), (4, "")] and got[1:] == [(3, "b", "x", 4), (4, "", "z", 6)]
    assert got[0][2:] in [("v", 2), ("w", 3)]


def test_clashing_columns_and_empty_tables(spark):
    names = ["n_bytes", "full", "head", "word", "bits", "_at", "survives", "body", "row", "keep_id", "_k0", "_key"]
    schema = "doc_id bigint, text string, " + ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame([(1, "a", *names), (2, "a", *names)], schema)
    assert found(df) == Counter({(1, 2, 2, False): 1, (2, 2, 2, True): 1})
    assert [tuple(r) for r in exact_dedup.drop_exact_copies(df).collect()] == [(2, "a", *names)]
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0
    assert exact_dedup.drop_exact_copies(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        exact_dedup.exact_groups(df, {"kept": df.text})


def test_only_survivors_are_read_whole(spark):
    rows = [(i, "z" * i) for i in range(50)] + [(100, "p" * 300 + "a"), (101, "p" * 300 + "b"), (102, "q" * 301)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    content = exact_dedup._content(df, [df.doc_id])
    assert {r.doc_id for r in content.where("full is not null").collect()} == {100, 101}


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op13_exact_dedup"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert compare(spark, connect(folder), folder, QUERIES["op13_exact_dedup"], ORACLES["op13_exact_dedup"]) is None
