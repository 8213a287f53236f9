"""What the plans of queries must and must not hold."""

import pytest

from quotelake.plans.catalog import QUERIES
from quotelake.session import refuse_own_disk, shared_dir

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_the_shared_dimension_shuffles_once(spark):
    assert plan(spark, "merge_shared_dim").count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["ent_user_id_dim", "feed_tickers_major_holders"])
def test_aggregates_by_hash(spark, name):
    assert "SortAggregate" not in plan(spark, name)


def test_a_cluster_needs_a_shared_folder(spark):
    assert shared_dir(spark)
    for master, scheme in (("yarn", "hdfs"), ("local[8]", "file"), ("k8s://x", "s3a")):
        refuse_own_disk(master, scheme)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        refuse_own_disk("spark://host:7077", "file")


@pytest.mark.parametrize("name", ["join_as_of", "join_within"])
def test_joins_along_time_are_equality_joins(spark, name):
    text = plan(spark, name)
    assert "Cartesian" not in text and "NestedLoop" not in text and "Join" in text


def test_groupings_share_one_exchange(spark):
    assert plan(spark, "agg_sets").count("Exchange hashpartitioning") == 1
