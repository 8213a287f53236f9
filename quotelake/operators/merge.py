"""Unions and the keyed latest-wins merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.keys import same_key
from quotelake.operators.windows import keep_latest, with_group_stats


def union_distinct(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name without repeated rows; columns one side lacks are NULL."""
    return old.unionByName(new, allowMissingColumns=True).distinct()


def union_tagged(parts: dict[object, DataFrame], tag: str) -> DataFrame:
    """UNION ALL by name of sibling feeds, each marked with its name in `tag`."""
    return union_all([df.withColumn(tag, F.lit(name)) for name, df in parts.items()])


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def merge_co_located(existing: DataFrame, latest: DataFrame, keys: list[str]) -> DataFrame:
    """`existing` without the keys of `latest`, and `latest`; both have one row per key.

    Whole keys are joined by plain equality, so two sides that lie dealt by these keys are merged as they
    lie. Keys with a NULL part, which plain equality does not match, are compared apart.
    """

    def whole(df: DataFrame):
        return reduce(lambda a, b: a & b, [df[k].isNotNull() for k in keys])

    kept = existing.where(whole(existing)).join(latest.where(whole(latest)).select(*keys), keys, "left_anti")
    replaced = latest.where(~whole(latest)).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    partial = existing.where(~whole(existing))
    condition = same_key(partial, replaced, [(k, f"_k{i}") for i, k in enumerate(keys)])
    return kept.unionByName(partial.join(replaced, condition, "left_anti")).unionByName(latest)


def merge_latest(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: list[str],
    order_by: tuple[str, ...] | list[str] = (),
    existing_is_keyed: bool = False,
) -> DataFrame:
    """One row per key; rows of `incoming` beat rows of `existing`, and within a
    batch the greatest by `order_by` wins (see `keep_latest`).

    With `existing_is_keyed` the caller promises that `existing` already has one row
    per key, as every stored entity does. Then its rows only need to make way for
    incoming keys: an anti join against the keys of the batch, which Spark runs
    without moving `existing` when those keys fit the broadcast limit, and whose keys
    are unique on both sides when they do not. The keys are those of the latest rows,
    so that both uses of the batch share one shuffle.
    """
    latest = keep_latest(incoming, keys, order_by)
    if existing is None:
        return latest
    if existing_is_keyed:
        replaced = latest.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        condition = same_key(existing, replaced, [(k, f"_k{i}") for i, k in enumerate(keys)])
        return existing.join(replaced, condition, "left_anti").unionByName(latest, allowMissingColumns=True)
    both = existing.withColumn("_batch", F.lit(0)).unionByName(
        incoming.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    return keep_latest(both, keys, ("_batch", *order_by)).drop("_batch")


def compare_states(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """What turns one state of a table into another: `change, side, times` and the columns of the row.

    Rows are compared as bags, NULLs being equal to NULLs: a row that one side has more often is returned
    once, with its `side` (old or new) and how many `times` more. `change` says what happened to its key:
    added, removed, or changed. Both sides are counted together by partial aggregation; nothing is
    joined but the totals of the keys.
    """
    tagged = {"_old": old, "_new": new}
    both = union_all([
        df.select(*old.columns, *[F.lit(int(side == own)).cast("bigint").alias(side) for side in tagged]) for own, df in tagged.items()
    ])
    bag = both.groupBy(*old.columns).agg(*[F.sum(side).alias(side) for side in tagged])
    known = with_group_stats(bag, keys, {"_key_old": F.sum("_old"), "_key_new": F.sum("_new")})
    change = F.when(F.col("_key_old") == 0, "added").when(F.col("_key_new") == 0, "removed").otherwise("changed")
    more = F.col("_new") - F.col("_old")
    return known.where(more != 0).select(
        change.alias("change"), F.when(more > 0, "new").otherwise("old").alias("side"), F.abs(more).alias("times"), *old.columns
    )
