"""Joins and groups along time: the value in force at a moment, bursts of rows.

All of them work bucket by bucket (a day by default) and hand what reaches over a border on as one
small row for each key and bucket, so a key with a large share of all rows is spread over as
many tasks as it has buckets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_day(time: Column) -> Column:
    return F.date_trunc("day", time)


def by_hour(time: Column) -> Column:
    return F.date_trunc("hour", time)


def as_of_join(
    rows: DataFrame,
    bars: DataFrame,
    on: list[str],
    time: str,
    bar_time: str,
    values: dict[str, str],
    bucket: Callable[[Column], Column] = by_day,
) -> DataFrame:
    """Every row with values of the last bar of its key at or before its time.

    `values` maps names of the result to columns of `bars` (`bar_time` may be one of them). Of bars
    with the same key and time the greatest by these columns counts. Rows without such a bar, or with
    a NULL key or time, have NULLs; bars with a NULL key or time count for none. Both sides are
    sorted together in buckets of time; a bucket that begins without a bar takes the last one
    of the buckets before it. There is no pair of rows anywhere, and no join by a range.
    """
    clash = {name.lower() for name in values} & {name.lower() for name in rows.columns}
    if clash:
        raise ValueError(f"columns would share a name: {sorted(clash)}")
    keys = [f"_k{i}" for i in range(len(on))]
    named = [F.col(f"`{c}`").alias(k) for c, k in zip(on, keys, strict=True)]
    bar = F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(values.values())])
    known = bars.dropna(subset=[*on, bar_time])
    right = known.select(*named, F.col(f"`{bar_time}`").alias("_t"), F.lit(0).alias("_side"), bar.alias("_bar"))
    left = rows.select(
        *named, F.col(f"`{time}`").alias("_t"), F.lit(1).alias("_side"),
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"),
    )
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_bucket", bucket(F.col("_t")))
    place = [*keys, "_bucket"]
    sofar = Window.partitionBy(*place).orderBy("_t", "_side", "_bar").rowsBetween(Window.unboundedPreceding, 0)
    within = both.withColumn("_own", F.last("_bar", ignorenulls=True).over(sofar)).where("_side = 1")
    # For each bucket the last bar of those before it: one row for each key and bucket.
    ends = both.groupBy(*place).agg(F.max(F.when(F.col("_side") == 0, F.struct("_t", "_bar")))["_bar"].alias("_bar"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*place, F.last("_bar", ignorenulls=True).over(before).alias("_carried"))
    found = within.join(carried.where("_carried is not null"), place, "left").withColumn("_bar", F.coalesce("_own", "_carried"))
    return found.select("_row.*", *[F.col("_bar")[f"v{i}"].alias(name) for i, name in enumerate(values)])


def sessions(
    rows: DataFrame,
    keys: list[str],
    time: str,
    gap_seconds: int,
    bucket: Callable[[Column], Column] = by_day,
) -> DataFrame:
    """`keys, session_start, session_end, n`: bursts of rows of a key in which each follows the one before it
    within the gap or just at its end; `session_end` is the time of the last row. Rows with a NULL time are in none.

    Bursts are found within buckets of time, as Spark's session windows. Those that meet at a border are
    then joined, for which each key has one row for each burst and bucket.
    """
    timed = rows.dropna(subset=[time]).withColumn("_bucket", bucket(F.col(f"`{time}`")))
    window = F.session_window(F.col(f"`{time}`"), f"{gap_seconds} seconds")
    parts = timed.groupBy(window.alias("_window"), "_bucket", *keys).agg(
        F.min(time).alias("session_start"), F.max(time).alias("session_end"), F.count(F.lit(1)).alias("n")
    )
    in_order = Window.partitionBy(*keys).orderBy("session_start")
    reach = F.lag("session_end").over(in_order) + F.make_dt_interval(secs=F.lit(gap_seconds))
    begins = F.when(F.col("session_start") <= reach, 0).otherwise(1)
    numbered = parts.withColumn("_begins", begins).withColumn("_session", F.sum("_begins").over(in_order))
    joined = numbered.groupBy(*keys, "_session").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("n").alias("n")
    )
    return joined.drop("_session")
