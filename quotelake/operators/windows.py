"""Per-key numbering, latest row per key, per-key statistics on every row.

Each of them copes with a key that holds a large share of all rows: such a key is
cut down before the shuffle or split over tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quotelake.functions.keys import same_key

def number_rows(
    df: DataFrame,
    keys: list[str],
    order_by: list[str | Column],
    bucket: Column | None = None,
    name: str = "row_number",
) -> DataFrame:
    """`row_number` within each key, ascending.

    `bucket` is a coarse, order-preserving function of the first order column (the
    hour of a timestamp, say). With it the rows of one key are numbered bucket by
    bucket in separate tasks and shifted by the number of rows in earlier buckets,
    so a hot key does not end up in one task. Without it all rows of a key are
    numbered by one task, which suits keys of a bounded size only.
    """
    if bucket is None:
        window = Window.partitionBy(*keys).orderBy(*order_by)
        return df.withColumn(name, F.row_number().over(window).cast("bigint"))

    bucketed = df.withColumn("_bucket", bucket)
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(*keys, "_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_kb"), "_before")
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order_by)
    local = bucketed.withColumn("_rank", F.row_number().over(within))
    pairs = [(k, f"_k{i}") for i, k in enumerate(keys)] + [("_bucket", "_kb")]
    return local.join(offsets, same_key(local, offsets, pairs)).select(
        *df.columns, (F.col("_before") + F.col("_rank")).alias(name)
    )


def framed(
    df: DataFrame,
    keys: list[str],
    order_by: list[str | Column],
    bucket: Column,
    values: Callable[[WindowSpec], dict[str, Column]],
    before: int = 1,
    after: int = 0,
    block_rows: int = 100_000,
) -> DataFrame:
    """`df` with window values that look at most `before` rows back and `after` rows ahead: lag, lead, and
    aggregates over explicit row frames.

    The rows of a key are numbered bucket by bucket (see `number_rows`; `order_by` should end in a unique
    column) and cut into blocks. A block borrows the rows next to its borders from its neighbours,
    so each is computed by itself and no task holds a key as a whole. `values` gets the window and
    must not reach further than said.
    """
    if max(before, after) > block_rows:
        raise ValueError("a frame may reach over one border only")
    numbered = number_rows(df, keys, order_by, bucket, "_n").withColumn("_own", F.floor((F.col("_n") - 1) / block_rows))
    place = (F.col("_n") - 1) % block_rows
    needed = F.array(
        F.col("_own"),
        F.when(place >= block_rows - before, F.col("_own") + 1),
        F.when((place < after) & (F.col("_own") > 0), F.col("_own") - 1),
    )
    spread = numbered.withColumn("_block", F.explode(F.array_compact(needed)))
    window = Window.partitionBy(*keys, "_block").orderBy("_n")
    found = values(window)
    return spread.withColumns(found).where("_block = _own").select(*df.columns, *found)


def tiles(df: DataFrame, keys: list[str], order_by: list[str | Column], bucket: Column, count: int, name: str = "tile") -> DataFrame:
    """`ntile` of each row in its key, from its number and the key's rows: no task holds a key."""
    numbered = with_group_stats(number_rows(df, keys, order_by, bucket, "_n"), keys, {"_rows": F.count(F.lit(1))})
    size, larger = F.floor(F.col("_rows") / count), F.col("_rows") % count
    edge, at = larger * (size + 1), F.col("_n") - 1
    tile = F.when(at < edge, F.floor(at / (size + 1))).otherwise(larger + F.floor((at - edge) / F.greatest(size, F.lit(1))))
    return numbered.select(*df.columns, (tile + 1).cast("int").alias(name))


def keep_latest(df: DataFrame, keys: list[str], order_by: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """One row per key: the greatest by `order_by`, then by all other columns, so the
    survivor depends on the rows alone and not on their order or partitioning.

    `row_number() = 1` lets Spark keep one row per key and partition before the
    shuffle, which also takes the weight off a hot key.
    """
    others = [c for c in df.columns if c not in keys and c not in order_by]
    order = [F.col(f"`{c}`").desc_nulls_last() for c in (*order_by, *others)]
    if not order:
        return df.distinct()
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def with_group_stats(df: DataFrame, keys: list[str], stats: dict[str, Column]) -> DataFrame:
    """Every row with aggregates over all rows of its key, as a window over the whole
    partition would give. An output may replace a column of the input.

    The aggregates are built by partial aggregation and joined back. They are grouped
    by a struct of the key: grouped by the key itself they would already lie as the
    join wants them, and Spark only splits a hot key where the join shuffles both sides.
    """
    pairs = [(k, f"_k{i}") for i, k in enumerate(keys)]
    values = {name: f"_v{i}" for i, name in enumerate(stats)}
    key = F.struct(*[F.col(k).alias(r) for k, r in pairs]).alias("_key")
    per_key = df.groupBy(key).agg(*[column.alias(values[name]) for name, column in stats.items()])
    per_key = per_key.select("_key.*", *values.values())
    joined = df.join(per_key, same_key(df, per_key, pairs), "left")
    found = [F.col(v).alias(name) for name, v in values.items()]
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c not in stats], *found)
