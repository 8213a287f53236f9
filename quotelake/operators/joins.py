"""Equality joins of rows with a keyed side.

No join here names a strategy: Spark broadcasts a side only where its measured
size is under the configured limit, and splits hot keys of a shuffled join at run
time. The keyed side has one row per key, so a frequent key can never multiply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.operators.windows import keep_latest


def enrich(
    rows: DataFrame,
    keyed: DataFrame,
    on: str,
    columns: list[str],
    order_by: tuple[str, ...] = (),
    keyed_is_unique: bool = False,
) -> DataFrame:
    """Left join that adds `columns` of the keyed side, NULL without a match.

    Several keyed rows for one key are cut to the latest first, unless the caller
    knows there is one row per key. They are grouped by a struct of the key: grouped
    by the key itself they would already lie as the join wants them, and Spark only
    splits a hot key of `rows` where the join shuffles both sides."""
    side = keyed.select(on, *columns)
    if not keyed_is_unique:
        grouped = side.where(side[on].isNotNull()).withColumn("_key", F.struct(on))
        side = keep_latest(grouped, ["_key"], order_by).drop("_key")
    return rows.join(side, on, "left")


def join_using(bridge: DataFrame, dim: DataFrame, key: str | list[str]) -> DataFrame:
    """Inner join of a bridge table with the dimension it points to."""
    return bridge.join(dim, key)


def join_within(
    rows: DataFrame, others: DataFrame, on: list[str], time: str, other_time: str, seconds: int
) -> DataFrame:
    """Pairs of a row and another one of the same key whose times are at most `seconds` apart.

    Time is cut into bins of that width, so partners lie in the same or in neighbouring bins: the other
    side stands in three of them, and the join is one by equality of key and bin, which also deals
    a hot key out by time. NULL keys and times have no partners.
    """
    shared = {c.lower() for c in rows.columns} & {c.lower() for c in others.columns} - {c.lower() for c in on}
    if shared:
        raise ValueError(f"columns would share a name: {sorted(shared)}")

    def micros(column: str) -> Column:
        return F.unix_micros(F.col(f"`{column}`").cast("timestamp"))

    width = seconds * 1_000_000
    left = rows.withColumn("_bin", F.floor(micros(time) / max(width, 1)))
    at = F.floor(micros(other_time) / max(width, 1))
    right = others.withColumn("_bin", F.explode(F.array(at - 1, at, at + 1)))
    met = left.join(right, [*on, "_bin"]).where(F.abs(micros(time) - micros(other_time)) <= width)
    return met.select(*rows.columns, *[c for c in others.columns if c not in on])
