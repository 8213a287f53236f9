"""Sorting and limits.

Callers name a unique key last. What ties are left, repeated rows above all, are settled
by a 64-bit hash of the row and the number of the input partition. Only the named
columns and these two numbers are sort keys: a range sort samples its keys to the
driver, where no texts should go, and can still cut through a value that many rows share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.session import fresh_path


def sort_asc(df: DataFrame, *columns: str) -> DataFrame:
    return _sorted(df, columns, descending=False)


def sort_desc(df: DataFrame, *columns: str) -> DataFrame:
    return _sorted(df, columns, descending=True)


def _sorted(df: DataFrame, columns: tuple[str, ...] | list[str], descending: bool) -> DataFrame:
    tied = df.withColumns({"_tie": _row_hash(df, columns), "_part": F.spark_partition_id()})
    return tied.orderBy(*_order(columns, descending)).drop("_tie", "_part")


def _order(columns: tuple[str, ...] | list[str], descending: bool) -> list[Column]:
    ordered = [F.col(f"`{c}`") for c in (*columns, "_tie", "_part")]
    return [c.desc() if descending else c.asc() for c in ordered]


def _row_hash(df: DataFrame, columns: tuple[str, ...] | list[str]) -> Column:
    others = [F.col(f"`{name}`") for name, kind in df.dtypes if name not in columns and "map<" not in kind]
    return F.xxhash64(*others) if others else F.lit(0)


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """The rows of a sorted `df` numbered from 1 in their order.

    Each task numbers its own rows, and the numbers are shifted by the sizes of the
    partitions before; only these sizes, one for each partition, meet in one task. The
    rows are written in between, so that both steps see one and the same sort.
    """
    path = fresh_path(df.sparkSession, "sorted")
    marked = df.withColumn("_id", F.monotonically_increasing_id())
    marked.write.parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    stored = stored.withColumn("_part", F.shiftright("_id", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_n"))
    shifts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.col("_id").bitwiseAND((1 << 33) - 1) + 1
    return stored.join(shifts, "_part").select(*df.columns, (own + F.col("_before")).alias(name))


def latest_n(df: DataFrame, n: int, by: list[str]) -> DataFrame:
    """The `n` greatest rows by `by`, returned oldest first; the top-n is taken per
    partition before rows meet."""
    tied = df.withColumns({"_tie": _row_hash(df, by), "_part": F.spark_partition_id()})
    latest = tied.orderBy(*_order(by, descending=True)).limit(n)
    return latest.orderBy(*_order(by, descending=False)).drop("_tie", "_part")


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    tied = df.withColumns({"_tie": _row_hash(df, order_by), "_part": F.spark_partition_id()})
    return tied.orderBy(*_order(order_by, descending=False)).limit(n).drop("_tie", "_part")


def first_n_symbols(universe: DataFrame, n: int, symbol: str = "Symbol", position: str = "position") -> DataFrame:
    """The first `n` symbols in file order (see `sources.readers.read_universe`)."""
    return universe.orderBy(position).limit(n).select(symbol)
