"""Counts, duplicate groups, distinct rows, joined text, several groupings at once, mergeable sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def count_by(df: DataFrame, key: Column, name: str, count: str = "cnt") -> DataFrame:
    """Group count by a derived value such as a day text."""
    return df.groupBy(key.alias(name)).agg(F.count("*").alias(count))


def duplicate_keys(df: DataFrame, keys: list[str], count: str = "cnt") -> DataFrame:
    """Key groups that occur more than once, with their size."""
    return df.groupBy(*keys).agg(F.count("*").alias(count)).where(F.col(count) > 1)


def duplicate_group_count(df: DataFrame, keys: list[str], name: str = "duplicates") -> DataFrame:
    return row_count(duplicate_keys(df, keys), name)


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows over all or the named columns."""
    return (df.select(*columns) if columns else df).distinct()


def join_symbols(
    df: DataFrame, symbol: str, n: int, order_by: str | None = None, sep: str = " ", name: str = "symbols"
) -> DataFrame:
    """The first `n` symbols as one text. The top-n is taken per partition before
    anything meets in one task, so that task never holds more than `n` rows."""
    order = order_by or symbol
    ranked = df.select(F.col(order).alias("_o"), F.col(symbol).alias("_s")).orderBy("_o", "_s").limit(n)
    ordered = F.sort_array(F.collect_list(F.struct("_o", "_s")))
    return ranked.agg(F.array_join(ordered["_s"], sep).alias(name))


def by_sets(df: DataFrame, sets: list[list[str]], stats: dict[str, Column], level: str = "level") -> DataFrame:
    """Aggregates over several groupings in one pass.

    Columns that a set lacks are NULL in its rows; `level` has a bit for each of them, the first column's
    being the highest, which tells such a NULL from one in the data. Rows are expanded once and
    aggregated in each task before the one shuffle.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns])
    return grouped.agg(F.grouping_id().cast("int").alias(level), *[column.alias(name) for name, column in stats.items()])


def rollup_sets(columns: list[str]) -> list[list[str]]:
    """From all columns down to none, the last one going first."""
    return [columns[:n] for n in range(len(columns), -1, -1)]


#: log2 of the registers of a count sketch (a relative error of about 1.6 %), and the size of a quantile sketch (1.3 %).
COUNT_SKETCH, QUANTILE_SKETCH = 12, 200


def sketch(df: DataFrame, by: list[str | Column], distinct: str, value: str) -> DataFrame:
    """One row for each group with `n`, a sketch of the distinct values of one column (`ids`), and one of the
    distribution of another (`spread`). Sketches have a bounded size whatever they have seen, and can be
    stored and merged."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(F.col(distinct), F.lit(COUNT_SKETCH)).alias("ids"),
        F.kll_sketch_agg_double(F.col(value), F.lit(QUANTILE_SKETCH)).alias("spread"),
    )


def merge_sketches(sketches: DataFrame, by: list[str], quantiles: dict[str, float]) -> DataFrame:
    """`by`, `n`, `n_distinct` and the named quantiles over all stored groups that share `by`, none of the
    rows behind them being read."""
    merged = sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.hll_union_agg("ids").alias("_ids"), F.kll_merge_agg_double("spread").alias("_spread")
    )
    found = [F.kll_sketch_get_quantile_double("_spread", F.lit(q)).alias(name) for name, q in quantiles.items()]
    return merged.select(*by, "n", F.hll_sketch_estimate("_ids").alias("n_distinct"), *found)
