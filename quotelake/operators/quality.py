"""Row counts and duplicate keys of many tables in one report, and the checks on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.operators.merge import union_all


class QualityError(AssertionError):
    """Tables that are empty or hold more than one row for a key."""


def staging_report(tables: dict[str, DataFrame]) -> DataFrame:
    """`(table_name, row_count)` per staged dataset."""
    return union_all(
        [
            df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )


def lake_report(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """`(table_name, row_count, duplicates)` per table, `duplicates` being the number
    of key groups with more than one row. Row count and duplicates come from the same
    grouping, so each table is read once and only its key columns."""
    return union_all(
        [
            df.groupBy(*keys)
            .agg(F.count("*").alias("_n"))
            .agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
                F.count_if(F.col("_n") > 1).alias("duplicates"),
            )
            .select(F.lit(name).alias("table_name"), "row_count", "duplicates")
            for name, (df, keys) in tables.items()
        ]
    )


def assert_quality(report: DataFrame) -> None:
    """Raise for empty tables, else for duplicate keys. The report has one row per
    table, which is all that reaches the driver."""
    rows = report.collect()
    empty = sorted(r["table_name"] for r in rows if not r["row_count"])
    if empty:
        raise QualityError(f"no entries in: {', '.join(empty)}")
    if "duplicates" in report.columns:
        repeated = sorted(f"{r['table_name']} ({r['duplicates']})" for r in rows if r["duplicates"])
        if repeated:
            raise QualityError(f"duplicate keys in: {', '.join(repeated)}")
