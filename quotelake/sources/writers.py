"""Dataset writers.

Partitioned writes first rebalance on the partition columns: small partitions share
a task and large ones are split over several, so neither many tiny files nor one
task per hot value comes out."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, columns: list[str], cluster_by: list[str] | None = None) -> None:
    """One folder per value of `columns`; rows inside a file are sorted by
    `cluster_by`, which lets filters on those columns skip row groups."""
    spread = df.hint("rebalance", *columns)
    if cluster_by:
        spread = spread.sortWithinPartitions(*columns, *cluster_by)
    spread.write.mode("overwrite").partitionBy(*columns).parquet(path)


#: Characters of the records that make up a JSON document, unless one record alone is longer.
DOCUMENT_CHARS = 1 << 26


def json_documents(df: DataFrame, group: str, row_id: list[str], document_chars: int = DOCUMENT_CHARS) -> DataFrame:
    """`(group, value)` rows, `value` being a JSON array of records of the group.

    The records are sorted by group and `row_id`, a unique key, and every task writes its
    run of them as it comes: a document holds successive records of one group, up to
    `document_chars` characters. A group of any size is treated alike, and no task holds more
    than a document of it.
    """
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("_record")
    lines = df.select(F.col(group), *[F.col(c).alias(f"_id{i}") for i, c in enumerate(row_id)], record)
    lines = lines.orderBy(group, *[f"_id{i}" for i in range(len(row_id))]).select(F.col(group).cast("string"), "_record")

    def arrays(batches):
        held, size, current = [], 0, None

        def document():
            return pa.record_batch([pa.array([current], pa.string()), pa.array([f"[{','.join(held)}]"], pa.string())], [group, "value"])

        for batch in batches:
            for name, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if held and (name != current or size + len(text) > document_chars):
                    yield document()
                    held, size = [], 0
                current = name
                held.append(text)
                size += len(text) + 1
        if held:
            yield document()

    schema = T.StructType([T.StructField(group, T.StringType()), T.StructField("value", T.StringType())])
    documents = lines.mapInArrow(arrays, schema)
    return documents.select(F.col(group).cast(df.schema[group].dataType).alias(group), "value")


def write_json_documents(df: DataFrame, path: str, group: str, row_id: list[str], document_chars: int = DOCUMENT_CHARS) -> None:
    """JSON array documents below one folder per group, one document per file."""
    documents = json_documents(df, group, row_id, document_chars)
    documents.write.mode("overwrite").option("maxRecordsPerFile", 1).partitionBy(group).text(path)
