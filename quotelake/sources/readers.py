"""File scans and typed payloads. The core path always passes a schema."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELD_NAME = re.compile(r"(?:`((?:[^`]|``)*)`|([^:`]+)): ")
TYPE_NAME = re.compile(r"([A-Z_]+)(?:\([^)]*\))?")
# Types of variants, and the column types that hold them.
PLAIN_TYPES = {
    "BIGINT": T.LongType, "BOOLEAN": T.BooleanType, "DOUBLE": T.DoubleType, "FLOAT": T.DoubleType, "DECIMAL": T.DoubleType,
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_universe(spark: SparkSession, path: str, column: str = "Symbol") -> DataFrame:
    """Ticker universe from a one-column CSV, with the position of each row.

    Splits of a file are read in any order, so the position is made of the file, the
    offset of the split and the running number within the split's task."""
    rows = read_csv(spark, path, f"{column} string")
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.select(column, place.alias("position"))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_parquet_glob(spark: SparkSession, base: str, pattern: str, schema: T.StructType | str) -> DataFrame:
    """Several datasets below `base` as one; partition columns in the folder names
    stay available."""
    return spark.read.schema(schema).option("basePath", base).parquet(f"{base}/{pattern}")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files that each hold one JSON array of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def parse_payload(df: DataFrame, payload: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON text column -> its fields as columns, after the other columns. A payload
    that is no object gives a row of NULL fields.

    Without a schema one is derived from every row by a distributed aggregate, which
    runs a job while the plan is built; only the schema's text comes back to the driver."""
    if schema is None:
        schema = infer_payload_schema(df, payload)
    others = [F.col(f"`{c}`") for c in df.columns if c != payload]
    if isinstance(schema, T.StructType) and not schema.fields:
        return df.select(*others)
    whole = F.col(f"`{payload}`")
    is_object = F.schema_of_variant(F.try_parse_json(whole)).startswith("OBJECT")
    parsed = F.from_json(F.when(is_object, whole), schema).alias("_payload")
    return df.select(*others, parsed).select(*others, "_payload.*")


def infer_payload_schema(df: DataFrame, payload: str) -> T.StructType:
    """The fields of all objects in the column: fractions are doubles, and values of
    mixed or unknown type texts."""
    parsed = F.try_parse_json(F.col(f"`{payload}`"))
    objects = F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed)
    found = df.agg(F.schema_of_variant_agg(objects)).first()[0]
    kind = _payload_type(found)[0]
    return kind if isinstance(kind, T.StructType) else T.StructType()


def _payload_type(text: str, at: int = 0) -> tuple[T.DataType, int]:
    """The column type for the variant type that `text` names from `at` on, and where it ends."""
    if text.startswith("OBJECT<", at):
        fields, at = [], at + len("OBJECT<")
        while text[at] != ">":
            name = FIELD_NAME.match(text, at)
            kind, at = _payload_type(text, name.end())
            fields.append(T.StructField(name[1].replace("``", "`") if name[1] is not None else name[2], kind))
            at += 2 if text.startswith(", ", at) else 0
        return T.StructType(fields), at + 1
    if text.startswith("ARRAY<", at):
        kind, at = _payload_type(text, at + len("ARRAY<"))
        return T.ArrayType(kind), at + 1
    name = TYPE_NAME.match(text, at)
    return PLAIN_TYPES.get(name[1], T.StringType)(), name.end()
