"""Projections: renames, constants, casts, schema conformance, flattening."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.functions.text import missing_to_null, to_number
from quotelake.functions.times import day_text, second_text


def select_as(df: DataFrame, *columns: str | tuple[str, str]) -> DataFrame:
    """Column subset; a `(source, target)` pair renames on the way."""
    return df.select(
        *[F.col(c) if isinstance(c, str) else F.col(c[0]).alias(c[1]) for c in columns]
    )


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename in place. Unlike `withColumnsRenamed`, an unknown name is an error
    and a pure change of case is applied as such."""
    unknown = set(names) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return _renamed(df, [names.get(c, c) for c in df.columns])


def snake_case(name: str) -> str:
    """`Total Liab`, `lastTradeDate` -> `total_liab`, `last_trade_date`."""
    split = re.sub(r"(?<=[a-z])(?=[A-Z])", "_", name)
    return re.sub(r"[^0-9A-Za-z]+", "_", split).strip("_").lower()


def snake_case_columns(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """All columns to snake_case; `overrides` names the ones the rule cannot guess."""
    overrides = overrides or {}
    return _renamed(df, [overrides.get(c, snake_case(c)) for c in df.columns])


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    clashes = [n for n, k in Counter(n.lower() for n in names).items() if k > 1]
    if clashes:
        raise ValueError(f"columns would share a name: {clashes}")
    return df.toDF(*names)


def add_constants(df: DataFrame, constants: dict[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns in one projection; what does not fit becomes NULL."""
    return df.select(
        *[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of `schema`, in its order and types: missing ones are
    added as NULL, unexpected ones dropped."""
    present = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField):
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        source = F.col(f"`{field.name}`")
        if present[field.name] == field.dataType:
            return source
        return source.try_cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def type_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`conform` for frames that hold everything as text: missing-value texts become
    NULL and numbers are parsed, bad ones to NULL."""
    present = set(df.columns)
    typed = {}
    for field in schema.fields:
        if field.name in present and isinstance(field.dataType, T.StringType):
            typed[field.name] = missing_to_null(field.name)
        elif field.name in present and isinstance(field.dataType, T.NumericType):
            typed[field.name] = to_number(field.name, field.dataType.simpleString())
    return conform(df.withColumns(typed), schema)


def flatten_posts(posts: DataFrame, ticker: str = "ticker") -> DataFrame:
    """Nested post records -> 19 flat fields. `created_at` may be a timestamp or text."""
    tag_texts = F.coalesce(F.col("entities.hashtags.text"), F.array().cast("array<string>"))
    return posts.select(
        F.col(ticker).alias("ticker"),
        F.col("id").alias("tweet_id"),
        second_text("created_at").alias("created_at"),
        "in_reply_to_status_id",
        "truncated",
        tag_texts.alias("hashtags"),
        F.col("full_text").alias("text"),
        F.col("metadata.iso_language_code").alias("lang"),
        "retweet_count",
        "source",
        "source_url",
        F.col("user.id").alias("user_id"),
        F.col("user.name").alias("user_name"),
        F.col("user.location").alias("user_location"),
        F.col("user.description").alias("user_description"),
        F.col("user.verified").alias("user_verified"),
        F.col("user.followers_count").alias("user_followers_count"),
        F.col("user.friends_count").alias("friends_count"),
        day_text("user.created_at").alias("user_created_at"),
    )
