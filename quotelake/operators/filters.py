"""Row filters and the selection of posts that mention a ticker."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# How a hashtag and a retweet look. A tag ends where letters, digits and
# underscores of any script end; the second form finds symbols such as `BRK.B`.
HASHTAGS = (
    r"(?<![\p{L}\p{N}_&])#([A-Za-z0-9_]+)(?![\p{L}\p{N}_])",
    r"(?<![\p{L}\p{N}_&])#([A-Za-z0-9_]+[.-][A-Za-z0-9_]+)(?![\p{L}\p{N}_])",
)
RETWEET = r"^RT @"


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(_all([F.col(c).isNotNull() for c in columns]))


def equals(df: DataFrame, **values: object) -> DataFrame:
    """Conjunction of equalities."""
    return df.where(_all([F.col(c) == F.lit(v) for c, v in values.items()]))


def since(df: DataFrame, column: str, lower: object) -> DataFrame:
    """Inclusive lower bound. Day texts sort like days, so text bounds work too."""
    return df.where(F.col(column) >= F.lit(lower))


def nonempty_payload(df: DataFrame, payload: str, label: str | None = None) -> DataFrame:
    """Drop rows with an empty payload (array or text) and rows without a label."""
    kind = dict(df.dtypes)[payload]
    size = F.size(payload) if kind.startswith(("array", "map")) else F.length(F.trim(F.col(payload)))
    kept = df.where(size > 0)
    return kept if label is None else not_null(kept, label)


def select_posts(
    posts: DataFrame,
    universe: DataFrame,
    text: str,
    symbol: str = "Symbol",
    lang: tuple[str, str] | None = ("lang", "en"),
    tag_patterns: tuple[str, ...] = HASHTAGS,
    retweet_pattern: str = RETWEET,
    ticker: str = "ticker",
) -> DataFrame:
    """Posts in the wanted language that are no retweets, once per universe symbol
    tagged in the text. The tags are cut out per row and matched by an equality
    join, so a post costs its own tags, not the size of the universe; symbols are
    compared without regard to case."""
    wanted = posts if lang is None else equals(posts, **{lang[0]: lang[1]})
    wanted = wanted.where(~F.coalesce(F.col(text).rlike(retweet_pattern), F.lit(False)))
    found = F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in tag_patterns])
    tags = F.transform(found, F.upper)
    symbols = not_null(universe, symbol).select(F.upper(symbol).alias("_tag"), F.col(symbol).alias(ticker)).distinct()
    tagged = wanted.withColumn("_tag", F.explode(F.array_distinct(tags)))
    return tagged.join(symbols, "_tag").drop("_tag")


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
