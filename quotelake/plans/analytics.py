"""Per-ticker analyses. Column names are parameters, so the same plan serves the
lake entities and any table of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.times import day_text, epoch_to_timestamp
from quotelake.operators.aggregates import count_by, distinct_rows
from quotelake.operators.filters import equals, since
from quotelake.operators.joins import join_using
from quotelake.operators.ordering import latest_n, sort_asc, sort_desc
from quotelake.operators.windows import keep_latest


def posts_per_day(
    bridge: DataFrame,
    posts: DataFrame,
    ticker: object,
    key: str | list[str] = "tweet_id",
    ticker_column: str = "ticker",
    created_column: str = "created_at",
) -> DataFrame:
    """`(date, cnt)`: posts of a ticker per day, oldest first. The key may be several
    columns, such as the partition of a stored table and the id."""
    found = equals(join_using(bridge, posts, key), **{ticker_column: ticker})
    return sort_asc(count_by(found, day_text(created_column), "date"), "date")


def ticker_profile(info: DataFrame, ticker: object, ticker_column: str = "ticker") -> DataFrame:
    return distinct_rows(equals(info, **{ticker_column: ticker}))


def recent_bars(
    prices: DataFrame,
    ticker: object,
    interval: object = "1d",
    n: int = 10,
    ticker_column: str = "ticker",
    interval_column: str = "interval",
    order_by: tuple[str, ...] = ("date", "datetime"),
) -> DataFrame:
    """The last `n` bars, oldest first."""
    bars = equals(prices, **{ticker_column: ticker, interval_column: interval})
    return latest_n(bars, n, list(order_by))


def daily_bars(
    prices: DataFrame,
    ticker: object,
    interval: object = "1d",
    days: int = 10,
    ticker_column: str = "ticker",
    interval_column: str = "interval",
    date_column: str = "date",
    order_by: tuple[str, ...] = ("datetime",),
) -> DataFrame:
    """The last bar of each of the last `days` days, oldest first."""
    bars = equals(prices, **{ticker_column: ticker, interval_column: interval})
    return latest_n(keep_latest(bars, [date_column], order_by), days, [date_column])


def bars_since(
    prices: DataFrame,
    ticker: object,
    interval: object,
    lower: object,
    ticker_column: str = "ticker",
    interval_column: str = "interval",
    date_column: str = "date",
    order_by: tuple[str, ...] = ("date", "datetime"),
) -> DataFrame:
    """Bars from a date on, oldest first."""
    bars = equals(prices, **{ticker_column: ticker, interval_column: interval})
    return sort_asc(since(bars, date_column, lower), *order_by)


def news_feed(
    bridge: DataFrame,
    news: DataFrame,
    ticker: object,
    key: str = "uuid",
    ticker_column: str = "ticker",
    time_column: str = "provider_publish_time",
) -> DataFrame:
    """News of a ticker, newest first, with the publish time readable."""
    found = equals(join_using(bridge, news, key), **{ticker_column: ticker})
    return sort_desc(found.withColumn(time_column, epoch_to_timestamp(time_column)), time_column, key)


def price_vs_posts(bars: DataFrame, posts: DataFrame, date: str = "date", count: str = "cnt") -> DataFrame:
    """Bars side by side with the posts of their day; days without posts count 0.

    Both sides come ready per day (`daily_bars`, `posts_per_day`)."""
    joined = bars.join(posts.select(date, count), date, "left")
    return sort_asc(joined.withColumn(count, F.coalesce(count, F.lit(0))), date)
