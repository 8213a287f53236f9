"""The 26 lake entities: how each is projected from staged feeds, and its key.

Builders only project and filter. Repeated rows need no step of their own, since
every entity ends in the keyed merge, which keeps one row per key."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake import schemas as S
from quotelake.functions.keys import composite_key, concat_key, same_key, stable_id
from quotelake.functions.times import day_text
from quotelake.operators.filters import not_null
from quotelake.operators.joins import enrich
from quotelake.operators.merge import merge_co_located, merge_latest, union_all
from quotelake.operators.projection import rename, select_as
from quotelake.operators.reshape import explode_array, explode_structs
from quotelake.operators.windows import keep_latest
from quotelake.sources.buckets import BucketedTable
from quotelake.sources.snapshots import LakeTable

Staged = dict[str, DataFrame]

#: Buckets of a new bucketed entity. At a terabyte of news some 4,096 are right.
BUCKETS = 64


@dataclass(frozen=True)
class EntitySpec:
    """`partition_by` must derive from the key, see `LakeTable.update`. A `bucketed` entity is
    dealt into buckets by its key instead. With `any_source`, any one of the sources gives
    complete rows of its own."""

    name: str
    sources: tuple[str, ...]
    keys: list[str]
    build: Callable[[Staged], DataFrame]
    order_by: tuple[str, ...] = ()
    partition_by: dict[str, Callable[[], Column]] = field(default_factory=dict)
    cluster_by: tuple[str, ...] = ()
    any_source: bool = False
    bucketed: bool = False

    @property
    def schema(self) -> T.StructType:
        return S.entity_schema(self.name)

    def table(self, lake_dir: str, buckets: int = BUCKETS) -> LakeTable:
        """`buckets` holds where a bucketed entity is stored for the first time."""
        path = f"{lake_dir}/{self.name}"
        if self.bucketed:
            return BucketedTable(path, self.schema, keys=tuple(self.keys), buckets=buckets)
        return LakeTable(path, self.schema, self.partition_by, self.cluster_by)

    def update(self, spark: SparkSession, lake_dir: str, incoming: DataFrame, buckets: int = BUCKETS) -> int:
        """Merge a batch into the stored entity; the number of rows written."""
        table = self.table(lake_dir, buckets)
        if isinstance(table, BucketedTable):
            co_located = lambda stored, latest: merge_co_located(stored, latest, self.keys)
            return table.update(spark, incoming, co_located, lambda rows: keep_latest(rows, self.keys, self.order_by))
        return table.update(spark, incoming, self.merge)

    def merge(self, existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
        return merge_latest(existing, incoming, self.keys, self.order_by, existing_is_keyed=True)


# -- builders --------------------------------------------------------------------


def _columns(name: str) -> list[str]:
    return [f.split()[0].strip("`") for f in S.ENTITIES[name].split(", ")]


def _project(feed: str, entity: str, *drop: str) -> Callable[[Staged], DataFrame]:
    """The entity's columns from one feed, `ticker` being the feed's `symbol`."""
    wanted = [("symbol", "ticker") if c == "ticker" else c for c in _columns(entity) if c not in drop]
    return lambda staged: select_as(staged[feed], *wanted)


def _market_indexes(staged: Staged) -> DataFrame:
    markets = staged["markets_indexes"].select(
        "index",
        concat_key("abbreviation", F.lit(S.MARKET_SUFFIX)).alias("market"),
        F.col("market").alias("country"),
    )
    rows = explode_structs(markets, ["market", "country"], "index", {"id": "index_id", "name": "index_name"})
    return not_null(rows, "index_id")


def _exchanges(staged: Staged) -> DataFrame:
    return not_null(staged["tickers_exchanges"].select("exchange", "market"), "exchange")


def _info(staged: Staged) -> DataFrame:
    own = [("symbol", "ticker") if c == "ticker" else c for c in S.INFO_DIM_COLUMNS.split() if c != "isin"]
    info = keep_latest(select_as(not_null(staged["tickers_info"], "symbol"), *own), ["ticker"])
    isin = rename(staged["tickers_isin"], {"symbol": "ticker"})
    holders = rename(staged["tickers_major_holders"], {"symbol": "ticker"})
    with_isin = enrich(info, isin, "ticker", ["isin"])
    with_holders = enrich(with_isin, holders, "ticker", list(S.MAJOR_HOLDER_LABELS.values()))
    return with_holders.select(*_columns("tickers_info_dim"))


# Feeds of the shared report dimension and their date column.
REPORT_FEEDS = {
    "tickers_financials": "date",
    "tickers_balancesheet": "date",
    "tickers_cashflow": "date",
    "tickers_earnings": "period_detail",
    "tickers_shares": "year",
}


def _reports(staged: Staged, feed: str) -> DataFrame:
    """A report feed with `date`, `ticker`, `period` and the key made of them."""
    rows = rename(staged[feed], {REPORT_FEEDS[feed]: "date", "symbol": "ticker"})
    if "period" not in rows.columns:
        rows = rows.withColumn("period", F.lit("year"))
    return rows.withColumn("reporting_id", composite_key("ticker", "date", "period"))


def _report_dim(staged: Staged) -> DataFrame:
    columns = _columns("financial_report_dim")
    return union_all([_reports(staged, f).select(*columns) for f in REPORT_FEEDS if f in staged])


def _report_fact(feed: str) -> Callable[[Staged], DataFrame]:
    entity = f"{feed}_fact"
    return lambda staged: _reports(staged, feed).select(*_columns(entity))


def _eps(staged: Staged) -> DataFrame:
    rows = rename(staged["tickers_eps"], {"symbol": "ticker"})
    return rows.withColumn("id", composite_key("ticker", "earnings_date"))


def _actions(staged: Staged) -> DataFrame:
    rows = rename(staged["tickers_actions"], {"symbol": "ticker"})
    return rows.select(composite_key("ticker", day_text("date")).alias("id"), "dividends", "stock_splits", "ticker")


def _users(staged: Staged) -> DataFrame:
    """Highest counters over a user's posts, other attributes from the latest post."""
    attributes = ["user_created_at", "user_description", "user_location", "user_name", "user_verified"]
    posts = staged["tweets"]
    latest = keep_latest(posts.select("user_id", "created_at", "tweet_id", *attributes), ["user_id"], ["created_at", "tweet_id"])
    counters = posts.groupBy(F.col("user_id").alias("_user")).agg(
        F.max("user_followers_count").alias("user_followers_count"), F.max("friends_count").alias("friends_count")
    )
    joined = latest.join(counters, same_key(latest, counters, [("user_id", "_user")]))
    return joined.select("user_id", *attributes, "user_followers_count", "friends_count")


def _hashtags(staged: Staged) -> DataFrame:
    rows = explode_array(staged["tweets"], ["tweet_id"], "hashtags", "hashtag")
    return rows.withColumn("hashtag_id", stable_id("hashtag", "tweet_id"))


# -- storage layout of the large entities ----------------------------------------

# Post ids grow with time, so new posts fall into the last few id ranges and an
# update leaves the other partitions alone.
BY_ID_RANGE = {"id_range": lambda: F.shiftright(F.col("tweet_id"), 53)}
BY_INTERVAL_AND_MONTH = {
    "interval": lambda: F.col("interval"),
    "month": lambda: F.substring("date", 1, 7),
}
# A contract symbol ends in its expiry (yymmdd), C or P, and the strike with eight digits. Other symbols
# share one partition. New quotes fall into the months that still trade.
EXPIRY = r"(\d{2})(\d{2})\d{2}[CP]\d{8}$"
BY_EXPIRY_MONTH = {
    "expiry": lambda: F.nullif(
        F.concat_ws("-", *[F.nullif(F.regexp_extract("contract_symbol", EXPIRY, g), F.lit("")) for g in (1, 2)]), F.lit("")
    ),
}

ENTITIES: dict[str, EntitySpec] = {
    e.name: e
    for e in [
        EntitySpec(
            "market_indexes_dim", ("markets_indexes",), ["index_id", "market"],
            lambda s: _market_indexes(s).select("index_id", "index_name", "market"),
        ),
        EntitySpec(
            "markets_dim", ("markets_indexes",), ["market"],
            lambda s: _market_indexes(s).select("market", "country"),
        ),
        EntitySpec("exchanges_dim", ("tickers_exchanges",), ["exchange"], _exchanges),
        EntitySpec(
            "location_dim", ("tickers_info",), ["zip"],
            lambda s: not_null(s["tickers_info"].select("city", "state", "country", "zip"), "zip"),
        ),
        EntitySpec(
            "sector_dim", ("tickers_info",), ["industry"],
            lambda s: not_null(s["tickers_info"].select("industry", "sector"), "industry"),
        ),
        EntitySpec(
            "tickers_info_dim", ("tickers_info", "tickers_isin", "tickers_major_holders"), ["ticker"], _info
        ),
        EntitySpec("news_dim", ("tickers_news",), ["uuid"], _project("tickers_news", "news_dim"), bucketed=True),
        EntitySpec(
            "tickers_news_fact", ("tickers_news",), ["uuid", "ticker"],
            _project("tickers_news", "tickers_news_fact"), bucketed=True,
        ),
        EntitySpec("financial_report_dim", tuple(REPORT_FEEDS), ["reporting_id"], _report_dim, any_source=True),
        *[EntitySpec(f"{feed}_fact", (feed,), ["reporting_id"], _report_fact(feed)) for feed in REPORT_FEEDS],
        EntitySpec("tickers_eps_fact", ("tickers_eps",), ["id"], _eps, ("earnings_date",)),
        EntitySpec("tickers_actions_fact", ("tickers_actions",), ["id"], _actions),
        EntitySpec(
            "holders_dim", ("tickers_holders",), ["holder", "holder_type"], _project("tickers_holders", "holders_dim")
        ),
        EntitySpec(
            "tickers_holders_fact", ("tickers_holders",), ["ticker", "holder"],
            _project("tickers_holders", "tickers_holders_fact"), ("date_reported",),
        ),
        EntitySpec(
            "tickers_analysis_fact", ("tickers_analysis",), ["ticker", "period"],
            _project("tickers_analysis", "tickers_analysis_fact"),
        ),
        EntitySpec(
            "tickers_recommendations_fact", ("tickers_recommendations",), ["ticker", "firm", "date"],
            _project("tickers_recommendations", "tickers_recommendations_fact"),
        ),
        EntitySpec(
            "tickers_options_fact", ("tickers_options",), ["contract_symbol"],
            _project("tickers_options", "tickers_options_fact"), ("last_trade_date",),
            BY_EXPIRY_MONTH, ("ticker", "contract_symbol"),
        ),
        EntitySpec(
            "tickers_historical_prices_fact", ("tickers_historical_prices",),
            ["ticker", "date", "datetime", "interval"],
            lambda s: s["tickers_historical_prices"],
            partition_by=BY_INTERVAL_AND_MONTH, cluster_by=("ticker", "datetime"),
        ),
        EntitySpec(
            "tweets_dim", ("tweets",), ["tweet_id"],
            lambda s: s["tweets"].select(*_columns("tweets_dim")),
            ("created_at",), BY_ID_RANGE, ("tweet_id",),
        ),
        EntitySpec("user_id_dim", ("tweets",), ["user_id"], _users, bucketed=True),
        EntitySpec(
            "hashtags_dim", ("tweets",), ["tweet_id", "hashtag"], _hashtags,
            partition_by=BY_ID_RANGE, cluster_by=("hashtag",),
        ),
        EntitySpec(
            "tickers_tweets_users_fact", ("tweets",), ["ticker", "user_id", "tweet_id"],
            lambda s: s["tweets"].select(*_columns("tickers_tweets_users_fact")),
            partition_by=BY_ID_RANGE, cluster_by=("ticker", "tweet_id"),
        ),
    ]
}
