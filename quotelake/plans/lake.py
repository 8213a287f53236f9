"""Staging, building, checking and querying a lake."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.operators.aggregates import duplicate_keys, join_symbols
from quotelake.operators.ordering import first_n_symbols, preview
from quotelake.operators.quality import assert_quality, lake_report, staging_report
from quotelake.plans import analytics
from quotelake.plans.entities import BUCKETS, ENTITIES
from quotelake.plans.feeds import FEEDS, read_staged, stage_feed
from quotelake.sources.readers import read_universe


class Lake:
    """A lake made of raw files, staged feeds and entities in three folders.

    Feeds are independent of each other and so are entities; a few are submitted at a
    time so that small ones do not wait for the cluster to drain after large ones.
    """

    def __init__(
        self, spark: SparkSession, raw_dir: str, staging_dir: str, lake_dir: str, at_once: int = 4, buckets: int = BUCKETS
    ):
        self.spark, self.raw_dir, self.staging_dir, self.lake_dir = spark, raw_dir, staging_dir, lake_dir
        self.at_once, self.buckets = at_once, buckets

    def universe(self, symbols: int | None = None) -> DataFrame:
        listed = read_universe(self.spark, f"{self.raw_dir}/universe.csv")
        return listed.select("Symbol") if symbols is None else first_n_symbols(listed, symbols)

    def symbols_text(self, symbols: int) -> DataFrame:
        """The first symbols of the universe as one text, separated by blanks."""
        listed = read_universe(self.spark, f"{self.raw_dir}/universe.csv")
        return join_symbols(listed, "Symbol", symbols, order_by="position")

    def stage(self, feeds: Iterable[str] = tuple(FEEDS), symbols: int | None = None) -> None:
        """Raw files to staged parquet, each feed replaced as a whole. `symbols` limits
        the feeds to the first symbols of the universe; posts always need it."""

        def stage(name: str) -> None:
            wanted = symbols is not None or FEEDS[name].needs_universe
            universe = self.universe(symbols) if wanted else None
            stage_feed(self.spark, FEEDS[name], self.raw_dir, self.staging_dir, universe)

        self._each(stage, feeds)

    def build(self, entities: Iterable[str] = tuple(ENTITIES)) -> dict[str, int]:
        """Merge the staged rows into the entities; rows written per entity."""

        def update(name: str) -> int:
            entity = ENTITIES[name]
            incoming = entity.build({f: read_staged(self.spark, f, self.staging_dir) for f in entity.sources})
            return entity.update(self.spark, self.lake_dir, incoming, self.buckets)

        return self._each(update, entities)

    def table(self, entity: str, where: Column | None = None, partitions: bool = False) -> DataFrame:
        """An entity as it is stored; see `LakeTable.read` for the rest."""
        stored = ENTITIES[entity].table(self.lake_dir)
        found = stored.read(self.spark, where, partitions)
        if found is not None:
            return found
        return self.spark.createDataFrame([], stored.stored_schema() if partitions else stored.schema)

    def expire(self, keep: int = 2) -> None:
        """Drop files that the newest `keep` states of the entities do not use."""
        self._each(lambda name: ENTITIES[name].table(self.lake_dir).expire(self.spark, keep), ENTITIES)

    def preview_staged(self, feed: str, n: int = 5) -> tuple[int, list[str], DataFrame]:
        """Row count, columns and the first rows of a staged feed."""
        rows = read_staged(self.spark, feed, self.staging_dir)
        return rows.count(), rows.columns, preview(rows, n, rows.columns[:1])

    def duplicates(self, entity: str) -> DataFrame:
        """Keys of an entity that occur more than once; empty in a sound lake."""
        return duplicate_keys(self.table(entity), ENTITIES[entity].keys)

    def staging_report(self) -> DataFrame:
        return staging_report({f: read_staged(self.spark, f, self.staging_dir) for f in FEEDS})

    def lake_report(self) -> DataFrame:
        return lake_report({e: (self.table(e), spec.keys) for e, spec in ENTITIES.items()})

    def check(self) -> None:
        assert_quality(self.staging_report())
        assert_quality(self.lake_report())

    def _each(self, job, names: Iterable[str]) -> dict:
        names = list(names)
        with ThreadPoolExecutor(self.at_once) as pool:
            return dict(zip(names, pool.map(job, names)))

    # -- analyses ----------------------------------------------------------------

    def posts_per_day(self, ticker: str) -> DataFrame:
        # Both are stored by ranges of the post id: the ranges of the ticker's posts are the only ones read.
        bridge, posts = (self.table(e, partitions=True) for e in ("tickers_tweets_users_fact", "tweets_dim"))
        return analytics.posts_per_day(bridge, posts, ticker, key=["id_range", "tweet_id"])

    def ticker_profile(self, ticker: str) -> DataFrame:
        return analytics.ticker_profile(self.table("tickers_info_dim"), ticker)

    def recent_bars(self, ticker: str, interval: str = "1d", n: int = 10) -> DataFrame:
        return analytics.recent_bars(self._newest_bars(ticker, interval, n, "datetime"), ticker, interval, n)

    def bars_since(self, ticker: str, interval: str, date: str) -> DataFrame:
        months = F.col("month") >= F.lit(date[:7])
        return analytics.bars_since(self.table("tickers_historical_prices_fact", months), ticker, interval, date)

    def news_feed(self, ticker: str) -> DataFrame:
        return analytics.news_feed(self.table("tickers_news_fact"), self.table("news_dim"), ticker)

    def price_vs_posts(self, ticker: str, days: int = 10) -> DataFrame:
        bars = analytics.daily_bars(self._newest_bars(ticker, "1d", days, "date"), ticker, "1d", days)
        return analytics.price_vs_posts(bars, self.posts_per_day(ticker))

    def _newest_bars(self, ticker: str, interval: str, n: int, what: str) -> DataFrame:
        """The stored prices of as many of the newest months as hold `n` different values of the column
        `what` for the ticker. Months come from the folder list; looking back doubles their number
        until they suffice, and each look counts one column of the months that it adds."""
        entity = "tickers_historical_prices_fact"
        months = ENTITIES[entity].table(self.lake_dir).partition_values(self.spark, {"interval": interval}, "month")
        wanted, found, looked = (F.col("ticker") == ticker) & (F.col("interval") == interval), 0, 0
        while found < n and looked < len(months):
            more = months[looked : max(1, 2 * looked)]
            here = self.table(entity, F.col("month").isin(more) & wanted)
            found += here.select(what).distinct().limit(n).count()
            looked += len(more)
        # Bars without a date, which no month holds, only count where the others are too few.
        newest = F.col("month").isin(months[:looked]) if found >= n else F.lit(True)
        return self.table(entity, newest & (F.col("interval") == interval))
