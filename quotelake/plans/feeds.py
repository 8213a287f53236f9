"""The 19 staging feeds: raw payload files to typed, conformed rows.

A feed's raw files lie below `<raw>/<feed>/`, sibling feeds in one subfolder each.
Flat records are JSON lines read as text and typed here, so a bad number costs one
value and not the job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake import schemas as S
from quotelake.functions.text import parse_percent, to_number
from quotelake.functions.times import day_text, second_text
from quotelake.operators.filters import nonempty_payload, not_null, select_posts
from quotelake.operators.merge import union_all
from quotelake.operators.projection import add_constants, conform, flatten_posts, snake_case_columns, type_text
from quotelake.operators.reshape import pivot_labels, stack_matrix
from quotelake.sources import readers
from quotelake.sources.writers import write_json_documents, write_parquet, write_partitioned

Shape = Callable[[DataFrame, T.StructType], DataFrame]


@dataclass(frozen=True)
class FeedSpec:
    """`raw` is the DDL of the raw records; None means a parquet matrix, whose columns
    are the data's own. `parts` maps raw subfolders to the constants of their rows;
    `partition_by` splits the staged dataset into one folder per value."""

    name: str
    raw: str | None
    shape: Shape
    parts: dict[str, dict[str, str]] = field(default_factory=lambda: {"": {}})
    partition_by: tuple[str, ...] = ()
    documents: bool = False
    needs_universe: bool = False

    @property
    def schema(self) -> T.StructType:
        return S.staging_schema(self.name)


# Raw record fields, in payload order.
OPTIONS_RAW = """
contractSymbol lastTradeDate strike lastPrice bid ask change percentChange volume openInterest
impliedVolatility inTheMoney contractSize currency symbol
"""
NEWS_RAW = "uuid title publisher link providerPublishTime type symbol"
ANALYSIS_RAW = [
    "Period", "Growth", "Earnings Estimate Avg", "Earnings Estimate Low", "Earnings Estimate High",
    "Earnings Estimate Year Ago Eps", "Earnings Estimate Number Of Analysts", "Earnings Estimate Growth",
    "Revenue Estimate Avg", "Revenue Estimate Low", "Revenue Estimate High", "Eps Trend Current",
    "Eps Trend 7Days Ago", "Eps Trend 30Days Ago", "Eps Trend 60Days Ago", "Eps Trend 90Days Ago",
    "Eps Revisions Up Last7Days", "Eps Revisions Up Last30Days", "Eps Revisions Down Last30Days",
    "Eps Revisions Down Last90Days", "symbol",
]
HOLDERS_RAW = ["Holder", "Shares", "Date Reported", "% Out", "Value", "symbol"]
EPS_RAW = ["Earnings Date", "EPS Estimate", "Reported EPS", "Surprise(%)", "symbol"]
ACTIONS_RAW = ["Date", "Dividends", "Stock Splits", "symbol"]
RECOMMENDATIONS_RAW = ["Date", "Firm", "To Grade", "From Grade", "Action", "symbol"]
SHARES_RAW = ["Year", "BasicShares", "symbol"]
EARNINGS_RAW = ["Year", "Quarter", "Revenue", "Earnings", "symbol"]


def _text(names: list[str] | str) -> str:
    listed = names.split() if isinstance(names, str) else names
    return ", ".join(f"`{n}` string" for n in listed)


# -- shapes ----------------------------------------------------------------------


def _as_is(raw: DataFrame, schema: T.StructType) -> DataFrame:
    return conform(raw, schema)


def _flat(overrides: dict[str, str] | None = None, days: tuple[str, ...] = (), times: tuple[str, ...] = ()) -> Shape:
    """Snake-case the names, cut timestamps in `days` to their day, take those in `times` as
    written without their zone, type the rest."""

    def shape(raw: DataFrame, schema: T.StructType) -> DataFrame:
        named = snake_case_columns(raw, overrides)
        read = {**{c: day_text(c) for c in days}, **{c: second_text(c) for c in times}}
        return type_text(named.withColumns(read), schema)

    return shape


def _earnings(raw: DataFrame, schema: T.StructType) -> DataFrame:
    named = snake_case_columns(raw)
    return type_text(named.withColumn("period_detail", F.coalesce("year", "quarter")), schema)


def _major_holders(raw: DataFrame, schema: T.StructType) -> DataFrame:
    # Numbers before the pivot: maxima of texts would sort every row, and compare wrongly.
    labelled = nonempty_payload(raw, "value", "label")
    typed = labelled.withColumn("value", parse_percent("value", "decimal(38,6)"))
    wide = pivot_labels(typed, ["symbol"], "label", "value", list(S.MAJOR_HOLDER_LABELS))

    def value(label: str, kind: T.DataType) -> Column:
        found = F.col(f"`{label}`")
        whole = F.when(found == F.floor(found), found) if isinstance(kind, T.IntegralType) else found
        return whole.try_cast(kind)

    return wide.select("symbol", *[value(label, schema[n].dataType).alias(n) for label, n in S.MAJOR_HOLDER_LABELS.items()])


def _statement(labels: dict[str, str] | None = None) -> Shape:
    """Lines of `{"symbol": .., "metric": .., "<date>": .., ..}`, one per ticker and
    metric. The dates differ from ticker to ticker, so the entries of a line are
    exploded and the ones named like a day kept; a day without values stays a row."""
    renamed = {_label_key(raw): name for raw, name in (labels or {}).items()}

    def shape(raw: DataFrame, schema: T.StructType) -> DataFrame:
        wanted = [f.name for f in schema.fields if isinstance(f.dataType, T.DecimalType)]
        key = F.lower(F.regexp_replace(F.trim("metric"), "[^0-9A-Za-z]+", "_"))
        if renamed:
            names = F.create_map(*[F.lit(x) for pair in renamed.items() for x in pair])
            key = F.coalesce(names[key], key)
        typed = _statement_entries(raw).select(
            "symbol", "period", "date", key.alias("metric"), to_number("value", S.D20).alias("value")
        )
        return conform(pivot_labels(typed, ["symbol", "period", "date"], "metric", "value", wanted), schema)

    return shape


def _statement_entries(raw: DataFrame) -> DataFrame:
    """`symbol, period, metric, date, value`, one row per dated entry of a statement line."""
    others = [c for c in raw.columns if c != "value"]
    ids = raw.select(*others, "value", F.json_tuple("value", "symbol", "metric").alias("symbol", "metric"))
    # The parsed map goes straight into the explode: kept as a column, Spark would
    # parse the line again for each filter it derives from it.
    entries = ids.select("symbol", "period", "metric", F.explode(F.from_json("value", "map<string,string>")))
    dated = not_null(entries, "symbol").where(F.col("key").rlike(r"^\d{4}-\d{2}-\d{2}"))
    return dated.withColumn("date", day_text("key")).drop("key")


def report_rows(feed: FeedSpec, raw: DataFrame) -> DataFrame:
    """The keys of a report feed, repeated, without its values: statements are not pivoted."""
    if feed.raw == "value string":
        return _statement_entries(raw).select("symbol", "period", "date")
    return feed.shape(raw, feed.schema)


def _label_key(label: str) -> str:
    return label.strip().lower().replace(" ", "_")


def _prices(raw: DataFrame, schema: T.StructType) -> DataFrame:
    # The times are formatted once per matrix row, before it turns into many bars.
    timed = raw.withColumns({"datetime": second_text("ts"), "date": day_text("ts")}).drop("ts")
    bars = stack_matrix(timed, ["datetime", "date", "interval"], S.PRICE_FIELDS)
    return conform(snake_case_columns(bars), schema)


def _posts(raw: DataFrame, schema: T.StructType) -> DataFrame:
    return conform(flatten_posts(raw), schema)


FEEDS: dict[str, FeedSpec] = {
    f.name: f
    for f in [
        FeedSpec("markets_indexes", S.MARKETS_RAW, _as_is),
        FeedSpec("tickers_exchanges", S.EXCHANGES_RAW, _as_is, partition_by=("market",)),
        FeedSpec("tickers_info", _text(S.INFO_COLUMNS), type_text),
        FeedSpec("tickers_isin", _text("isin symbol"), _flat()),
        FeedSpec("tickers_major_holders", S.MAJOR_HOLDERS_RAW, _major_holders),
        FeedSpec("tickers_holders", _text(HOLDERS_RAW), _flat(S.HOLDERS_LABELS, ("date_reported",)), S.HOLDER_TYPES),
        FeedSpec("tickers_options", _text(OPTIONS_RAW), _flat(), S.OPTION_TYPES),
        FeedSpec("tickers_analysis", _text(ANALYSIS_RAW), _flat()),
        FeedSpec("tickers_balancesheet", "value string", _statement(), S.YEAR_AND_QUARTER),
        FeedSpec("tickers_cashflow", "value string", _statement(S.CASHFLOW_LABELS), S.YEAR_AND_QUARTER),
        FeedSpec("tickers_financials", "value string", _statement(), S.YEAR_AND_QUARTER),
        FeedSpec("tickers_earnings", _text(EARNINGS_RAW), _earnings, S.YEAR_AND_QUARTER),
        FeedSpec("tickers_eps", _text(EPS_RAW), _flat(S.EPS_LABELS, ("earnings_date",))),
        FeedSpec("tickers_actions", _text(ACTIONS_RAW), _flat(times=("date",))),
        FeedSpec("tickers_news", _text(NEWS_RAW), _flat()),
        FeedSpec("tickers_recommendations", _text(RECOMMENDATIONS_RAW), _flat(days=("date",))),
        FeedSpec("tickers_shares", _text(SHARES_RAW), _flat()),
        FeedSpec("tickers_historical_prices", None, _prices, S.PRICE_INTERVALS),
        FeedSpec("tweets", S.POSTS_RAW, _posts, documents=True, needs_universe=True),
    ]
}


# -- running a feed --------------------------------------------------------------


def read_feed(spark: SparkSession, feed: FeedSpec, raw_dir: str, universe: DataFrame | None = None) -> DataFrame:
    """Typed rows of a feed; no raw files give no rows, as a feed may be empty. With a
    universe, feeds about tickers keep the rows of its symbols."""
    shaped = []
    for folder, constants in feed.parts.items():
        path = "/".join(p for p in (raw_dir, feed.name, folder) if p)
        if not _has_files(spark, path):
            continue
        raw = add_constants(_read_raw(spark, feed, path), constants)
        if feed.needs_universe:
            if universe is None:
                raise ValueError(f"feed {feed.name} needs the ticker universe")
            raw = select_posts(raw, universe, "full_text", lang=("metadata.iso_language_code", "en"))
        shaped.append(feed.shape(raw, feed.schema))
    if not shaped:
        return spark.createDataFrame([], feed.schema)
    rows = union_all(shaped)
    ticker = next((c for c in ("symbol", "ticker") if c in rows.columns), None)
    if universe is None or ticker is None or feed.needs_universe:
        return rows
    return rows.join(universe.select(F.col("Symbol").alias(ticker)), ticker, "left_semi")


def _read_raw(spark: SparkSession, feed: FeedSpec, path: str) -> DataFrame:
    if feed.raw is None:
        return spark.read.option("mergeSchema", True).parquet(path)
    if feed.raw == "value string":
        return spark.read.text(path)
    if feed.documents:
        return readers.read_json_documents(spark, path, feed.raw)
    return readers.read_json_lines(spark, path, feed.raw)


def _has_files(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path + "/*")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return bool(found)


def stage_feed(
    spark: SparkSession, feed: FeedSpec, raw_dir: str, staging_dir: str, universe: DataFrame | None = None
) -> None:
    rows, path = read_feed(spark, feed, raw_dir, universe), f"{staging_dir}/{feed.name}"
    if feed.partition_by:
        write_partitioned(rows, path, list(feed.partition_by))
    else:
        write_parquet(rows, path)


def export_posts(spark: SparkSession, staging_dir: str, target: str) -> None:
    """Staged posts as JSON array documents, one folder per ticker."""
    write_json_documents(read_staged(spark, "tweets", staging_dir), target, "ticker", ["tweet_id"])


def read_staged(spark: SparkSession, name: str, staging_dir: str) -> DataFrame:
    schema = FEEDS[name].schema
    return readers.read_parquet(spark, f"{staging_dir}/{name}", schema).select(schema.fieldNames())
