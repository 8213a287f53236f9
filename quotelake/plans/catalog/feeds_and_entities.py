"""The 19 feeds and 26 entities run on payloads that Spark derives from the driver
tables. `RAW` makes the payload of a feed, `STAGED_SQL` is what staging must give,
and each entity's SQL is written over the staged SQL of its feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake import schemas as S
from quotelake.functions.times import day_text, second_text
from quotelake.operators.filters import select_posts
from quotelake.plans.catalog.columns import FLAT_POSTS_SQL, posts_from_events
from quotelake.plans.catalog.registry import Tables, query
from quotelake.plans.entities import ENTITIES
from quotelake.plans.feeds import FEEDS, read_feed, report_rows
from quotelake.plans.lake import Lake
from quotelake.session import fresh_path
from quotelake.sources.writers import write_json_documents

# -- shared bits -----------------------------------------------------------------


def _money(column: str) -> Column:
    """A double with two decimals as the text a payload would hold."""
    return F.col(column).cast(S.D20).cast("string")


def _customer_name(key: str) -> Column:
    return F.concat(F.lit("Customer#"), F.lpad(F.col(key).cast("string"), 9, "0"))


def _customer_name_sql(key: str) -> str:
    return f"'Customer#' || lpad(cast({key} as varchar), 9, '0')"


def _fields(ddl: str) -> dict[str, str]:
    pairs = [f.split(" ", 1) for f in ddl.split(", ")]
    return {name.strip("`"): kind for name, kind in pairs}


def _null_filled(contract: str, expressions: dict[str, str]) -> str:
    """Select list with all columns of a contract, NULL where nothing is given."""
    kinds = {"string": "varchar", "int": "integer"}
    return ", ".join(
        f'({expressions.get(name, "null")})::{kinds.get(kind, kind)} as "{name}"'
        for name, kind in _fields(contract).items()
    )


# -- raw payloads ----------------------------------------------------------------


def _raw_markets(t: Tables) -> DataFrame:
    return t.part.select(
        F.nullif("p_brand", F.lit("Brand#7")).alias("abbreviation"),
        F.array(
            F.struct(F.col("p_size").cast("string").alias("id"), F.col("p_name").alias("name")),
            F.struct(F.lit(None).cast("string").alias("id"), F.col("p_type").alias("name")),
        ).alias("index"),
        F.col("p_type").alias("market"),
    )


def _raw_exchanges(t: Tables) -> DataFrame:
    exchange = F.concat("c_mktsegment", F.lit("-"), "c_nationkey")
    return t.customer.select(
        F.when(F.col("c_mktsegment") != "FURNITURE", exchange).alias("exchange"),
        F.concat("c_mktsegment", F.lit(S.MARKET_SUFFIX)).alias("market"),
        F.col("c_name").alias("symbol"),
    )


def _raw_info(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_name").alias("symbol"),
        F.concat(F.lit("City"), F.col("c_custkey") % 7).alias("city"),
        F.when(F.col("c_nationkey") < 3, F.lit("NaN")).otherwise(F.col("c_nationkey").cast("string")).alias("zip"),
        F.col("c_mktsegment").alias("industry"),
        F.substring("c_mktsegment", 1, 1).alias("sector"),
        F.lit("None").alias("fundFamily"),
        _money("c_acctbal").alias("marketCap"),
        F.col("c_custkey").cast("string").alias("uuid"),
    )


def _raw_isin(t: Tables) -> DataFrame:
    return t.orders.select(
        F.concat(F.lit("US"), "o_orderkey").alias("isin"), _customer_name("o_custkey").alias("symbol")
    )


def _raw_major_holders(t: Tables) -> DataFrame:
    insider, institutions, floating, number = S.MAJOR_HOLDER_LABELS
    kind = F.col("event_type")
    return t.events.select(
        _customer_name("user_id").alias("symbol"),
        F.when(kind == "signup", F.concat(F.col("event_id").cast("string"), F.lit(".0")))
        .otherwise(F.concat(_money("value"), F.lit("%")))
        .alias("value"),
        F.when(kind == "click", F.lit(insider))
        .when(kind == "view", F.lit(institutions))
        .when(kind == "purchase", F.lit(floating))
        .when(kind == "signup", F.lit(number))
        .alias("label"),
    )


def _raw_holders(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat(F.lit("Holder"), "l_suppkey").alias("Holder"),
        _money("l_quantity").alias("Shares"),
        F.col("l_shipdate").cast("string").alias("Date Reported"),
        _money("l_discount").alias("% Out"),
        F.col("l_orderkey").cast("string").alias("Value"),
        F.concat(F.lit("P"), "l_partkey").alias("symbol"),
        F.when(F.col("l_returnflag") == "A", F.lit("institutional")).otherwise(F.lit("mutual fund")).alias("holder_type"),
    )


def _raw_options(t: Tables) -> DataFrame:
    return t.part.select(
        F.concat("p_brand", F.lit("-"), "p_size").alias("contractSymbol"),
        F.concat(F.lit("2022-12-"), F.lpad((F.col("p_partkey") % 28 + 1).cast("string"), 2, "0")).alias("lastTradeDate"),
        _money("p_retailprice").alias("strike"),
        F.when(F.col("p_size") < 10, F.lit("NaN")).otherwise(F.col("p_size").cast("string")).alias("openInterest"),
        F.col("p_name").alias("contractSize"),
        F.col("p_partkey").cast("string").alias("lastPrice"),
        F.lit("USD").alias("currency"),
        F.when(F.col("p_type") == "PROMO", F.lit("call")).otherwise(F.lit("put")).alias("option_type"),
        F.col("p_brand").alias("symbol"),
    )


def _raw_analysis(t: Tables) -> DataFrame:
    return t.part.select(
        F.concat("p_size", F.lit("q")).alias("Period"),
        F.lit("1").alias("Max Age"),
        F.col("p_partkey").cast("string").alias("Growth"),
        _money("p_retailprice").alias("Earnings Estimate Avg"),
        F.when(F.col("p_type") != "PROMO", F.col("p_partkey").cast("string")).otherwise(F.lit("bad")).alias("Eps Trend 7Days Ago"),
        F.col("p_size").cast("string").alias("Eps Revisions Up Last7Days"),
        F.col("p_brand").alias("symbol"),
    )


# Metric labels per statement, by the leading digit of the order priority, and the
# columns they are staged in; the fifth label is one no statement knows.
STATEMENT_LABELS = {
    "tickers_balancesheet": ["Total Liab", "Cash", "Good Will", "Inventory", "Some Extra Metric"],
    "tickers_cashflow": ["Change To Netincome", "Investments", "Depreciation", "Net Income", "Some Extra Metric"],
    "tickers_financials": ["Ebit", "Total Revenue", "Net Income", "Gross Profit", "Some Extra Metric"],
}
STATEMENT_COLUMNS = {
    "tickers_balancesheet": ["total_liab", "cash", "good_will", "inventory"],
    "tickers_cashflow": ["change_to_net_income", "investments", "depreciation", "net_income"],
    "tickers_financials": ["ebit", "total_revenue", "net_income", "gross_profit"],
}


def _raw_statement(feed: str):
    def raw(t: Tables) -> DataFrame:
        labels = F.array(*[F.lit(x) for x in STATEMENT_LABELS[feed]])
        label = F.element_at(labels, F.substring("o_orderpriority", 1, 1).cast("int"))
        record = F.create_map(
            F.lit("symbol"), _customer_name("o_custkey"), F.lit("metric"), label,
            day_text("o_orderdate"), _money("o_totalprice"),
        )
        return t.orders.select(F.to_json(record).alias("value"), _period().alias("period"))

    return raw


def _period() -> Column:
    return F.when(F.col("o_orderstatus") == "F", F.lit("year")).otherwise(F.lit("quarter"))


PERIOD_SQL = "case when o_orderstatus = 'F' then 'year' else 'quarter' end"


def _raw_earnings(t: Tables) -> DataFrame:
    yearly = F.col("o_orderstatus") == "F"
    year = F.year("o_orderdate").cast("string")
    return t.orders.select(
        F.when(yearly, year).alias("Year"),
        F.when(~yearly, F.concat(F.quarter("o_orderdate"), F.lit("Q"), year)).alias("Quarter"),
        _money("o_totalprice").alias("Revenue"),
        F.col("o_orderkey").cast("string").alias("Earnings"),
        _period().alias("period"),
        _customer_name("o_custkey").alias("symbol"),
    )


def _raw_eps(t: Tables) -> DataFrame:
    return t.orders.select(
        F.concat(F.col("o_orderdate").cast("string"), F.lit("-04:00")).alias("Earnings Date"),
        _money("o_totalprice").alias("EPS Estimate"),
        F.when(F.col("o_orderstatus") == "P", F.lit("NaN")).otherwise(_money("o_totalprice")).alias("Reported EPS"),
        F.col("o_orderkey").cast("string").alias("Surprise(%)"),
        _customer_name("o_custkey").alias("symbol"),
    )


def _raw_actions(t: Tables) -> DataFrame:
    return t.events.select(
        second_text("ts").alias("Date"),
        _money("value").alias("Dividends"),
        F.col("event_id").cast("string").alias("Stock Splits"),
        F.concat(F.lit("U"), "user_id").alias("symbol"),
    )


def _raw_news(t: Tables) -> DataFrame:
    return t.documents.select(
        F.concat(F.lit("n"), F.floor(F.col("doc_id") / 2)).alias("uuid"),
        F.col("text").alias("title"),
        F.col("source").alias("publisher"),
        F.lit("None").alias("link"),
        (F.col("doc_id") * 61 + 1672531200).cast("string").alias("providerPublishTime"),
        F.lit("STORY").alias("type"),
        F.col("lang").alias("symbol"),
        F.col("n_chars").alias("thumbnail"),
    )


def _raw_recommendations(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderdate").cast("string").alias("Date"),
        F.concat(F.lit("Firm"), F.col("o_orderkey") % 50).alias("Firm"),
        F.col("o_orderpriority").alias("To Grade"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise(F.lit("")).alias("From Grade"),
        F.lit("main").alias("Action"),
        F.concat(F.lit("S"), F.col("o_custkey") % 100).alias("symbol"),
    )


def _raw_shares(t: Tables) -> DataFrame:
    return t.orders.select(
        F.year("o_orderdate").cast("string").alias("Year"),
        F.col("o_orderkey").cast("string").alias("BasicShares"),
        _customer_name("o_custkey").alias("symbol"),
    )


def _raw_prices(t: Tables) -> DataFrame:
    """Two tickers; the second has no bar where the return flag is A."""
    here = F.col("l_returnflag") != "A"
    fields = {"Open": "l_tax", "High": "l_extendedprice", "Low": "l_discount", "Close": "l_quantity"}
    return t.lineitem.select(
        F.col("l_shipdate").alias("ts"),
        F.when(F.col("l_linestatus") == "O", F.lit("1d")).otherwise(F.lit("1h")).alias("interval"),
        *[F.col(c).alias(f"MMM_{f}") for f, c in fields.items()],
        F.col("l_orderkey").cast("double").alias("MMM_Volume"),
        *[F.when(here, F.col(c)).otherwise(float("nan")).alias(f"AOS_{f}") for f, c in fields.items()],
        F.when(here, F.col("l_partkey").cast("double")).alias("AOS_Volume"),
    )


def _tagged_posts(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Posts tagged with their event type, and a universe that lacks one of the types."""
    posts = posts_from_events(t)
    tagged = posts.withColumn("full_text", F.concat(F.lit("#"), "ticker", F.lit(" "), "full_text")).drop("ticker")
    return tagged, t.events.where("event_type <> 'error'").select(F.col("event_type").alias("Symbol"))


def _raw_posts(t: Tables) -> DataFrame:
    tagged, universe = _tagged_posts(t)
    return select_posts(tagged, universe, "full_text", lang=("metadata.iso_language_code", "en"))


RAW = {
    "markets_indexes": _raw_markets,
    "tickers_exchanges": _raw_exchanges,
    "tickers_info": _raw_info,
    "tickers_isin": _raw_isin,
    "tickers_major_holders": _raw_major_holders,
    "tickers_holders": _raw_holders,
    "tickers_options": _raw_options,
    "tickers_analysis": _raw_analysis,
    **{feed: _raw_statement(feed) for feed in STATEMENT_LABELS},
    "tickers_earnings": _raw_earnings,
    "tickers_eps": _raw_eps,
    "tickers_actions": _raw_actions,
    "tickers_news": _raw_news,
    "tickers_recommendations": _raw_recommendations,
    "tickers_shares": _raw_shares,
    "tickers_historical_prices": _raw_prices,
    "tweets": _raw_posts,
}


# -- staged rows as SQL ------------------------------------------------------------


def _statement_sql(feed: str) -> str:
    fields = _fields(S.STAGING[feed])
    picked = {
        name: f"max(cast(o_totalprice as {fields[name]})) filter (o_orderpriority like '{i + 1}%')"
        for i, name in enumerate(STATEMENT_COLUMNS[feed])
    }
    keys = {"date": "strftime(o_orderdate, '%Y-%m-%d')", "symbol": _customer_name_sql("o_custkey"), "period": PERIOD_SQL}
    return f"select {_null_filled(S.STAGING[feed], {**keys, **picked})} from orders group by {', '.join(keys.values())}"


def _major_holders_sql() -> str:
    percent = "max(cast(value as decimal(20,2))) filter (event_type = '{}')"
    names = list(S.MAJOR_HOLDER_LABELS.values())
    expressions = {
        "symbol": _customer_name_sql("user_id"),
        **{n: percent.format(e) for n, e in zip(names, ["click", "view", "purchase"])},
        names[3]: "max(event_id) filter (event_type = 'signup')",
    }
    return f"""select {_null_filled(S.STAGING["tickers_major_holders"], expressions)}
               from events where event_type <> 'error' group by user_id"""


def _prices_sql() -> str:
    shared = """strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as datetime, strftime(l_shipdate, '%Y-%m-%d') as date"""
    values = "l_quantity as close, l_extendedprice as high, l_discount as low, l_tax as open"
    interval = """case when l_linestatus = 'O' then '1d' else '1h' end as "interval\""""
    return f"""select {shared}, 'MMM' as ticker, {values}, cast(l_orderkey as double) as volume, {interval} from lineitem
               union all select {shared}, 'AOS', {values}, cast(l_partkey as double), {interval} from lineitem
               where l_returnflag <> 'A'"""


def _null_filled_from(feed: str, table: str, expressions: dict[str, str]) -> str:
    return f"select {_null_filled(S.STAGING[feed], expressions)} from {table}"


STAGED_SQL = {
    "markets_indexes": """select nullif(p_brand, 'Brand#7') as abbreviation,
        [{'id': cast(p_size as varchar), 'name': p_name}, {'id': null, 'name': p_type}] as "index",
        p_type as market from part""",
    "tickers_exchanges": _null_filled_from("tickers_exchanges", "customer", {
        "exchange": "case when c_mktsegment <> 'FURNITURE' then c_mktsegment || '-' || c_nationkey end",
        "market": "c_mktsegment || '_market'",
    }),
    "tickers_info": _null_filled_from("tickers_info", "customer", {
        "symbol": "c_name", "city": "'City' || (c_custkey % 7)",
        "zip": "case when c_nationkey >= 3 then cast(c_nationkey as varchar) end",
        "industry": "c_mktsegment", "sector": "substring(c_mktsegment, 1, 1)",
        "marketCap": "cast(c_acctbal as decimal(20,2))", "uuid": "c_custkey",
    }),
    "tickers_isin": f"select 'US' || o_orderkey as isin, {_customer_name_sql('o_custkey')} as symbol from orders",
    "tickers_major_holders": _major_holders_sql(),
    "tickers_holders": _null_filled_from("tickers_holders", "lineitem", {
        "symbol": "'P' || l_partkey", "holder": "'Holder' || l_suppkey",
        "holder_type": "case when l_returnflag = 'A' then 'institutional' else 'mutual fund' end",
        "shares": "l_quantity", "date_reported": "strftime(l_shipdate, '%Y-%m-%d')", "out": "l_discount",
        "value": "l_orderkey",
    }),
    "tickers_options": _null_filled_from("tickers_options", "part", {
        "contract_symbol": "p_brand || '-' || p_size",
        "last_trade_date": "'2022-12-' || lpad(cast(p_partkey % 28 + 1 as varchar), 2, '0')",
        "strike": "cast(p_retailprice as decimal(20,2))", "last_price": "p_partkey",
        "open_interest": "case when p_size >= 10 then p_size end", "contract_size": "p_name", "currency": "'USD'",
        "option_type": "case when p_type = 'PROMO' then 'call' else 'put' end", "symbol": "p_brand",
    }),
    "tickers_analysis": _null_filled_from("tickers_analysis", "part", {
        "period": "p_size || 'q'", "growth": "p_partkey", "earnings_estimate_avg": "p_retailprice",
        "eps_trend_7days_ago": "case when p_type <> 'PROMO' then p_partkey end",
        "eps_revisions_up_last7days": "p_size", "symbol": "p_brand",
    }),
    **{feed: _statement_sql(feed) for feed in STATEMENT_LABELS},
    "tickers_earnings": _null_filled_from("tickers_earnings", "orders", {
        "period_detail": """case when o_orderstatus = 'F' then cast(year(o_orderdate) as varchar)
                            else quarter(o_orderdate) || 'Q' || year(o_orderdate) end""",
        "revenue": "o_totalprice", "earnings": "o_orderkey", "period": PERIOD_SQL,
        "symbol": _customer_name_sql("o_custkey"),
    }),
    "tickers_eps": _null_filled_from("tickers_eps", "orders", {
        "earnings_date": "strftime(o_orderdate, '%Y-%m-%d')", "symbol": _customer_name_sql("o_custkey"),
        "eps_estimate": "o_totalprice", "reported_eps": "case when o_orderstatus <> 'P' then o_totalprice end",
        "surprise_ratio": "o_orderkey",
    }),
    "tickers_actions": _null_filled_from("tickers_actions", "events", {
        "date": "date_trunc('second', ts)", "symbol": "'U' || user_id", "dividends": "value", "stock_splits": "event_id",
    }),
    "tickers_news": _null_filled_from("tickers_news", "documents", {
        "uuid": "'n' || (doc_id // 2)", "title": "text", "publisher": "source",
        "provider_publish_time": "doc_id * 61 + 1672531200", "type": "'STORY'", "symbol": "lang",
    }),
    "tickers_recommendations": _null_filled_from("tickers_recommendations", "orders", {
        "date": "strftime(o_orderdate, '%Y-%m-%d')", "firm": "'Firm' || (o_orderkey % 50)",
        "from_grade": "nullif(o_orderstatus, 'P')", "to_grade": "o_orderpriority", "action": "'main'",
        "symbol": "'S' || (o_custkey % 100)",
    }),
    "tickers_shares": _null_filled_from("tickers_shares", "orders", {
        "year": "year(o_orderdate)", "basic_shares": "o_orderkey", "symbol": _customer_name_sql("o_custkey"),
    }),
    "tickers_historical_prices": _prices_sql(),
    "tweets": f"""select * replace ('#' || ticker || ' ' || "text" as "text") from ({FLAT_POSTS_SQL})
                  where ticker <> 'error'""",
}


def staged(t: Tables, feed: str) -> DataFrame:
    spec = FEEDS[feed]
    return spec.shape(RAW[feed](t), spec.schema)


# -- feed queries: arrays and zoned timestamps are shown as text ---------------------


def _shown(df: DataFrame) -> DataFrame:
    def text(name: str, kind: str) -> Column:
        if kind == "array<string>":
            return F.array_join(name, " ").alias(name)
        if kind.startswith("array"):
            ids = F.transform(name, lambda x: F.concat_ws(":", x["id"], x["name"]))
            return F.array_join(ids, " ").alias(name)
        return second_text(name).alias(name) if kind == "timestamp" else F.col(name)

    return df.select(*[text(name, kind) for name, kind in df.dtypes])


SHOWN_SQL = {
    "markets_indexes": """abbreviation, market,
        array_to_string([concat_ws(':', x.id, x.name) for x in "index"], ' ') as "index\"""",
    "tickers_actions": """strftime(date, '%Y-%m-%d %H:%M:%S') as date, * exclude (date)""",
    "tweets": """* exclude (hashtags), array_to_string(hashtags, ' ') as hashtags""",
}


def _register_feed(feed: str) -> None:
    sql = f"select {SHOWN_SQL.get(feed, '*')} from ({STAGED_SQL[feed]})"
    query(f"feed_{feed}", sql)(lambda t: _shown(staged(t, feed)))


for _feed in FEEDS:
    _register_feed(_feed)


# -- feeds through raw files ---------------------------------------------------------


@query(
    "feed_files_statement",
    f"""select * from ({STAGED_SQL["tickers_cashflow"]})
        where symbol in (select c_name from customer where c_acctbal >= 0)""",
)
def feed_files_statement(t: Tables) -> DataFrame:
    """Statement lines in the sibling folders of the raw files, read for the universe of customers that owe nothing."""
    feed, base = FEEDS["tickers_cashflow"], fresh_path(t.spark, "raw")
    lines = RAW[feed.name](t)
    for folder, constants in feed.parts.items():
        lines.where(F.col("period") == constants["period"]).select("value").write.text(f"{base}/{feed.name}/{folder}")
    universe = t.customer.where("c_acctbal >= 0").select(F.col("c_name").alias("Symbol"))
    return read_feed(t.spark, feed, base, universe)


@query("feed_files_posts", f"select {SHOWN_SQL['tweets']} from ({STAGED_SQL['tweets']})")
def feed_files_posts(t: Tables) -> DataFrame:
    """Posts as files of JSON arrays, filtered by language, retweets and universe on reading."""
    feed, base = FEEDS["tweets"], fresh_path(t.spark, "raw")
    posts, universe = _tagged_posts(t)
    write_json_documents(posts, f"{base}/{feed.name}", "source", ["id"])
    return _shown(read_feed(t.spark, feed, base, universe))


# -- entity queries ------------------------------------------------------------------

_MARKETS = """(select abbreviation || '_market' as market, market as country, unnest("index") as i from markets_indexes)"""


def _report_sql(feed: str, columns: str) -> str:
    date = {"tickers_earnings": "period_detail", "tickers_shares": "year"}.get(feed, "date")
    period = "'year'" if feed == "tickers_shares" else "period"
    return f"""select {columns} from (select *, symbol as _ticker, {date} as _date, {period} as _period,
               concat_ws('_', symbol, {date}, {period}) as reporting_id from {feed})"""


def _plain(entity: str, feed: str, where: str = "true") -> str:
    names = ", ".join('symbol as ticker' if c == "ticker" else f'"{c}"' for c in _fields(S.ENTITIES[entity]))
    return f"select {names} from {feed} where {where}"


_REPORTS = ["tickers_financials", "tickers_balancesheet", "tickers_cashflow", "tickers_earnings", "tickers_shares"]

# What a builder projects, before one row per key is kept.
PROJECTED_SQL = {
    "market_indexes_dim": f"select i.id as index_id, i.name as index_name, market from {_MARKETS} where i.id is not null",
    "markets_dim": f"select market, country from {_MARKETS} where i.id is not null",
    "exchanges_dim": _plain("exchanges_dim", "tickers_exchanges", "exchange is not null"),
    "location_dim": _plain("location_dim", "tickers_info", "zip is not null"),
    "sector_dim": _plain("sector_dim", "tickers_info", "industry is not null"),
    "tickers_info_dim": f"""select {", ".join(
        {"ticker": "symbol as ticker", "isin": "i.isin"}.get(c, c if c.startswith(("percentage", "number_of_inst")) else f'tickers_info."{c}"')
        for c in _fields(S.ENTITIES["tickers_info_dim"]))}
        from tickers_info left join (select symbol, max(isin) as isin from tickers_isin group by symbol) i using (symbol)
        left join tickers_major_holders h using (symbol)""",
    "news_dim": _plain("news_dim", "tickers_news"),
    "tickers_news_fact": _plain("tickers_news_fact", "tickers_news"),
    "financial_report_dim": " union all ".join(
        _report_sql(f, "_date as date, _ticker as ticker, _period as period, reporting_id") for f in _REPORTS
    ),
    **{
        f"{f}_fact": _report_sql(f, ", ".join(f'"{c}"' for c in _fields(S.ENTITIES[f"{f}_fact"])))
        for f in _REPORTS
    },
    "tickers_eps_fact": """select concat_ws('_', symbol, earnings_date) as id, symbol as ticker, earnings_date,
        eps_estimate, reported_eps, surprise_ratio from tickers_eps""",
    "tickers_actions_fact": """select concat_ws('_', symbol, strftime(date, '%Y-%m-%d')) as id, dividends,
        stock_splits, symbol as ticker from tickers_actions""",
    "holders_dim": _plain("holders_dim", "tickers_holders"),
    "tickers_holders_fact": _plain("tickers_holders_fact", "tickers_holders"),
    "tickers_analysis_fact": _plain("tickers_analysis_fact", "tickers_analysis"),
    "tickers_recommendations_fact": _plain("tickers_recommendations_fact", "tickers_recommendations"),
    "tickers_options_fact": _plain("tickers_options_fact", "tickers_options"),
    "tickers_historical_prices_fact": "select * from tickers_historical_prices",
    "tweets_dim": f"""select {", ".join(f'"{c}"' for c in _fields(S.ENTITIES["tweets_dim"]))} from tweets""",
    "user_id_dim": """select user_id, user_created_at, user_description,
        max(user_followers_count) over (partition by user_id) as user_followers_count,
        max(friends_count) over (partition by user_id) as friends_count, user_location, user_name, user_verified
        from tweets qualify row_number() over (partition by user_id order by created_at desc, tweet_id desc) = 1""",
    "hashtags_dim": "select unnest(hashtags) as hashtag, tweet_id, null as hashtag_id from tweets",
    "tickers_tweets_users_fact": "select tweet_id, user_id, ticker from tweets",
}


# The key of each entity, and by which columns the latest row of a key is found. Written out
# here, so that the SQL does not take them from the objects that it is to check.
KEYS = {
    "market_indexes_dim": "index_id market",
    "markets_dim": "market",
    "exchanges_dim": "exchange",
    "location_dim": "zip",
    "sector_dim": "industry",
    "tickers_info_dim": "ticker",
    "news_dim": "uuid",
    "tickers_news_fact": "uuid ticker",
    "financial_report_dim": "reporting_id",
    "tickers_financials_fact": "reporting_id",
    "tickers_balancesheet_fact": "reporting_id",
    "tickers_cashflow_fact": "reporting_id",
    "tickers_earnings_fact": "reporting_id",
    "tickers_shares_fact": "reporting_id",
    "tickers_eps_fact": "id",
    "tickers_actions_fact": "id",
    "holders_dim": "holder holder_type",
    "tickers_holders_fact": "ticker holder",
    "tickers_analysis_fact": "ticker period",
    "tickers_recommendations_fact": "ticker firm date",
    "tickers_options_fact": "contract_symbol",
    "tickers_historical_prices_fact": "ticker date datetime interval",
    "tweets_dim": "tweet_id",
    "user_id_dim": "user_id",
    "hashtags_dim": "tweet_id hashtag",
    "tickers_tweets_users_fact": "ticker user_id tweet_id",
}
FIRST_BY = {
    "tickers_eps_fact": "earnings_date", "tickers_holders_fact": "date_reported",
    "tickers_options_fact": "last_trade_date", "tweets_dim": "created_at",
}


def _entity_sql(name: str) -> str:
    feeds = ", ".join(f"{f} as ({STAGED_SQL[f]})" for f in ENTITIES[name].sources)
    columns = list(_fields(S.ENTITIES[name]))
    own, first = KEYS[name].split(), FIRST_BY.get(name, "").split()
    ranking = ", ".join(f'"{c}" desc nulls last' for c in [*first, *[c for c in columns if c not in (*own, *first)]]) or "1"
    keys = ", ".join(f'"{k}"' for k in own)
    shown = ", ".join(f'"{c}"' for c in columns if c != "hashtag_id")
    return f"""with {feeds}, projected as ({PROJECTED_SQL[name]})
               select {shown} from projected
               qualify row_number() over (partition by {keys} order by {ranking}) = 1"""


def _register_entity(name: str) -> None:
    spec = ENTITIES[name]

    def plan(t: Tables) -> DataFrame:
        # The shared dimension only needs the keys of its feeds.
        rows = (lambda f: report_rows(FEEDS[f], RAW[f](t))) if name == "financial_report_dim" else (lambda f: staged(t, f))
        built = spec.merge(None, spec.build({f: rows(f) for f in spec.sources}))
        # The id is a hash that no other engine computes; its tests are elsewhere.
        return built.select(*spec.schema.fieldNames()).drop("hashtag_id")

    query("merge_shared_dim" if name == "financial_report_dim" else f"ent_{name}", _entity_sql(name))(plan)


for _entity in ENTITIES:
    _register_entity(_entity)


# -- updates of stored entities ------------------------------------------------------


def _update_sql(name: str, feed: str, first: str, later: str) -> str:
    """An entity after two builds, of `first` and `later`: staged rows as SQL over the staged rows `feed`."""
    keys = " and ".join(f'later."{k}" is not distinct from first."{k}"' for k in KEYS[name].split())
    built = _entity_sql(name)

    def of(rows: str) -> str:
        return built.replace(f"{feed} as ({STAGED_SQL[feed]})", f"{feed} as ({rows})", 1)

    staged_rows = f"({STAGED_SQL[feed]})"
    return f"""with first as ({of(first.format(staged_rows))}), later as ({of(later.format(staged_rows))})
               select * from later union all select first.* from first where not exists (select 1 from later where {keys})"""


def _updated(t: Tables, name: str, feed: str, first: DataFrame, later: DataFrame) -> DataFrame:
    """The entity that two staged states of its feed leave in a lake."""
    base = fresh_path(t.spark, "lake")
    for number, rows in enumerate((first, later)):
        rows.write.parquet(f"{base}/staged-{number}/{feed}")
        Lake(t.spark, f"{base}/raw", f"{base}/staged-{number}", f"{base}/lake", buckets=16).build([name])
    return Lake(t.spark, f"{base}/raw", f"{base}/staged-1", f"{base}/lake").table(name)


@query(
    "lake_update_news",
    _update_sql(
        "news_dim", "tickers_news", "select * from {}",
        "select * replace ('UPDATE: ' || publisher as publisher) from {} where symbol in ('de', 'fr')",
    ),
)
def lake_update_news(t: Tables) -> DataFrame:
    """News in buckets: all of it, then a second state of what the German and French feeds hold."""
    rows = staged(t, "tickers_news")
    later = rows.where("symbol in ('de', 'fr')").withColumn("publisher", F.concat(F.lit("UPDATE: "), "publisher"))
    return _updated(t, "news_dim", "tickers_news", rows, later)


@query(
    "lake_update_prices",
    _update_sql(
        "tickers_historical_prices_fact", "tickers_historical_prices", "select * from {}",
        "select * replace (close + 1 as close) from {} where date >= '1998-06-01'",
    ),
)
def lake_update_prices(t: Tables) -> DataFrame:
    """Prices by interval and month: all bars, then corrected ones of the newest months."""
    rows = staged(t, "tickers_historical_prices")
    later = rows.where("date >= '1998-06-01'").withColumn("close", F.col("close") + 1)
    return _updated(t, "tickers_historical_prices_fact", "tickers_historical_prices", rows, later)
