"""Column contracts of the staged feeds and the lake entities."""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T


@cache
def schema(ddl: str) -> T.StructType:
    """The contracts below are DDL texts; parsing one needs a running session."""
    return T.StructType.fromDDL(ddl)


def columns(names: str, type_name: str) -> str:
    """`"a b"` -> `"a <type>, b <type>"`, as DDL."""
    return ", ".join(f"`{n}` {type_name}" for n in names.split())


# ---------------------------------------------------------------------------
# Column names, types and raw labels of the data contract.
# ---------------------------------------------------------------------------

D20 = "decimal(20,2)"
D18 = "decimal(18,2)"

INFO_COLUMNS = """
symbol address1 address2 category city country currency exchange exchangeTimezoneShortName fax
fullTimeEmployees fundFamily fundInceptionDate heldPercentInsiders heldPercentInstitutions industry
isEsgPopulated lastFiscalYearEnd lastSplitDate lastSplitFactor legalType logo_url longBusinessSummary
longName market marketCap marketState mostRecentQuarter nextFiscalYearEnd numberOfAnalystOpinions phone
quoteSourceName quoteType regularMarketSource regularMarketTime sector shortName startDate state
tradeable uuid website zip
"""

BALANCESHEET_METRICS = """
intangible_assets capital_surplus total_liab total_stockholder_equity minority_interest
other_current_liab total_assets common_stock other_current_assets retained_earnings other_liab
good_will treasury_stock other_assets cash total_current_liabilities deferred_long_term_asset_charges
short_long_term_debt other_stockholder_equity property_plant_equipment total_current_assets
long_term_investments net_tangible_asset short_term_investments net_receivables long_term_debt
inventory deferred_long_term_liab accounts_payable
"""

CASHFLOW_METRICS = """
investments change_to_liabilities total_cashflows_from_investing_activities net_borrowings
total_cash_from_financing_activities issuance_of_stock net_income change_in_cash repurchase_of_stock
effect_of_exchange_rate total_cash_from_operating_activities depreciation
other_cashflows_from_investing_activities dividends_paid change_to_inventory
change_to_account_receivables other_cashflows_from_financing_activities change_to_net_income
capital_expenditures change_to_operating_activities
"""

FINANCIALS_METRICS = """
research_development effect_of_accounting_charges income_before_tax minority_interest net_income
selling_general_administrative gross_profit ebit operating_income other_operating_expenses
interest_expense extraordinary_items non_recurring other_items income_tax_expense total_revenue
total_operating_expenses cost_of_revenue total_other_income_expense_net discontinued_operations
net_income_from_continuing_ops net_income_applicable_to_common_shares
"""

# The ten statement metrics with the narrower decimal.
NARROW_METRICS = """
total_liab other_current_liab other_current_assets good_will cash
income_before_tax selling_general_administrative operating_income extraordinary_items income_tax_expense
"""

ANALYSIS_METRICS = """
earnings_estimate_avg earnings_estimate_low earnings_estimate_high earnings_estimate_year_ago_eps
earnings_estimate_number_of_analysts earnings_estimate_growth revenue_estimate_avg
revenue_estimate_low revenue_estimate_high eps_trend_current eps_trend_7days_ago
eps_trend_30days_ago eps_trend_60days_ago eps_trend_90days_ago eps_revisions_up_last7days
eps_revisions_up_last30days eps_revisions_down_last30days eps_revisions_down_last90days
"""

OPTION_COLUMNS = """
contract_symbol last_trade_date strike last_price bid ask change percent_change volume open_interest
implied_volatility in_the_money contract_size currency option_type
"""

# Raw label -> column, where the snake_case rule alone does not give the column.
MAJOR_HOLDER_LABELS = {
    "% of Shares Held by All Insider": "percentage_of_shares_held_by_all_insider",
    "% of Shares Held by Institutions": "percentage_of_shares_held_by_institutions",
    "% of Float Held by Institutions": "percentage_of_float_held_by_institutions",
    "Number of Institutions Holding Shares": "number_of_institutions_holding_shares",
}
CASHFLOW_LABELS = {"Change To Netincome": "change_to_net_income"}
HOLDERS_LABELS = {"% Out": "out"}
EPS_LABELS = {"Surprise(%)": "surprise_ratio"}

# Sibling feeds: raw subfolder -> constant columns its rows get.
YEAR_AND_QUARTER = {"yearly": {"period": "year"}, "quarterly": {"period": "quarter"}}
HOLDER_TYPES = {"institutional": {"holder_type": "institutional"}, "mutualfund": {"holder_type": "mutual fund"}}
OPTION_TYPES = {"calls": {"option_type": "call"}, "puts": {"option_type": "put"}}
PRICE_INTERVALS = {"1m": {"interval": "1m"}, "1d": {"interval": "1d"}, "1h": {"interval": "1h"}}
PRICE_FIELDS = ["Open", "High", "Low", "Close", "Volume"]
MARKET_SUFFIX = "_market"

INFO_DIM_COLUMNS = """
ticker industry zip currency isin exchange fullTimeEmployees fundFamily fundInceptionDate
isEsgPopulated lastFiscalYearEnd lastSplitDate lastSplitFactor longBusinessSummary longName marketCap
mostRecentQuarter nextFiscalYearEnd numberOfAnalystOpinions quoteType shortName startDate uuid
"""

MAJOR_HOLDER_COLUMNS = (
    f"percentage_of_shares_held_by_all_insider {D20}, percentage_of_shares_held_by_institutions {D20}, "
    f"percentage_of_float_held_by_institutions {D20}, number_of_institutions_holding_shares int"
)


def _metrics(names: str) -> str:
    narrow = set(NARROW_METRICS.split())
    return ", ".join(f"{n} {D18 if n in narrow else D20}" for n in names.split())


# Raw payloads that are more than the staged columns under raw names.
MARKETS_RAW = "abbreviation string, index array<struct<id: string, name: string>>, market string"
EXCHANGES_RAW = "exchange string, market string"
STATEMENT_RAW_IDS = ("symbol", "metric")
MAJOR_HOLDERS_RAW = "symbol string, value string, label string"
POSTS_RAW = (
    "id bigint, created_at string, in_reply_to_status_id bigint, truncated boolean, full_text string, "
    "entities struct<hashtags: array<struct<text: string>>>, metadata struct<iso_language_code: string>, "
    "retweet_count bigint, source string, source_url string, "
    "user struct<id: bigint, name: string, location: string, description: string, verified: boolean, "
    "followers_count: bigint, friends_count: bigint, created_at: string>"
)

STAGING = {
    "markets_indexes": MARKETS_RAW,
    "tickers_exchanges": EXCHANGES_RAW,
    "tickers_info": columns(INFO_COLUMNS, "string"),
    "tickers_isin": "isin string, symbol string",
    "tickers_major_holders": f"symbol string, {MAJOR_HOLDER_COLUMNS}",
    "tickers_holders": (
        f"symbol string, holder string, holder_type string, shares {D20}, date_reported string, out {D20}, value bigint"
    ),
    "tickers_options": columns(OPTION_COLUMNS + " symbol", "string"),
    "tickers_analysis": (
        f"period string, growth double, {columns(ANALYSIS_METRICS, D20)}, symbol string"
    ),
    "tickers_balancesheet": f"date string, symbol string, period string, {_metrics(BALANCESHEET_METRICS)}",
    "tickers_cashflow": f"date string, symbol string, period string, {_metrics(CASHFLOW_METRICS)}",
    "tickers_financials": f"date string, symbol string, period string, {_metrics(FINANCIALS_METRICS)}",
    "tickers_earnings": (
        f"period_detail string, revenue {D20}, earnings {D20}, period string, symbol string"
    ),
    "tickers_eps": (
        f"earnings_date string, symbol string, eps_estimate {D20}, reported_eps {D20}, surprise_ratio {D20}"
    ),
    "tickers_actions": f"date timestamp, symbol string, dividends {D20}, stock_splits {D20}",
    "tickers_news": columns("uuid title publisher link provider_publish_time type symbol", "string"),
    "tickers_recommendations": columns("date firm from_grade to_grade action symbol", "string"),
    "tickers_shares": "year string, basic_shares bigint, symbol string",
    "tickers_historical_prices": (
        "datetime string, date string, ticker string, close double, high double, low double, open double, "
        "volume double, interval string"
    ),
    "tweets": (
        "ticker string, tweet_id bigint, created_at string, in_reply_to_status_id bigint, truncated boolean, "
        "hashtags array<string>, text string, lang string, retweet_count bigint, source string, source_url string, "
        "user_id bigint, user_name string, user_location string, user_description string, user_verified boolean, "
        "user_followers_count bigint, friends_count bigint, user_created_at string"
    ),
}

ENTITIES = {
    "market_indexes_dim": "index_id string, index_name string, market string",
    "markets_dim": "market string, country string",
    "exchanges_dim": "exchange string, market string",
    "location_dim": "city string, state string, country string, zip string",
    "sector_dim": "industry string, sector string",
    "tickers_info_dim": f"{columns(INFO_DIM_COLUMNS, 'string')}, {MAJOR_HOLDER_COLUMNS}",
    "news_dim": columns("uuid title publisher link provider_publish_time type", "string"),
    "tickers_news_fact": "uuid string, ticker string",
    "financial_report_dim": "date string, ticker string, period string, reporting_id string",
    "tickers_financials_fact": f"reporting_id string, {_metrics(FINANCIALS_METRICS)}",
    "tickers_balancesheet_fact": f"reporting_id string, {_metrics(BALANCESHEET_METRICS)}",
    "tickers_cashflow_fact": f"reporting_id string, {_metrics(CASHFLOW_METRICS)}",
    "tickers_earnings_fact": f"reporting_id string, revenue {D20}, earnings {D20}",
    "tickers_shares_fact": "reporting_id string, basic_shares bigint",
    "tickers_eps_fact": (
        f"id string, ticker string, earnings_date string, eps_estimate {D20}, reported_eps {D20}, surprise_ratio {D20}"
    ),
    "tickers_actions_fact": f"id string, dividends {D20}, stock_splits {D20}, ticker string",
    "holders_dim": "holder string, holder_type string",
    "tickers_holders_fact": (
        f"ticker string, holder string, shares {D20}, date_reported string, out {D20}, value bigint"
    ),
    "tickers_analysis_fact": f"ticker string, period string, growth double, {columns(ANALYSIS_METRICS, D20)}",
    "tickers_recommendations_fact": columns("firm ticker date from_grade to_grade action", "string"),
    "tickers_options_fact": columns(OPTION_COLUMNS + " ticker", "string"),
    "tickers_historical_prices_fact": (
        "datetime string, date string, ticker string, close double, high double, low double, open double, "
        "volume double, interval string"
    ),
    "tweets_dim": (
        "tweet_id bigint, created_at string, lang string, source string, source_url string, text string, "
        "in_reply_to_status_id bigint, truncated boolean"
    ),
    "user_id_dim": (
        "user_id bigint, user_created_at string, user_description string, user_followers_count bigint, "
        "friends_count bigint, user_location string, user_name string, user_verified boolean"
    ),
    "hashtags_dim": "hashtag string, tweet_id bigint, hashtag_id bigint",
    "tickers_tweets_users_fact": "tweet_id bigint, user_id bigint, ticker string",
}


def staging_schema(feed: str) -> T.StructType:
    return schema(STAGING[feed])


def entity_schema(entity: str) -> T.StructType:
    return schema(ENTITIES[entity])
