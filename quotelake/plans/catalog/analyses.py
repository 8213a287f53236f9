"""Merges, quality reports and per-ticker analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake import schemas as S
from quotelake.functions.times import day_text
from quotelake.operators.merge import merge_co_located, merge_latest
from quotelake.operators.ordering import with_position
from quotelake.operators.quality import lake_report, staging_report
from quotelake.operators.windows import keep_latest
from quotelake.plans import analytics
from quotelake.plans.catalog.registry import Tables, query
from quotelake.session import fresh_path
from quotelake.sources.buckets import BucketedTable
from quotelake.sources.snapshots import LakeTable

# -- merge ---------------------------------------------------------------------


def _balances_from_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("ticker"),
        F.col("o_totalprice").alias("balance"),
        F.col("o_orderstatus").alias("label"),
        F.col("o_orderdate").alias("changed_at"),
        F.col("o_orderkey").alias("change_id"),
    )


@query(
    "merge_first_load",
    """select * exclude (rn) from (select o_custkey as ticker, o_totalprice as balance, o_orderstatus as label,
       o_orderdate as changed_at, o_orderkey as change_id,
       row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders)
       where rn = 1""",
)
def merge_first_load(t: Tables) -> DataFrame:
    return merge_latest(None, _balances_from_orders(t), ["ticker"], ["changed_at", "change_id"])


@query(
    "merge_latest",
    """with incoming as (select * from (select o_custkey as ticker, o_totalprice as balance, o_orderstatus as label,
         o_orderdate as changed_at, o_orderkey as change_id,
         row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders)
         where rn = 1)
       select * exclude (rn) from incoming
       union all
       select c_custkey, c_acctbal, c_mktsegment, cast(null as timestamp), cast(null as bigint) from customer
       where c_custkey not in (select ticker from incoming)""",
)
def merge_latest_keyed(t: Tables) -> DataFrame:
    """Customer balances are replaced by the customer's latest order; others stay."""
    existing = t.customer.select(
        F.col("c_custkey").alias("ticker"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("label")
    )
    existing = existing.withColumns(
        {"changed_at": F.lit(None).cast("timestamp_ntz"), "change_id": F.lit(None).cast("bigint")}
    )
    return merge_latest(
        existing, _balances_from_orders(t), ["ticker"], ["changed_at", "change_id"], existing_is_keyed=True
    )


@query(
    "merge_latest_unkeyed",
    """with both_sides as (
         select l_partkey as ticker, l_shipdate as changed_at, l_orderkey as source_id, l_extendedprice as price,
                0 as batch from lineitem
         union all
         select case when p_type <> 'PROMO' then p_partkey else -p_partkey end, timestamp '1990-01-01', p_size,
                p_retailprice, 1 from part)
       select ticker, changed_at, source_id, price from (select *, row_number() over
         (partition by ticker order by batch desc, changed_at desc, source_id desc, price desc) as rn from both_sides)
       where rn = 1""",
)
def merge_latest_unkeyed(t: Tables) -> DataFrame:
    """The stored side has several rows per key, so both sides are ranked. Some parts get a
    key that the other side does not have."""
    existing = t.lineitem.select(
        F.col("l_partkey").alias("ticker"),
        F.col("l_shipdate").alias("changed_at"),
        F.col("l_orderkey").alias("source_id"),
        F.col("l_extendedprice").alias("price"),
    )
    key = F.when(F.col("p_type") != "PROMO", F.col("p_partkey")).otherwise(-F.col("p_partkey"))
    incoming = t.part.select(
        key.alias("ticker"),
        F.expr("TIMESTAMP_NTZ'1990-01-01 00:00:00'").alias("changed_at"),
        F.col("p_size").cast("bigint").alias("source_id"),
        F.col("p_retailprice").alias("price"),
    )
    return merge_latest(existing, incoming, ["ticker"], ["changed_at", "source_id"])


# -- stored updates --------------------------------------------------------------

BALANCES = "ticker bigint, balance double, label string, changed_at timestamp_ntz, change_id bigint"
VOLUMES = "`symbol` bigint, line int, month string, volume double, price double, batch int"


def _loaded(t: Tables, table: LakeTable, merge, batches: list[DataFrame]) -> DataFrame:
    for batch in batches:
        table.update(t.spark, batch, merge)
    return table.read(t.spark)


@query(
    "merge_stored_update",
    """with changes as (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
         from orders)
       select o_custkey as ticker, o_totalprice as balance, o_orderstatus as label, o_orderdate as changed_at,
         o_orderkey as change_id from changes where rn = 1
       union all
       select c_custkey, c_acctbal, c_mktsegment, null, null from customer
       where c_custkey not in (select o_custkey from orders)""",
)
def merge_stored_update(t: Tables) -> DataFrame:
    """A stored table of balances, loaded from the customers and updated from their orders."""
    table = LakeTable(fresh_path(t.spark, "balances"), S.schema(BALANCES))
    first = t.customer.selectExpr(
        "c_custkey as ticker", "c_acctbal as balance", "c_mktsegment as label",
        "cast(null as timestamp_ntz) as changed_at", "cast(null as bigint) as change_id",
    )

    def merge(stored: DataFrame | None, incoming: DataFrame) -> DataFrame:
        return merge_latest(stored, incoming, ["ticker"], ["changed_at", "change_id"], existing_is_keyed=True)

    return _loaded(t, table, merge, [first, _balances_from_orders(t)])


@query(
    "merge_stored_partitions",
    """with first as (select l_partkey as symbol, l_linenumber as line, strftime(l_shipdate, '%Y-%m') as month,
         l_quantity as volume, l_extendedprice as price, 0 as batch from lineitem
         qualify row_number() over (partition by l_partkey, l_linenumber, strftime(l_shipdate, '%Y-%m')
           order by l_extendedprice desc, l_quantity desc) = 1),
       later as (select l_partkey as symbol, l_linenumber as line, strftime(l_shipdate, '%Y-%m') as month,
         l_quantity as volume, l_discount as price, 1 as batch from lineitem where l_shipdate >= timestamp '1998-06-01'
         qualify row_number() over (partition by l_partkey, l_linenumber, strftime(l_shipdate, '%Y-%m')
           order by l_discount desc, l_quantity desc) = 1)
       select * from later
       union all
       select * from first where (symbol, line, month) not in (select (symbol, line, month) from later)""",
)
def merge_stored_partitions(t: Tables) -> DataFrame:
    """A table stored by month under a key of three columns; the second batch touches its last months only."""
    month = F.substring(day_text("l_shipdate"), 1, 7)
    table = LakeTable(
        fresh_path(t.spark, "volumes"), S.schema(VOLUMES), {"month": lambda: F.col("month")}, ("symbol", "line")
    )

    def batch(number: int, price: str, rows: DataFrame) -> DataFrame:
        return rows.select(
            F.col("l_partkey").alias("symbol"), F.col("l_linenumber").alias("line"), month.alias("month"),
            F.col("l_quantity").alias("volume"), F.col(price).alias("price"), F.lit(number).alias("batch"),
        )

    def merge(stored: DataFrame | None, incoming: DataFrame) -> DataFrame:
        return merge_latest(stored, incoming, ["symbol", "line", "month"], ["price", "volume"], existing_is_keyed=True)

    late = t.lineitem.where("l_shipdate >= timestamp_ntz'1998-06-01 00:00:00'")
    return _loaded(t, table, merge, [batch(0, "l_extendedprice", t.lineitem), batch(1, "l_discount", late)])


NOTES = "`symbol` bigint, line int, price double, label string, batch int"


@query(
    "merge_stored_buckets",
    """with keyed as (select l_partkey as symbol, nullif(l_linenumber, 7) as line, l_extendedprice as price,
         l_returnflag as label, l_linestatus from lineitem),
       first as (select symbol, line, price, label, 0 as batch from keyed
         qualify row_number() over (partition by symbol, line order by price desc, label desc) = 1),
       later as (select symbol, line, price, l_linestatus as label, 1 as batch from keyed where label = 'R'
         qualify row_number() over (partition by symbol, line order by price desc, l_linestatus desc) = 1)
       select * from later
       union all
       select first.* from first where not exists (select 1 from later
         where later.symbol = first.symbol and later.line is not distinct from first.line)""",
)
def merge_stored_buckets(t: Tables) -> DataFrame:
    """A table dealt into buckets by a key of two columns, one of them partly NULL: loaded from all line
    items, and updated from those that came back."""
    keys = ["symbol", "line"]
    table = BucketedTable(fresh_path(t.spark, "notes"), S.schema(NOTES), keys=tuple(keys), buckets=16)

    def batch(number: int, label: str, rows: DataFrame) -> DataFrame:
        return rows.select(
            F.col("l_partkey").alias("symbol"), F.nullif("l_linenumber", F.lit(7)).alias("line"),
            F.col("l_extendedprice").alias("price"), F.col(label).alias("label"), F.lit(number).alias("batch"),
        )

    for rows in (batch(0, "l_returnflag", t.lineitem), batch(1, "l_linestatus", t.lineitem.where("l_returnflag = 'R'"))):
        table.update(
            t.spark, rows, lambda old, new: merge_co_located(old, new, keys), lambda new: keep_latest(new, keys, ["price", "label"])
        )
    return table.read(t.spark)


# -- quality -------------------------------------------------------------------

# The driver tables with the columns that should identify a row.
TABLE_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}


@query(
    "qc_staging_counts",
    " union all ".join(f"select '{n}' as table_name, count(*) as row_count from {n}" for n in TABLE_KEYS),
)
def qc_staging_counts(t: Tables) -> DataFrame:
    return staging_report({name: getattr(t, name) for name in TABLE_KEYS})


@query(
    "qc_lake_report",
    " union all ".join(
        f"""select '{n}' as table_name, cast(sum(n) as bigint) as row_count, count(*) filter (n > 1) as duplicates
            from (select count(*) as n from {n} group by {", ".join(keys)})"""
        for n, keys in TABLE_KEYS.items()
    ),
)
def qc_lake_report(t: Tables) -> DataFrame:
    return lake_report({name: (getattr(t, name), keys) for name, keys in TABLE_KEYS.items()})


# -- analyses ------------------------------------------------------------------


@query(
    "ana_posts_per_day",
    """select strftime(o_orderdate, '%Y-%m-%d') as date, count(*) as cnt
       from orders join customer on o_custkey = c_custkey where c_mktsegment = 'BUILDING' group by 1""",
)
def ana_posts_per_day(t: Tables) -> DataFrame:
    """Orders are the posts, customers the bridge, market segments the tickers."""
    bridge = t.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("ticker"))
    posts = t.orders.select(F.col("o_custkey").alias("custkey"), F.col("o_orderdate").alias("created_at"))
    return analytics.posts_per_day(bridge, posts, "BUILDING", key="custkey")


@query("ana_profile", "select distinct * from customer where c_mktsegment = 'MACHINERY'")
def ana_profile(t: Tables) -> DataFrame:
    return analytics.ticker_profile(t.customer, "MACHINERY", ticker_column="c_mktsegment")


def _bars(t: Tables) -> DataFrame:
    """Lines as price bars: return flags are the tickers, line status the interval."""
    return t.lineitem.select(
        F.col("l_returnflag").alias("ticker"),
        F.col("l_linestatus").alias("interval"),
        day_text("l_shipdate").alias("date"),
        F.col("l_shipdate").alias("datetime"),
        F.col("l_extendedprice").alias("close"),
        F.col("l_quantity").alias("volume"),
        F.col("l_orderkey").alias("bar_id"),
        F.col("l_linenumber").alias("line"),
    )


BAR_ORDER = ("date", "datetime", "bar_id", "line", "close", "volume")


BARS_SQL = """select l_returnflag as ticker, l_linestatus as interval, strftime(l_shipdate, '%Y-%m-%d') as date,
    l_shipdate as datetime, l_extendedprice as close, l_quantity as volume, l_orderkey as bar_id, l_linenumber as line
    from lineitem"""


@query(
    "ana_recent_bars",
    f"""select * from ({BARS_SQL}) where ticker = 'N' and "interval" = 'O'
        order by {", ".join(f"{c} desc" for c in ("date", "datetime", "bar_id", "line", "close", "volume"))} limit 10""",
)
def ana_recent_bars(t: Tables) -> DataFrame:
    return analytics.recent_bars(_bars(t), "N", "O", 10, order_by=BAR_ORDER)


@query(
    "ana_bars_since",
    f"""select *, row_number() over (order by date, datetime, bar_id, line, close, volume) as position
        from ({BARS_SQL}) where ticker = 'R' and "interval" = 'F' and date >= '1998-12-25'""",
)
def ana_bars_since(t: Tables) -> DataFrame:
    return with_position(analytics.bars_since(_bars(t), "R", "F", "1998-12-25", order_by=BAR_ORDER))


@query(
    "ana_news_feed",
    """select doc_id, quality as ticker, toxic, source, lang, text,
       make_timestamp((1672531200 + doc_id * 61) * 1000000) as provider_publish_time,
       row_number() over (order by doc_id desc) as position
       from documents join labels using (doc_id) where quality = 1""",
)
def ana_news_feed(t: Tables) -> DataFrame:
    bridge = t.labels.select("doc_id", F.col("quality").alias("ticker"), "toxic")
    published = (F.col("doc_id") * 61 + 1672531200).cast("string").alias("provider_publish_time")
    news = t.documents.select("doc_id", "source", "lang", "text", published)
    return with_position(analytics.news_feed(bridge, news, 1, key="doc_id"))


@query(
    "ana_price_vs_posts",
    f"""select bars.*, coalesce(cnt, 0) as cnt
        from (select * from ({BARS_SQL}) where ticker = 'N' and "interval" = 'O'
              qualify row_number() over (partition by date
                order by datetime desc, close desc, volume desc, bar_id desc, line desc) = 1
              order by date desc limit 60) as bars left join
          (select strftime(o_orderdate, '%Y-%m-%d') as date, count(*) as cnt
           from orders join customer on o_custkey = c_custkey where c_mktsegment = 'BUILDING' group by 1) using (date)""",
)
def ana_price_vs_posts(t: Tables) -> DataFrame:
    return analytics.price_vs_posts(analytics.daily_bars(_bars(t), "N", "O", 60), ana_posts_per_day(t))
