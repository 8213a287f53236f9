"""Joins, aggregates, windows, sorting, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.times import day_text
from quotelake.operators import aggregates, joins, merge, ordering, windows
from quotelake.plans.catalog.registry import Tables, query

# -- joins ---------------------------------------------------------------------


def _customer_with_nation(t: Tables) -> DataFrame:
    # Nations of one region get other keys, so that some customers find no nation.
    key = F.when(F.col("n_regionkey") == 0, -1 - F.col("n_nationkey")).otherwise(F.col("n_nationkey"))
    nations = t.nation.select(key.alias("c_nationkey"), "n_name")
    return joins.enrich(
        t.customer.select("c_custkey", "c_name", "c_nationkey"), nations, "c_nationkey", ["n_name"], keyed_is_unique=True
    )


@query(
    "join_left_enrich",
    """select c_custkey, c_name, c_nationkey, n_name
       from customer left join (select * from nation where n_regionkey <> 0) on c_nationkey = n_nationkey""",
)
def join_left_enrich(t: Tables) -> DataFrame:
    return _customer_with_nation(t)


@query(
    "join_left_chain",
    """select distinct c_custkey, c_name, c_nationkey, n_name, orders, last_day
       from customer left join (select * from nation where n_regionkey <> 0) on c_nationkey = n_nationkey
       left join (select o_custkey, count(*) as orders, max(strftime(o_orderdate, '%Y-%m-%d')) as last_day
                  from orders group by o_custkey) on c_custkey = o_custkey""",
)
def join_left_chain(t: Tables) -> DataFrame:
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("orders"), day_text(F.max("o_orderdate")).alias("last_day")
    )
    chained = joins.enrich(
        _customer_with_nation(t), per_customer, "c_custkey", ["orders", "last_day"], keyed_is_unique=True
    )
    return aggregates.distinct_rows(chained)


@query(
    "join_inner_using",
    """select o_custkey as custkey, o_orderkey, o_totalprice, c_name, c_mktsegment
       from orders join customer on o_custkey = c_custkey""",
)
def join_inner_using(t: Tables) -> DataFrame:
    bridge = t.orders.select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    return joins.join_using(bridge, t.customer.select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment"), "custkey")


@query(
    "join_inner_bridge",
    "select doc_id, quality, toxic, lang, source, n_chars from documents join labels using (doc_id)",
)
def join_inner_bridge(t: Tables) -> DataFrame:
    return joins.join_using(t.labels, t.documents.select("doc_id", "lang", "source", "n_chars"), "doc_id")


# -- aggregates ----------------------------------------------------------------


@query("agg_row_count", "select count(*) as row_count from lineitem")
def agg_row_count(t: Tables) -> DataFrame:
    return aggregates.row_count(t.lineitem)


@query(
    "agg_daily_count",
    "select strftime(l_shipdate, '%Y-%m-%d') as date, count(*) as cnt from lineitem group by 1",
)
def agg_daily_count(t: Tables) -> DataFrame:
    return aggregates.count_by(t.lineitem, day_text("l_shipdate"), "date")


@query(
    "agg_duplicate_keys",
    """select l_orderkey, l_linenumber, count(*) as cnt from lineitem
       group by l_orderkey, l_linenumber having count(*) > 1""",
)
def agg_duplicate_keys(t: Tables) -> DataFrame:
    return aggregates.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "agg_duplicate_group_count",
    """select count(*) as duplicates from
       (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)""",
)
def agg_duplicate_group_count(t: Tables) -> DataFrame:
    return aggregates.duplicate_group_count(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("agg_distinct", "select distinct l_returnflag, l_linestatus, l_shipdate from lineitem")
def agg_distinct(t: Tables) -> DataFrame:
    return aggregates.distinct_rows(t.lineitem, "l_returnflag", "l_linestatus", "l_shipdate")


@query("agg_drop_duplicates", "select distinct text, lang from documents")
def agg_drop_duplicates(t: Tables) -> DataFrame:
    return aggregates.distinct_rows(t.documents, "text", "lang")


@query(
    "agg_string_join",
    """select string_agg(p_name, ' ' order by p_name) as symbols
       from (select distinct p_name from part order by p_name limit 505)""",
)
def agg_string_join(t: Tables) -> DataFrame:
    return aggregates.join_symbols(aggregates.distinct_rows(t.part, "p_name"), "p_name", 505)


# -- windows -------------------------------------------------------------------


@query(
    "win_row_number",
    """select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) as row_number
       from events""",
)
def win_row_number(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "user_id", "ts")
    numbered = windows.number_rows(events, ["user_id"], ["ts", "event_id"], bucket=F.col("ts").cast("date"))
    return numbered.drop("ts")


@query(
    "win_keep_latest",
    """select * exclude (rn) from
       (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events)
       where rn = 1""",
)
def win_keep_latest(t: Tables) -> DataFrame:
    return windows.keep_latest(t.events, ["user_id"], ["ts", "event_id"])


@query(
    "win_partition_max",
    """select event_id, user_id, max(value) over (partition by user_id) as value,
       count(*) over (partition by user_id) as posts from events""",
)
def win_partition_max(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "user_id", "value")
    return windows.with_group_stats(events, ["user_id"], {"value": F.max("value"), "posts": F.count("*")})


# -- sorting -------------------------------------------------------------------


@query(
    "srt_asc",
    "select o_orderkey, o_orderdate, row_number() over (order by o_orderdate, o_orderkey) as position from orders",
)
def srt_asc(t: Tables) -> DataFrame:
    return ordering.with_position(ordering.sort_asc(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey"))


@query(
    "srt_multi",
    """select l_shipdate, l_orderkey, l_linenumber, l_extendedprice, row_number() over
       (order by l_shipdate, l_orderkey, l_linenumber, l_extendedprice) as position from lineitem""",
)
def srt_multi(t: Tables) -> DataFrame:
    columns = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"]
    return ordering.with_position(ordering.sort_asc(t.lineitem.select(*columns), *columns))


@query("srt_desc", "select event_id, ts, value, row_number() over (order by ts desc, event_id desc) as position from events")
def srt_desc(t: Tables) -> DataFrame:
    return ordering.with_position(ordering.sort_desc(t.events.select("event_id", "ts", "value"), "ts", "event_id"))


@query(
    "top_latest_n",
    """select o_orderdate, o_orderkey, o_totalprice from orders
       order by o_orderdate desc, o_orderkey desc limit 10""",
)
def top_latest_n(t: Tables) -> DataFrame:
    return ordering.latest_n(t.orders.select("o_orderdate", "o_orderkey", "o_totalprice"), 10, ["o_orderdate", "o_orderkey"])


# -- set operations ------------------------------------------------------------


@query(
    "set_union_distinct",
    """select c_nationkey as nationkey, c_mktsegment as segment from customer
       union select s_nationkey, cast(null as varchar) from supplier""",
)
def set_union_distinct(t: Tables) -> DataFrame:
    old = t.customer.select(F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"))
    return merge.union_distinct(old, t.supplier.select(F.col("s_nationkey").alias("nationkey")))


@query(
    "set_union_all_tagged",
    """select 'customer' as kind, c_custkey as id, c_name as name, c_acctbal as balance from customer
       union all select 'supplier', s_suppkey, s_name, s_acctbal from supplier""",
)
def set_union_all_tagged(t: Tables) -> DataFrame:
    customers = t.customer.selectExpr("c_custkey as id", "c_name as name", "c_acctbal as balance")
    suppliers = t.supplier.selectExpr("s_name as name", "s_acctbal as balance", "s_suppkey as id")
    return merge.union_tagged({"customer": customers, "supplier": suppliers}, "kind")
