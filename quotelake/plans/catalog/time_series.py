"""Joins, windows and groups along time, the streams that keep them up to date, and comparisons of states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.operators.aggregates import by_sets, merge_sketches, rollup_sets, sketch
from quotelake.operators.joins import join_within
from quotelake.operators.merge import compare_states
from quotelake.operators.temporal import as_of_join, sessions
from quotelake.operators.windows import framed, tiles
from quotelake.plans.catalog.registry import Tables, query
from quotelake.session import fresh_path
from quotelake.streaming.event_time import Bursts, HourlyPosts

GAP_SECONDS = 1200
EVENTS = "event_id bigint, ts timestamp_ntz, event_type string"


@query(
    "join_as_of",
    """with bars as (
         select user_id, ts, value from events where event_type = 'purchase'
         qualify row_number() over (partition by user_id, ts order by value desc) = 1)
       select e.event_id, e.user_id, e.ts, b.ts as bar_time, b.value as price
       from events as e asof left join bars as b on e.user_id = b.user_id and e.ts >= b.ts
       where e.event_type <> 'purchase'""",
)
def join_as_of(t: Tables) -> DataFrame:
    """The price in force at each event: that of the user's last purchase."""
    bars = t.events.where("event_type = 'purchase'")
    rows = t.events.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    return as_of_join(rows, bars, ["user_id"], "ts", "ts", {"bar_time": "ts", "price": "value"})


def _bursts_sql(closed: str = "true") -> str:
    gap = f"interval {GAP_SECONDS} second"
    return f"""with marked as (
         select event_type, ts, case when ts <= lag(ts) over own + {gap} then 0 else 1 end as begins
         from events where ts is not null window own as (partition by event_type order by ts)),
       numbered as (select *, sum(begins) over (partition by event_type order by ts rows unbounded preceding) as burst from marked)
       select event_type, min(ts) as session_start, max(ts) as session_end, count(*) as n
       from numbered group by event_type, burst having {closed}"""


@query("ses_bursts", _bursts_sql())
def ses_bursts(t: Tables) -> DataFrame:
    """Bursts of events of one type."""
    return sessions(t.events, ["event_type"], "ts", GAP_SECONDS)


@query(
    "join_within",
    """select a.event_id, b.event_id as news_id, a.user_id, a.ts, b.ts as news_ts
       from events as a join events as b on a.user_id = b.user_id and b.event_type = 'error'
         and b.ts between a.ts - interval 2 hour and a.ts + interval 2 hour
       where a.event_type = 'purchase'""",
)
def join_within_two_hours(t: Tables) -> DataFrame:
    """Each purchase with the errors of its user within two hours."""
    news = t.events.where("event_type = 'error'").select(F.col("event_id").alias("news_id"), "user_id", F.col("ts").alias("news_ts"))
    bars = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return join_within(bars, news, ["user_id"], "ts", "news_ts", 7200)


# -- windows -------------------------------------------------------------------------

BARS_SQL = """select l_suppkey as ticker, l_shipdate as ts, l_orderkey as id, l_linenumber as line, l_extendedprice as price,
    cast(l_quantity as bigint) as volume from lineitem"""


def _bars(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").alias("ticker"), F.col("l_shipdate").alias("ts"), F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").cast("bigint").alias("volume"),
    )


@query(
    "win_frames",
    f"""select ticker, ts, id, line, (price - lag(price) over own) / lag(price) over own as change,
          date_diff('day', ts, lead(ts) over own) as days_to_next,
          cast(sum(volume) over (own rows between 4 preceding and current row) as bigint) as volume_5,
          max(price) over (own rows between 2 preceding and 2 following) as high_around
        from ({BARS_SQL}) window own as (partition by ticker order by ts, id, line)""",
)
def win_frames(t: Tables) -> DataFrame:
    """Returns, gaps and moving values of the bars of each ticker."""

    def values(own):
        before = F.lag("price").over(own)
        return {
            "change": (F.col("price") - before) / before,
            "days_to_next": F.date_diff(F.lead("ts").over(own), "ts").cast("bigint"),
            "volume_5": F.sum("volume").over(own.rowsBetween(-4, 0)),
            "high_around": F.max("price").over(own.rowsBetween(-2, 2)),
        }

    found = framed(_bars(t), ["ticker"], ["ts", "id", "line"], F.trunc("ts", "month"), values, before=4, after=2, block_rows=50)
    return found.drop("price", "volume")


@query("win_tiles", f"select ticker, id, line, cast(ntile(7) over (partition by ticker order by price, id, line) as integer) as tile from ({BARS_SQL})")
def win_tiles(t: Tables) -> DataFrame:
    """Sevenths of a ticker's bars by price."""
    return tiles(_bars(t), ["ticker"], ["price", "id", "line"], F.floor(F.col("price") / 1000), 7).select("ticker", "id", "line", "tile")


# -- several groupings, sketches, states ----------------------------------------------


@query(
    "agg_rollup",
    """select n_nationkey, c_mktsegment, o_orderstatus, grouping_id(n_nationkey, c_mktsegment, o_orderstatus)::integer as level,
         count(*) as n, max(o_totalprice) as largest
       from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
       group by rollup (n_nationkey, c_mktsegment, o_orderstatus)""",
)
def agg_rollup(t: Tables) -> DataFrame:
    """Orders by country, segment and state, with all subtotals on the way up."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    stats = {"n": F.count(F.lit(1)), "largest": F.max("o_totalprice")}
    return by_sets(rows, rollup_sets(["n_nationkey", "c_mktsegment", "o_orderstatus"]), stats)


@query(
    "agg_sets",
    """select event_type, user_id, grouping_id(event_type, user_id)::integer as level, count(*) as n, min(ts) as since
       from events group by grouping sets ((event_type, user_id), (event_type), (user_id))""",
)
def agg_sets(t: Tables) -> DataFrame:
    stats = {"n": F.count(F.lit(1)), "since": F.min("ts")}
    return by_sets(t.events, [["event_type", "user_id"], ["event_type"], ["user_id"]], stats)


@query(
    "agg_sketches",
    """select event_type, count(*) as n, count(distinct user_id) as users, true as users_close, true as median_close, true as high_close
       from events where day(ts) between 5 and 25 group by event_type""",
)
def agg_sketches(t: Tables) -> DataFrame:
    """Users and quantiles per type over three weeks, out of stored sketches of single days; the estimates
    are held against the exact values: users within 8 %, ranks of quantiles within 4 %."""
    path = fresh_path(t.spark, "sketches")
    sketch(t.events, ["event_type", F.to_date("ts").alias("day")], "user_id", "value").write.parquet(path)
    stored = t.spark.read.parquet(path).where("day(day) between 5 and 25")
    found = merge_sketches(stored, ["event_type"], {"median": 0.5, "high": 0.9})
    rows = t.events.where("day(ts) between 5 and 25").join(F.broadcast(found.select("event_type", "median", "high")), "event_type")
    share = lambda q: F.count(F.when(F.col("value") <= F.col(q), 1)) / F.count(F.lit(1))
    exact = rows.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"), share("median").alias("at_median"), share("high").alias("at_high")
    )
    both = found.join(exact, "event_type")
    return both.select(
        "event_type", "n", "users", (F.abs(F.col("n_distinct") - F.col("users")) <= 0.08 * F.col("users")).alias("users_close"),
        F.col("at_median").between(0.46, 0.54).alias("median_close"), F.col("at_high").between(0.86, 0.94).alias("high_close"),
    )


@query(
    "set_compare_states",
    """with old as (select o_custkey as ticker, o_orderstatus as label, year(o_orderdate) as since from orders
         where o_orderpriority <> '1-URGENT'),
       new as (select o_custkey as ticker, nullif(o_orderstatus, 'P') as label, year(o_orderdate) as since from orders
         where o_orderpriority <> '5-LOW'),
       bag as (
         select ticker, label, since, sum(o) as o, sum(n) as n from (
           select *, 1 as o, 0 as n from old union all select *, 0, 1 from new) group by all),
       known as (select *, sum(o) over (partition by ticker) as key_o, sum(n) over (partition by ticker) as key_n from bag)
       select case when key_o = 0 then 'added' when key_n = 0 then 'removed' else 'changed' end as change,
         case when n > o then 'new' else 'old' end as side, cast(abs(n - o) as bigint) as times, ticker, label, since
       from known where n <> o""",
)
def set_compare_states(t: Tables) -> DataFrame:
    """Two states of a table with repeated rows and NULLs: all orders but the urgent ones, and all but the low ones."""

    def state(left_out: str, label) -> DataFrame:
        rows = t.orders.where(F.col("o_orderpriority") != left_out)
        return rows.select(F.col("o_custkey").alias("ticker"), label.alias("label"), F.year("o_orderdate").cast("bigint").alias("since"))

    old, new = state("1-URGENT", F.col("o_orderstatus")), state("5-LOW", F.nullif("o_orderstatus", F.lit("P")))
    return compare_states(old, new, ["ticker"])


# -- streams -----------------------------------------------------------------------


def _arriving(t: Tables, stream, arrival) -> DataFrame:
    """`stream` after all events have come, in the parts that `arrival` numbers, one after another."""
    folder = fresh_path(t.spark, "arriving")
    rows = t.events.select("event_id", "ts", "event_type", arrival.cast("int").alias("arrival"))
    parts = fresh_path(t.spark, "parts")
    rows.write.partitionBy("arrival").parquet(parts)
    for number in sorted(r.arrival for r in rows.select("arrival").distinct().collect()):
        part = t.spark.read.schema(EVENTS).parquet(f"{parts}/arrival={number}")
        part.write.mode("append").parquet(folder)
        stream.advance(lambda: t.spark.readStream.schema(EVENTS).parquet(folder))
    return stream.table()


@query(
    "stream_hourly_posts",
    """with arrived as (
         select event_type, ts, (day(ts) - 1) // 8 + case when event_type = 'error' then 1 else 0 end as arrival from events),
       seen as (
         select arrival, max(max(ts)) over (order by arrival rows between unbounded preceding and 1 preceding)
           - interval 4 day as mark from arrived group by arrival),
       judged as (
         select event_type, date_trunc('hour', ts) as hour,
           coalesce(date_trunc('hour', ts) + interval 1 hour <= date_trunc('millisecond', mark), false) as late
         from arrived join seen using (arrival))
       select event_type, cast(hour as timestamp) as hour, cast(count(*) filter (not late) as bigint) as n,
         cast(count(*) filter (late) as bigint) as late
       from judged group by event_type, hour""",
)
def stream_hourly_posts(t: Tables) -> DataFrame:
    """Events per type and hour, which come in parts of eight days, errors one part later: with four days
    of allowed delay some of these are too late and counted apart."""
    arrival = F.floor((F.day("ts") - 1) / 8) + F.when(F.col("event_type") == "error", 1).otherwise(0)
    stream = HourlyPosts(t.spark, fresh_path(t.spark, "hourly"), {"event_type": "string"}, "ts", "4 days")
    return _arriving(t, stream, arrival)


@query(
    "stream_bursts",
    _bursts_sql(f"max(ts) + interval {GAP_SECONDS} second <= (select date_trunc('millisecond', max(ts)) - interval 1 day from events)"),
)
def stream_bursts(t: Tables) -> DataFrame:
    """The same bursts found by a stream over parts of ten days: those that are closed at its end."""
    stream = Bursts(t.spark, fresh_path(t.spark, "bursts"), {"event_type": "string"}, "ts", GAP_SECONDS, "1 day")
    return _arriving(t, stream, F.floor((F.day("ts") - 1) / 10))
