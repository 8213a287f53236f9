"""Projections, typing, keys, text and time functions, row filters, reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake import schemas as S
from quotelake.functions.keys import composite_key, concat_key, stable_id
from quotelake.functions.text import parse_percent, to_number
from quotelake.functions.times import day_text, epoch_to_timestamp, second_text, text_to_day
from quotelake.operators import filters, projection, reshape
from quotelake.plans.catalog.registry import Tables, query

# -- projections ---------------------------------------------------------------


@query("prj_select_alias", "select c_custkey as ticker, c_name, c_mktsegment as sector from customer")
def prj_select_alias(t: Tables) -> DataFrame:
    return projection.select_as(t.customer, ("c_custkey", "ticker"), "c_name", ("c_mktsegment", "sector"))


@query(
    "prj_rename_drop",
    "select s_suppkey as ticker, s_name, s_nationkey, s_acctbal from supplier",
)
def prj_rename_drop(t: Tables) -> DataFrame:
    return projection.rename(t.supplier, {"s_suppkey": "ticker"})


@query(
    "prj_case_rename",
    """select o_orderkey as "O_OrderKey", o_custkey as "O_CustKey", o_orderstatus, o_totalprice as "O_TotalPrice",
       o_orderdate, o_orderpriority from orders""",
)
def prj_case_rename(t: Tables) -> DataFrame:
    names = {"o_orderkey": "O_OrderKey", "o_custkey": "O_CustKey", "o_totalprice": "O_TotalPrice"}
    return projection.rename(t.orders, names)


@query(
    "prj_snake_case",
    """select c_custkey as cust_key, c_name as cust_name, c_nationkey as nation_key, c_acctbal as acct_ratio,
       c_mktsegment as mkt_segment_7days from customer""",
)
def prj_snake_case(t: Tables) -> DataFrame:
    titled = t.customer.toDF("Cust Key", "custName", "Nation-Key", "Acct(%)", "mktSegment 7Days")
    return projection.snake_case_columns(titled, {"Acct(%)": "acct_ratio"})


@query("prj_constant_tag", "select o_orderkey, 'year' as period, '_market' as suffix from orders")
def prj_constant_tag(t: Tables) -> DataFrame:
    return projection.add_constants(t.orders.select("o_orderkey"), {"period": "year", "suffix": "_market"})


@query(
    "prj_conform",
    """select o_orderpriority, cast(null as varchar) as o_clerk, o_orderkey, cast(null as double) as o_discount,
       cast(o_custkey as varchar) as o_custkey from orders""",
)
def prj_conform(t: Tables) -> DataFrame:
    target = S.schema("o_orderpriority string, o_clerk string, o_orderkey bigint, o_discount double, o_custkey string")
    return projection.conform(t.orders, target)


@query(
    "cast_decimal",
    """select o_orderkey, o_custkey, cast(o_totalprice as decimal(20,2)) as price_20,
       cast(o_totalprice as decimal(18,2)) as price_18 from orders""",
)
def cast_decimal(t: Tables) -> DataFrame:
    prices = t.orders.select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").alias("price_20"), F.col("o_totalprice").alias("price_18")
    )
    return projection.cast_columns(prices, {"price_20": S.D20, "price_18": S.D18})


@query(
    "cast_numeric_text",
    """select event_id, case when event_type in ('error', 'view', 'signup') or event_id % 4 = 3 then null
       when event_id % 4 = 2 then user_id * 1000 else user_id end::bigint as number from events""",
)
def cast_numeric_text(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.lit("NaN"))
        .when(kind == "view", F.concat(F.lit("x"), "user_id"))
        .when(kind == "signup", F.lit(""))
        .when(F.col("event_id") % 4 == 1, F.concat("user_id", F.lit(".0")))
        .when(F.col("event_id") % 4 == 2, F.concat("user_id", F.lit("e3")))
        .when(F.col("event_id") % 4 == 3, F.concat("user_id", F.lit(".5")))
        .otherwise(F.col("user_id").cast("string"))
    )
    return t.events.select("event_id", to_number(text, "bigint").alias("number"))


@query(
    "key_composite",
    """select o_orderkey, concat_ws('_', o_custkey, strftime(o_orderdate, '%Y-%m-%d'), nullif(o_orderstatus, 'P')) as id,
       case when o_orderstatus <> 'P'
            then concat_ws('_', o_custkey, strftime(o_orderdate, '%Y-%m-%d'), o_orderstatus) end as strict_id
       from orders""",
)
def key_composite(t: Tables) -> DataFrame:
    parts = ["o_custkey", day_text("o_orderdate"), F.nullif("o_orderstatus", F.lit("P"))]
    return t.orders.select(
        "o_orderkey", composite_key(*parts).alias("id"), composite_key(*parts, strict=True).alias("strict_id")
    )


@query(
    "key_concat",
    """select c_custkey, case when c_mktsegment <> 'BUILDING' then c_mktsegment || '_market' end as market
       from customer""",
)
def key_concat(t: Tables) -> DataFrame:
    abbreviation = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return t.customer.select("c_custkey", concat_key(abbreviation, F.lit(S.MARKET_SUFFIX)).alias("market"))


@query(
    "key_surrogate",
    """select event_type, count(distinct user_id) as keys, count(distinct user_id) as ids
       from events group by event_type""",
)
def key_surrogate(t: Tables) -> DataFrame:
    """Ids differ between engines, so the check is that ids and keys match one to one."""
    keyed = t.events.select("event_type", "user_id", stable_id("event_type", "user_id").alias("id")).distinct()
    return keyed.groupBy("event_type").agg(F.count("*").alias("keys"), F.count_distinct("id").alias("ids"))


def posts_from_events(t: Tables) -> DataFrame:
    """The events as nested post records."""
    return t.events.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("created_at"),
        F.lit(None).cast("bigint").alias("in_reply_to_status_id"),
        (F.col("value") > 100).alias("truncated"),
        F.col("props").alias("full_text"),
        F.struct(
            F.array(F.struct(F.col("event_type").alias("text")), F.struct(F.lit("all").alias("text"))).alias("hashtags")
        ).alias("entities"),
        F.struct(F.lit("en").alias("iso_language_code")).alias("metadata"),
        F.col("user_id").alias("retweet_count"),
        F.lit("web").alias("source"),
        F.lit("http://post").alias("source_url"),
        F.struct(
            F.col("user_id").alias("id"),
            F.concat(F.lit("user_"), "user_id").alias("name"),
            F.lit(None).cast("string").alias("location"),
            F.col("event_type").alias("description"),
            (F.col("event_type") == "signup").alias("verified"),
            (F.col("event_id") * 7 % 1009).alias("followers_count"),
            (F.col("event_id") * 11 % 997).alias("friends_count"),
            F.col("ts").alias("created_at"),
        ).alias("user"),
        F.col("event_type").alias("ticker"),
    )


FLAT_POSTS_SQL = """select event_type as ticker, event_id as tweet_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S') as created_at, cast(null as bigint) as in_reply_to_status_id,
    value > 100 as truncated, [event_type, 'all'] as hashtags, props as "text", 'en' as lang,
    user_id as retweet_count, 'web' as source, 'http://post' as source_url, user_id,
    'user_' || user_id as user_name, cast(null as varchar) as user_location, event_type as user_description,
    event_type = 'signup' as user_verified, event_id * 7 % 1009 as user_followers_count,
    event_id * 11 % 997 as friends_count, strftime(ts, '%Y-%m-%d') as user_created_at from events"""


@query(
    "prj_flatten_nested",
    f"select * exclude (hashtags), array_to_string(hashtags, ' ') as hashtags from ({FLAT_POSTS_SQL})",
)
def prj_flatten_nested(t: Tables) -> DataFrame:
    flat = projection.flatten_posts(posts_from_events(t))
    return flat.withColumn("hashtags", F.array_join("hashtags", " "))


# -- text and time -------------------------------------------------------------


@query(
    "str_percent_to_number",
    """select event_id, case when event_type <> 'error' then cast(value as decimal(20,2)) end as ratio from events""",
)
def str_percent_to_number(t: Tables) -> DataFrame:
    shown = F.concat(F.col("value").cast(S.D20).cast("string"), F.lit("%"))
    text = F.when(F.col("event_type") == "error", F.lit("n/a%")).otherwise(shown)
    return t.events.select("event_id", parse_percent(text, S.D20).alias("ratio"))


@query(
    "dat_format",
    """select event_id, strftime(ts, '%Y-%m-%d') as day, strftime(ts, '%Y-%m-%d %H:%M:%S') as second,
       case when event_type not in ('error', 'view') then strftime(ts, '%Y-%m-%d %H:%M:%S') end as of_text from events""",
)
def dat_format(t: Tables) -> DataFrame:
    """Of texts: ISO ones with a zone, and some that are no times."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", "garbage text that is long")
        .when(kind == "view", "Tue Oct 10 20:19:24 +0000 2018")
        .otherwise(F.concat(F.translate(F.col("ts").cast("string"), " ", "T"), F.lit("+05:00")))
    )
    return t.events.select(
        "event_id", day_text("ts").alias("day"), second_text("ts").alias("second"), second_text(text).alias("of_text")
    )


@query(
    "dat_text_to_day",
    """select event_id, case when event_type <> 'error' then strftime(ts, '%Y-%m-%d') end as day from events""",
)
def dat_text_to_day(t: Tables) -> DataFrame:
    text = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(second_text("ts"))
    return t.events.select("event_id", text_to_day(text).alias("day"))


@query(
    "dat_epoch",
    """select event_id, case when event_type <> 'error'
       then make_timestamp((1672531200 + event_id * 61) * 1000000) end as published from events""",
)
def dat_epoch(t: Tables) -> DataFrame:
    seconds = (F.col("event_id") * 61 + 1672531200).cast("string")
    text = F.when(F.col("event_type") == "error", F.lit("None")).otherwise(seconds)
    return t.events.select("event_id", epoch_to_timestamp(text).alias("published"))


# -- filters -------------------------------------------------------------------


@query(
    "fil_not_null",
    """select doc_id, source, quality from documents left join labels using (doc_id) where quality is not null""",
)
def fil_not_null(t: Tables) -> DataFrame:
    labelled = t.documents.select("doc_id", "source").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return filters.not_null(labelled, "quality")


@query("fil_equals", "select * from customer where c_mktsegment = 'BUILDING'")
def fil_equals(t: Tables) -> DataFrame:
    return filters.equals(t.customer, c_mktsegment="BUILDING")


@query(
    "fil_conjunction",
    "select l_orderkey, l_linenumber, l_partkey from lineitem where l_returnflag = 'A' and l_linestatus = 'F'",
)
def fil_conjunction(t: Tables) -> DataFrame:
    kept = filters.equals(t.lineitem, l_returnflag="A", l_linestatus="F")
    return kept.select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "fil_date_range",
    "select l_orderkey, l_linenumber, l_shipdate from lineitem where l_shipdate >= timestamp '1998-12-25'",
)
def fil_date_range(t: Tables) -> DataFrame:
    kept = filters.since(t.lineitem, "l_shipdate", F.expr("TIMESTAMP_NTZ'1998-12-25 00:00:00'"))
    return kept.select("l_orderkey", "l_linenumber", "l_shipdate")


@query(
    "fil_nonempty_payload",
    """select doc_id, len(regexp_extract_all(text, '[0-9]+')) as numbers, quality
       from documents left join labels using (doc_id)
       where len(regexp_extract_all(text, '[0-9]+')) > 0 and quality is not null""",
)
def fil_nonempty_payload(t: Tables) -> DataFrame:
    found = t.documents.select("doc_id", F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0)).alias("payload"))
    labelled = found.join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    kept = filters.nonempty_payload(labelled, "payload", "quality")
    return kept.select("doc_id", F.size("payload").cast("bigint").alias("numbers"), "quality")


@query(
    "fil_post_selection",
    """with symbols as (select distinct upper(unnest(regexp_extract_all(text, '[A-Za-z]+'))) as symbol from benchmark),
       tags as (select distinct doc_id, upper(unnest(regexp_extract_all(text, '([A-Za-z]+)\\.', 1))) as symbol
                from documents where lang = 'en' and not regexp_matches(text, '^The '))
       select doc_id, symbol as ticker from tags join symbols using (symbol)""",
)
def fil_post_selection(t: Tables) -> DataFrame:
    """The last words of sentences play the hashtags, the benchmark words the universe."""
    words = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    universe = t.benchmark.select(F.explode(words).alias("word")).select(F.upper("word").alias("Symbol"))
    tagged = filters.select_posts(
        t.documents, universe, "text", lang=("lang", "en"), tag_patterns=(r"([A-Za-z]+)\.",), retweet_pattern="^The "
    )
    return tagged.select("doc_id", "ticker")


# -- reshaping -----------------------------------------------------------------


@query(
    "shp_stack",
    """select l_orderkey, l_linenumber, l_partkey, 'gross' as ticker, l_extendedprice as "Price", l_tax as "Rate"
       from lineitem
       union all
       select l_orderkey, l_linenumber, l_partkey, 'open', case when l_linestatus = 'O' then l_quantity end, l_discount
       from lineitem where l_linestatus = 'O' or l_returnflag <> 'A'""",
)
def shp_stack(t: Tables) -> DataFrame:
    """Two tickers with two fields per line; some lines have no value for one ticker."""
    is_open = F.col("l_linestatus") == "O"
    matrix = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_extendedprice").alias("gross_Price"),
        F.col("l_tax").alias("gross_Rate"),
        F.when(is_open, F.col("l_quantity")).alias("open_Price"),
        F.when(is_open | (F.col("l_returnflag") != "A"), F.col("l_discount")).otherwise(float("nan")).alias("open_Rate"),
    )
    return reshape.stack_matrix(matrix, ["l_orderkey", "l_linenumber", "l_partkey"], ["Price", "Rate"])


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]


@query(
    "shp_transpose",
    f"""with counted as (select o_custkey as symbol, o_orderpriority as metric, o_orderstatus as date, count(*) as n
        from orders group by all)
        select symbol, date, {", ".join(f'''max(n) filter (metric = '{p}') as "{p}"''' for p in PRIORITIES)}
        from counted group by symbol, date""",
)
def shp_transpose(t: Tables) -> DataFrame:
    """Priorities by status, counted per customer, turned into statuses by priority."""
    count = {s: F.count_if(F.col("o_orderstatus") == s) for s in STATUSES}
    statement = t.orders.groupBy(F.col("o_custkey").alias("symbol"), F.col("o_orderpriority").alias("metric")).agg(
        *[F.nullif(n, F.lit(0).cast("bigint")).alias(s) for s, n in count.items()]
    )
    return reshape.transpose_statement(statement, ["symbol"], "metric", PRIORITIES)


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "shp_pivot_labels",
    f"""select user_id, {", ".join(f"max(value) filter (event_type = '{e}') as {e}_value" for e in EVENT_TYPES)}
        from events group by user_id""",
)
def shp_pivot_labels(t: Tables) -> DataFrame:
    wide = reshape.pivot_labels(t.events, ["user_id"], "event_type", "value", EVENT_TYPES)
    return projection.rename(wide, {e: f"{e}_value" for e in EVENT_TYPES})


@query("arr_explode", "select distinct doc_id, unnest(string_split(text, ' ')) as word from documents")
def arr_explode(t: Tables) -> DataFrame:
    words = t.documents.select("doc_id", F.split("text", " ").alias("words"))
    return reshape.explode_array(words, ["doc_id"], "words", "word")


@query(
    "arr_explode_struct",
    """select conv_id, turn, cast(unnest(generate_series(1, len(string_split(text, ' ')))) as integer) as index_id,
       unnest(string_split(text, ' ')) as index_name from conversations""",
)
def arr_explode_struct(t: Tables) -> DataFrame:
    named = F.transform(F.split("text", " "), lambda word, i: F.struct((i + 1).alias("id"), word.alias("name")))
    nested = t.conversations.select("conv_id", "turn", named.alias("index"))
    return reshape.explode_structs(nested, ["conv_id", "turn"], "index", {"id": "index_id", "name": "index_name"})


@query(
    "arr_transform_field",
    """select conv_id, turn, array_to_string(string_split(text, ' '), '|') as words from conversations""",
)
def arr_transform_field(t: Tables) -> DataFrame:
    tags = F.transform(F.split("text", " "), lambda word: F.struct(word.alias("text"), F.length(word).alias("size")))
    tagged = t.conversations.select("conv_id", "turn", tags.alias("tags"))
    return tagged.select("conv_id", "turn", F.array_join(reshape.array_field("tags", "text"), "|").alias("words"))
