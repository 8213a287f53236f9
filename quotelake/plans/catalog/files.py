"""Sources and sinks: a table written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.times import day_text
from quotelake.operators.ordering import first_n_symbols, preview
from quotelake.plans.catalog.registry import Tables, query
from quotelake.session import fresh_path
from quotelake.sources import readers, writers


@query("src_csv", "select * from customer")
def src_csv(t: Tables) -> DataFrame:
    customer = t.customer
    path = fresh_path(t.spark, "customer-csv")
    customer.write.option("header", True).csv(path)
    return readers.read_csv(t.spark, path, customer.schema)


@query("src_parquet", "select o_orderkey, o_custkey, o_orderdate, o_totalprice from orders")
def src_parquet(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


@query("src_parquet_glob", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def src_parquet_glob(t: Tables) -> DataFrame:
    customer = t.customer
    path = fresh_path(t.spark, "customer-by-segment")
    writers.write_partitioned(customer, path, ["c_mktsegment"], ["c_custkey"])
    return readers.read_parquet_glob(t.spark, path, "c_mktsegment=*", customer.schema)


@query("src_json_lines", "select * from conversations")
def src_json_lines(t: Tables) -> DataFrame:
    conversations = t.conversations
    path = fresh_path(t.spark, "conversations-lines")
    conversations.write.json(path)
    return readers.read_json_lines(t.spark, path, conversations.schema)


@query("src_json_multiline", "select * from conversations")
def src_json_multiline(t: Tables) -> DataFrame:
    conversations = t.conversations
    path = fresh_path(t.spark, "conversations-documents")
    writers.write_json_documents(conversations, path, "role", ["conv_id", "turn"])
    return readers.read_json_documents(t.spark, path, conversations.schema).select(conversations.columns)


@query(
    "src_payload_typed",
    "select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events",
)
def src_payload_typed(t: Tables) -> DataFrame:
    return readers.parse_payload(t.events.select("event_id", "props"), "props", "k int")


@query(
    "src_payload_inferred",
    """select event_id, case when event_id % 11 <> 0 then cast(json_extract_string(props, '$.k') as bigint) end as k,
       case when event_id % 11 <> 0 then cast(event_id as double) + 0.5 end as half,
       case when event_id % 11 = 0 then null when event_id % 2 = 0 then cast(event_id as varchar) else 'odd' end as mixed
       from events""",
)
def src_payload_inferred(t: Tables) -> DataFrame:
    """Objects with a whole, a fractional and a mixed field, between arrays."""
    whole = F.get_json_object("props", "$.k").cast("bigint").alias("k")
    half = (F.col("event_id") + F.lit(0.5)).alias("half")
    fields = {kind: F.to_json(F.struct(whole, half, value.alias("mixed"))) for kind, value in (("number", F.col("event_id")), ("text", F.lit("odd")))}
    payload = F.when(F.col("event_id") % 11 == 0, "[1, 2]").when(F.col("event_id") % 2 == 0, fields["number"]).otherwise(fields["text"])
    return readers.parse_payload(t.events.select("event_id", payload.alias("payload")), "payload")


@query("snk_parquet", "select * from orders")
def snk_parquet(t: Tables) -> DataFrame:
    orders = t.orders
    path = fresh_path(t.spark, "orders")
    writers.write_parquet(orders, path)
    return readers.read_parquet(t.spark, path, orders.schema)


@query(
    "snk_json_documents",
    """select event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') as day from events""",
)
def snk_json_documents(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type", "value", day_text("ts").alias("day"))
    path = fresh_path(t.spark, "event-documents")
    writers.write_json_documents(rows, path, "event_type", ["event_id"])
    return readers.read_json_documents(t.spark, path, rows.schema).select(rows.columns)


@query("snk_partitioned", "select * from lineitem")
def snk_partitioned(t: Tables) -> DataFrame:
    lineitem = t.lineitem
    path = fresh_path(t.spark, "lineitem-by-flag")
    writers.write_partitioned(lineitem, path, ["l_returnflag"], ["l_partkey"])
    return readers.read_parquet(t.spark, path, lineitem.schema).select(lineitem.columns)


@query("preview_head", "select * from customer order by c_custkey limit 5")
def preview_head(t: Tables) -> DataFrame:
    return preview(t.customer, 5, ["c_custkey"])


@query("lim_first_n", """select c_name as "Symbol" from customer order by c_custkey limit 505""")
def lim_first_n(t: Tables) -> DataFrame:
    listed = t.customer.select(F.col("c_name").alias("Symbol"), F.col("c_custkey").alias("position"))
    return first_n_symbols(listed, 505)
