"""Derived views over the driver tables: spans out of orders, log lines out of events.

Each view exists as a DataFrame and as the SQL text the oracles embed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.sources.lines import parse_lines

EPOCH_NS = 1_700_000_000_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are entry spans, line items their children (depth 2, with orphans, errors and repeated span ids)."""
    orders = table(spark, sf_dir, "orders")
    items = table(spark, sf_dir, "lineitem")
    order = F.col("o_orderkey").cast("string")
    entry = orders.select(
        order.alias("trace_id"),
        F.concat(F.lit("o"), order).alias("span_id"),
        F.lit("").alias("parent_span_id"),
        F.concat(F.lit("order "), "o_orderstatus").alias("name"),
        F.lit("SPAN_KIND_SERVER").alias("kind"),
        F.col("o_orderpriority").alias("service"),
        F.when(F.col("o_orderstatus") == "F", "STATUS_CODE_ERROR")
        .otherwise("STATUS_CODE_OK")
        .alias("status"),
        (F.lit(EPOCH_NS) + F.col("o_orderkey") * 1_000_000_000).alias("start_ns"),
        (F.floor("o_totalprice").cast("bigint") * 1000).alias("duration_ns"),
    )
    key, line = F.col("l_orderkey").cast("string"), F.col("l_linenumber")

    def item(number):
        return F.concat(F.lit("l"), key, F.lit("-"), number.cast("string"))

    child = items.select(
        key.alias("trace_id"),
        item(line).alias("span_id"),
        F.when(line % 3 == 0, item(line - 1))
        .otherwise(F.concat(F.lit("o"), key))
        .alias("parent_span_id"),
        F.concat(F.lit("line "), "l_returnflag").alias("name"),
        F.lit("SPAN_KIND_CLIENT").alias("kind"),
        F.concat(F.lit("svc-"), "l_linestatus").alias("service"),
        F.when(F.col("l_returnflag") == "R", "STATUS_CODE_ERROR").otherwise("STATUS_CODE_UNSET").alias("status"),
        (
            F.lit(EPOCH_NS) + F.col("l_orderkey") * 1_000_000_000 + (line.cast("bigint") - 2) * 7_000_000
        ).alias("start_ns"),
        (F.floor("l_extendedprice").cast("bigint") * 100).alias("duration_ns"),
    )
    return entry.unionByName(child)


SPANS_SQL = """
raw_spans as (
  select cast(o_orderkey as varchar) trace_id, concat('o', cast(o_orderkey as varchar)) span_id,
         '' parent_span_id, concat('order ', o_orderstatus) name, 'SPAN_KIND_SERVER' kind,
         o_orderpriority service,
         case when o_orderstatus = 'F' then 'STATUS_CODE_ERROR' else 'STATUS_CODE_OK' end status,
         1700000000000000000 + o_orderkey * 1000000000 start_ns,
         cast(floor(o_totalprice) as bigint) * 1000 duration_ns
  from orders
  union all
  select cast(l_orderkey as varchar), concat('l', cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)),
         case when l_linenumber % 3 = 0
              then concat('l', cast(l_orderkey as varchar), '-', cast(l_linenumber - 1 as varchar))
              else concat('o', cast(l_orderkey as varchar)) end,
         concat('line ', l_returnflag), 'SPAN_KIND_CLIENT', concat('svc-', l_linestatus),
         case when l_returnflag = 'R' then 'STATUS_CODE_ERROR' else 'STATUS_CODE_UNSET' end,
         1700000000000000000 + l_orderkey * 1000000000 + (l_linenumber - 2) * 7000000,
         cast(floor(l_extendedprice) as bigint) * 100
  from lineitem),
spans as (
  select trace_id, span_id, parent_span_id, name, replace(kind, 'SPAN_KIND_', '') kind, service, status,
         start_ns, start_ns + duration_ns end_ns, duration_ns
  from raw_spans)
"""


def unique_spans_sql(source: str) -> str:
    """The rule for repeated span ids: the earliest stays, then the smallest name and other fields."""
    return f"""(select * from {source} qualify span_id = '' or row_number() over (partition by trace_id, span_id
 order by start_ns, name, parent_span_id, service, duration_ns, status) = 1)"""


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log lines: nine in ten are JSON (nested ``http.status``), the rest plain text."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    purchase = F.col("event_type") == "purchase"
    amount = F.concat(F.lit(',"amount":'), F.round(F.col("value") * 100).cast("bigint").cast("string"))
    status = 200 + 100 * (k.cast("int") % 4)
    raw = F.when(
        F.col("event_id") % 10 == 0,
        F.concat(
            F.lit("plain "), "event_type", F.lit(" user "), F.col("user_id").cast("string"),
            F.lit(" took "), k, F.lit("ms"),
        ),
    ).otherwise(
        F.concat(
            F.lit('{"type":"'), "event_type", F.lit('","k":'), k,
            F.when(purchase, amount).otherwise(F.lit("")),
            F.lit(',"http":{"status":'), status.cast("string"), F.lit("}}"),
        )
    )
    return events.select(
        F.col("event_id").alias("sequence"),
        F.col("ts").alias("event_time"),
        F.concat(F.lit("user-"), (F.col("user_id") % 5).cast("string")).alias("origin"),
        F.when(F.col("event_type") == "error", "error")
        .when(F.col("event_type") == "signup", "warn")
        .otherwise("info")
        .alias("status"),
        raw.alias("raw"),
    )


def parsed_events(
    spark: SparkSession, sf_dir: str, fields: list[str] | None = None
) -> DataFrame:
    return parse_lines(log_events(spark, sf_dir), fields=fields)


LOG_EVENTS_SQL = """
log_events as (
  select event_id as sequence, ts as event_time, concat('user-', cast(user_id % 5 as varchar)) origin,
         case event_type when 'error' then 'error' when 'signup' then 'warn' else 'info' end status,
         case when event_id % 10 = 0
              then concat('plain ', event_type, ' user ', cast(user_id as varchar), ' took ',
                          json_extract_string(props, '$.k'), 'ms')
              else concat('{"type":"', event_type, '","k":', json_extract_string(props, '$.k'),
                          case when event_type = 'purchase'
                               then concat(',"amount":', cast(cast(round(value * 100) as bigint) as varchar))
                               else '' end,
                          ',"http":{"status":',
                          cast(200 + 100 * (cast(json_extract_string(props, '$.k') as int) % 4) as varchar),
                          '}}') end raw
  from events),
parsed as (
  select *, case when raw like '{%' then json_extract_string(raw, '$.type') end f_type,
         case when raw like '{%' then json_extract_string(raw, '$.k') end f_k,
         case when raw like '{%' then json_extract_string(raw, '$.amount') end f_amount,
         case when raw like '{%' then json_extract_string(raw, '$.http.status') end f_status
  from log_events)
"""


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document as ``doc_id, line_no, line``."""
    docs = table(spark, sf_dir, "documents")
    exploded = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return exploded.withColumn("line_no", F.col("line_no").cast("bigint"))


DOCUMENT_LINES_SQL = """
document_lines as (
  select doc_id, cast(generate_subscripts(l, 1) - 1 as bigint) line_no, unnest(l) line
  from (select doc_id, string_split(text, chr(10)) l from documents))
"""
