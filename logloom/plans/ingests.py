"""Ingest normalisation, batching and output formats."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F

from logloom.operators.columns import as_row_json
from logloom.plans.views import LOG_EVENTS_SQL, log_events, parsed_events, table
from logloom.session import shared_dir
from logloom.sources import ingest as ig
from logloom.sources.lines import first_lines
from logloom.sources.sinks import csv_rows, export, raw_lines, split_valid

AS_OF = datetime(2024, 2, 1, 12, tzinfo=timezone.utc)
STAMP = "2024-02-01T12:00:00Z"


def ingest_lines(spark, sf_dir):
    """Lines as senders write them: with and without message, broken, padded, plain."""
    events = table(spark, sf_dir, "events")
    kind, name = F.col("event_id") % 6, F.col("event_type")
    n = F.concat(F.lit('"n":'), F.get_json_object("props", "$.k"))
    line = (
        F.when(kind == 0, F.concat(F.lit('{"message":"<'), name, F.lit('>","timestamp":"t1",'), n, F.lit("}")))
        .when(kind == 1, F.concat(F.lit('  {"message":"",'), n, F.lit("}")))
        .when(kind == 2, F.concat(F.lit("{"), n, F.lit("} trailing")))
        .when(kind == 3, F.concat(F.lit('{"message":123,"timestamp":5,'), n, F.lit("}")))
        .when(kind == 4, F.concat(F.lit('["'), name, F.lit('"]')))
        .otherwise(F.concat(name, F.lit(" happened")))
    )
    return events.select("event_id", line.alias("value"))


LINES_SQL = """lines as (select event_id, event_type, json_extract_string(props, '$.k') k, case event_id % 6
  when 0 then concat('{"message":"<', event_type, '>","timestamp":"t1","n":', json_extract_string(props, '$.k'), '}')
  when 1 then concat('  {"message":"","n":', json_extract_string(props, '$.k'), '}')
  when 2 then concat('{"n":', json_extract_string(props, '$.k'), '} trailing')
  when 3 then concat('{"message":123,"timestamp":5,"n":', json_extract_string(props, '$.k'), '}')
  when 4 then concat('["', event_type, '"]') else concat(event_type, ' happened') end as value from events)"""


def _normalized(spark, sf_dir):
    return ig.normalize_ingest(ingest_lines(spark, sf_dir), AS_OF)


def _batches(spark, sf_dir):
    """Conversation turns cut into batches."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    batched = ig.ingest_batches(turns, ["conv_id", "turn"], "text", max_events=50, max_bytes=20_000)
    return batched.select("conv_id", "turn", "batch")


def _rejects(spark, sf_dir):
    lines = ingest_lines(spark, sf_dir).withColumn("message", F.get_json_object("value", "$.message"))
    valid, rejected = split_valid(lines)
    counted = [
        part.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("part"), "n")
        for label, part in (("valid", valid), ("rejected", rejected))
    ]
    return counted[0].unionByName(counted[1])


def _csv(spark, sf_dir):
    rows = parsed_events(spark, sf_dir).join(
        table(spark, sf_dir, "events").select(F.col("event_id").alias("sequence"), "value"), "sequence"
    )
    wide = rows.withColumn("big", F.col("sequence") * F.lit(10_000_000.0)).withColumn(
        "nested", F.array("origin", "status")
    )
    return csv_rows(wide, ["sequence", "big", "amount", "nested", "http.status"])


def _jsonl(spark, sf_dir):
    parsed = parsed_events(spark, sf_dir).select("sequence", "status", "attrs")
    return parsed.select("sequence", as_row_json(parsed, ["@status", "type", "amount"]).alias("line"))


def _raw(spark, sf_dir):
    logs = log_events(spark, sf_dir)
    plain = logs.withColumn("raw", F.when(F.startswith("raw", F.lit("plain")), F.col("raw"))).drop("event_time")
    return raw_lines(plain)


def _head(spark, sf_dir):
    """Lines written to files in order; the first that say that something happened."""
    where = f"{shared_dir(spark)}/lines-{uuid.uuid4().hex}"
    lines = ingest_lines(spark, sf_dir).repartitionByRange(6, "event_id").sortWithinPartitions("event_id")
    lines.select("value").write.text(where)
    return first_lines(spark, where, 120, F.endswith("value", F.lit("happened")))


def _export(spark, sf_dir):
    """Errors of the first half of January as a file set, read back as text."""
    where = f"{shared_dir(spark)}/export-{uuid.uuid4().hex}"
    logs = log_events(spark, sf_dir).select("sequence", "status", "event_time", "raw")
    chosen = (F.col("status") == "error") & (F.col("event_time") < F.lit("2024-01-16").cast("timestamp_ntz"))
    export(logs.filter(chosen).drop("event_time"), where)
    return spark.read.text(where)


QUERIES = {
    "head_lines": _head,
    "export_lines": _export,
    "ingest_normalized": _normalized,
    "ingest_plan": lambda s, d: ig.ingest_plan(ingest_lines(s, d)),
    "ingest_batches": _batches,
    "ingest_rejects": _rejects,
    "csv_cells": _csv,
    "jsonl_lines": _jsonl,
    "raw_lines": _raw,
}

_PLAIN_EVENT = "concat('{{\"message\":', to_json({m}), ',\"timestamp\":\"{stamp}\"}}')"

ORACLES = {
    "head_lines": f"""with {LINES_SQL} select row_number() over (order by event_id) place, value from lines
where value like '%happened' order by event_id limit 120""",
    "export_lines": f"""with {LOG_EVENTS_SQL} select concat('{{"@sequence":', cast(sequence as varchar), ',"@status":"error","@raw":',
 cast(to_json(raw) as varchar), '}}') as value from log_events where status = 'error' and event_time < timestamp '2024-01-16'""",
    "ingest_normalized": f"""with {LINES_SQL}
select event_id, value, case event_id % 6 when 0 then concat('<', event_type, '>') else value end message,
 case event_id % 6 when 0 then 't1' when 3 then '5' else '{STAMP}' end as timestamp,
 case event_id % 6
  when 0 then concat('{{"n":', k, ',"message":"<', event_type, '>","timestamp":"t1"}}')
  when 1 then concat('{{"n":', k, ',"message":', cast(to_json(value) as varchar), ',"timestamp":"{STAMP}"}}')
  when 3 then concat('{{"n":', k, ',"message":', cast(to_json(value) as varchar), ',"timestamp":5}}')
  else concat('{{"message":', cast(to_json(value) as varchar), ',"timestamp":"{STAMP}"}}') end as event
from lines""",
    "ingest_plan": f"""with {LINES_SQL} select count(*) events, cast(sum(octet_length(encode(trim(value)))) as bigint) bytes from lines""",
    "ingest_batches": """with recursive s as (select conv_id, turn, octet_length(encode(text)) + 1 b,
  row_number() over (order by conv_id, turn) rn, sum(octet_length(encode(text)) + 1) over (order by conv_id, turn) c from conversations),
ends as (select a.rn, least(a.rn + 49, coalesce(min(e.rn), 9223372036854775807)) e
  from s a left join s e on e.rn between a.rn and a.rn + 49 and e.c - a.c + a.b >= 20000 group by a.rn),
walk as (select cast(1 as bigint) first, cast(0 as bigint) batch
  union all select e + 1, batch + 1 from walk join ends on ends.rn = walk.first),
starts as (select first, batch, coalesce(lead(first) over (order by first), 9223372036854775807) after from walk)
select conv_id, turn, batch from s join starts on rn >= first and rn < after""",
    "ingest_rejects": """select 'valid' as part, count(*) filter (where event_id % 6 in (0, 3)) n from events
union all select 'rejected', count(*) filter (where event_id % 6 not in (0, 3)) from events""",
    "csv_cells": f"""with {LOG_EVENTS_SQL} select cast(sequence as varchar) as sequence, cast(sequence * 10000000 as varchar) big,
 coalesce(f_amount, '') amount, concat('["', origin, '","', status, '"]') nested, coalesce(f_status, '') "http.status" from parsed""",
    "jsonl_lines": f"""with {LOG_EVENTS_SQL} select sequence, concat('{{"@status":"', status, '"',
 case when f_type is not null then concat(',"type":"', f_type, '"') else '' end,
 case when f_amount is not null then concat(',"amount":"', f_amount, '"') else '' end, '}}') line from parsed""",
    "raw_lines": f"""with {LOG_EVENTS_SQL} select case when raw like 'plain%' then raw else
 concat('{{"@sequence":', cast(sequence as varchar), ',"@origin":"', origin, '","@status":"', status, '"}}') end as value from log_events""",
}
