"""Predicates, scans, ordering and neighbourhoods over the log event view."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from logloom.functions import predicates as p
from logloom.functions.text import severity_class
from logloom.operators import events as ev
from logloom.operators.columns import select
from logloom.plans.views import (
    DOCUMENT_LINES_SQL,
    LOG_EVENTS_SQL,
    document_lines,
    log_events,
    parsed_events,
    table,
)
from logloom.session import shared_dir
from logloom.sources.scan import between, in_datasets, union_datasets
from logloom.sources.shredded import field as shredded_field
from logloom.sources.shredded import write_shredded

_NUMBER = r"(?i)^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?$"


def _num(f: str) -> str:
    """A field as a number in the oracle's SQL."""
    return f"case when regexp_matches({f}, '{_NUMBER}') then try_cast({f} as double) end"


def _filter(fields, predicate):
    def run(spark, sf_dir):
        return parsed_events(spark, sf_dir, fields).filter(predicate()).select("sequence", "raw")

    return run


def _where(condition: str) -> str:
    return f"with {LOG_EVENTS_SQL} select sequence, raw from parsed where {condition}"


def _error_bursts(spark, sf_dir):
    """Errors with k >= 50, newest first."""
    kept = parsed_events(spark, sf_dir, ["type", "k"]).filter(p.eq("type", "error") & p.ge("k", 50))
    return select(ev.recent(kept, 100), ["event_time", "sequence", "k", "raw"])


def _clauses(spark, sf_dir):
    test = p.clauses(
        [("type", "!=", "click"), ("http.status", ">=", "400"), ("k", "~", "^[1-4]"), ("type", "=", "purchase")]
    )
    return parsed_events(spark, sf_dir, ["type", "k", "http.status"]).filter(test).select("sequence", "raw")


def _lines(spark, sf_dir):
    lines = document_lines(spark, sf_dir)
    return lines.filter(
        p.line_rules(["[aeiou]{2}", "(?i)on"], [r"\d", "the.*the$"], F.col("line"))
    ).select("doc_id", "line_no")


def _field_rules(spark, sf_dir):
    test = p.field_rules(include=[("type", "^[cp]")], exclude=[("amount", "^[1-4]"), ("k", "9$")])
    return parsed_events(spark, sf_dir, ["type", "amount", "k"]).filter(test).select("sequence", "raw")


def _severity(spark, sf_dir):
    return log_events(spark, sf_dir).groupBy(severity_class("status").alias("severity")).agg(F.count(F.lit(1)).alias("n"))


def _time_bounded(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    kept = between(events, "ts", last="1d12h", as_of=datetime(2024, 1, 20, 6, 30))
    return kept.select("event_id", "ts", "event_type")


def _absolute_range(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    kept = between(events, "ts", frm="2024-01-10T00:00:00Z", to="2024-01-11T12:00:00+02:00")
    return kept.select("event_id", "ts", "event_type")


def _multi_dataset(spark, sf_dir):
    events = log_events(spark, sf_dir).select(
        F.lit("app").alias("collection"), F.concat(F.lit("log-"), "status").alias("dataset"), "sequence", "raw"
    )
    docs = table(spark, sf_dir, "documents").select(
        F.lit("text").alias("collection"), F.concat(F.lit("docs-"), "lang").alias("dataset"),
        F.col("doc_id").alias("sequence"), F.col("text").alias("raw"), "source",
    )
    both = union_datasets([events, docs]).filter(in_datasets(["log-error", "text/docs-en", "app/docs-fr"]))
    return both.select("collection", "dataset", "sequence", "source", F.octet_length("raw").alias("bytes"))


def _order_by(spark, sf_dir):
    parsed = parsed_events(spark, sf_dir, ["amount"])
    ordered = ev.order_by(parsed, "amount", desc=True, ties=["sequence"]).limit(200)
    return select(ordered, ["sequence", "amount"])


def _top_values(spark, sf_dir):
    parsed = select(parsed_events(spark, sf_dir, ["k"]), ["origin", "k"])
    return ev.top_values(parsed, "k", 3, ["origin"])


def _first_seen(spark, sf_dir):
    parsed = select(parsed_events(spark, sf_dir, ["type"]), ["event_time", "sequence", "origin", "type", "raw"])
    return ev.first_seen(parsed, ["origin", "type"], ["event_time", "sequence"])


def _context(direction):
    def run(spark, sf_dir):
        events = table(spark, sf_dir, "events")
        # every user's largest event is an anchor; its neighbours share the event type
        biggest = events.groupBy("user_id").agg(
            F.max_by(F.struct("event_type", "event_id", "ts"), F.struct("value", "event_id")).alias("a")
        )
        anchors = biggest.select(
            F.col("a.event_type").alias("dataset"), F.col("a.event_id").alias("sequence"), F.col("a.ts").alias("event_time")
        )
        rows = events.select(
            F.col("event_type").alias("dataset"), F.col("event_id").alias("sequence"), F.col("ts").alias("event_time"), "value"
        )
        return ev.neighbours(rows, anchors, 3, direction)

    return run


def _context_sql(low: int, high: int) -> str:
    return f"""
with ranked as (
  select event_type dataset, event_id sequence, ts event_time, value,
         row_number() over (partition by event_type order by ts, event_id) rn from events),
anchors as (
  select distinct s.event_type dataset, s.event_id sequence
  from (select arg_max(struct_pack(event_type := event_type, event_id := event_id),
                       struct_pack(v := value, e := event_id)) s from events group by user_id))
select a.sequence anchor_sequence, cast(r.rn - c.rn as bigint) "offset", r.dataset, r.sequence, r.event_time, r.value
from anchors a join ranked c on a.dataset = c.dataset and a.sequence = c.sequence
join ranked r on r.dataset = c.dataset and r.rn between c.rn + ({low}) and c.rn + ({high})
"""


def _shredded(spark, sf_dir):
    """Predicates over a table whose fields the writer has made columns by itself."""
    where = f"{shared_dir(spark)}/shredded-{uuid.uuid4().hex}"
    parsed = parsed_events(spark, sf_dir).withColumns({"collection": F.lit("app"), "dataset": F.col("origin")})
    write_shredded(parsed, where)
    f = shredded_field
    test = (p.eq(f("type"), "error") | p.gt(f("amount"), 1000)) & p.ge(f("http.status"), 400) & ~p.eq(f("k"), "7")
    return spark.read.parquet(where).filter(test).select("sequence", f("type").alias("type"), f("k", "bigint").alias("k"))


QUERIES = {
    "filter_shredded": _shredded,
    "error_bursts": _error_bursts,
    "filter_eq_num": _filter(["http.status"], lambda: p.eq("http.status", 500)),
    "filter_eq_text": _filter(["type"], lambda: p.eq("type", "click")),
    "filter_eq_quoted_number": _filter(["k"], lambda: p.eq("k", "7") | p.eq("k", "07")),
    "filter_ne_absent": _filter(["amount"], lambda: p.ne("amount", 5000)),
    "filter_ordered": _filter(["amount", "k"], lambda: p.gt("amount", 1000) & p.le("k", 50)),
    "filter_ordered_text": _filter(["type", "k"], lambda: p.lt("type", 5) | p.lt("k", 3)),
    "filter_match": _filter(["type"], lambda: p.match("type", "^(click|err)")),
    "filter_nmatch": _filter(["type"], lambda: p.nmatch("type", "e$")),
    "filter_not_absent": _filter(["amount"], lambda: ~p.gt("amount", 1000)),
    "filter_bool_tree": _filter(
        ["type", "http.status"],
        lambda: (p.eq("type", "error") | p.eq("type", "purchase"))
        & p.ge("http.status", 400)
        & ~p.eq("@origin", "user-3"),
    ),
    "filter_exists": _filter(["amount"], lambda: p.exists("amount")),
    "filter_not_exists": _filter(["amount"], lambda: ~p.exists("amount") & p.match("@raw", "purchase")),
    "filter_clauses": _clauses,
    "filter_lines": _lines,
    "filter_field_rules": _field_rules,
    "severity_counts": _severity,
    "time_bounded": _time_bounded,
    "absolute_range": _absolute_range,
    "multi_dataset": _multi_dataset,
    "recent_events": lambda s, d: ev.recent(log_events(s, d)),
    "oldest_events": lambda s, d: ev.oldest(log_events(s, d), 250),
    "order_by_field": _order_by,
    "top_values": _top_values,
    "first_seen": _first_seen,
    "context_both": _context("both"),
    "context_before": _context("before"),
    "context_after": _context("after"),
}

ORACLES = {
    "filter_shredded": f"""with {LOG_EVENTS_SQL} select sequence, f_type as type, cast(f_k as bigint) k from parsed
where (coalesce(f_type = 'error', false) or coalesce({_num('f_amount')} > 1000, false))
 and coalesce({_num('f_status')} >= 400, false) and not coalesce(f_k = '7', false)""",
    "error_bursts": f"""with {LOG_EVENTS_SQL} select event_time, sequence, f_k as k, raw from parsed
where coalesce(f_type = 'error', false) and coalesce({_num('f_k')} >= 50, false)
order by event_time desc, sequence desc limit 100""",
    "filter_eq_num": _where(f"coalesce({_num('f_status')} = 500, false)"),
    "filter_eq_text": _where("coalesce(f_type = 'click', false)"),
    "filter_eq_quoted_number": _where("coalesce(f_k = '7', false) or coalesce(f_k = '07', false)"),
    "filter_ne_absent": _where(f"f_amount is not null and not coalesce({_num('f_amount')} = 5000, false)"),
    "filter_ordered": _where(f"coalesce({_num('f_amount')} > 1000, false) and coalesce({_num('f_k')} <= 50, false)"),
    "filter_ordered_text": _where(f"coalesce({_num('f_type')} < 5, false) or coalesce({_num('f_k')} < 3, false)"),
    "filter_match": _where("coalesce(regexp_matches(f_type, '^(click|err)'), false)"),
    "filter_nmatch": _where("coalesce(not regexp_matches(f_type, 'e$'), false)"),
    "filter_not_absent": _where(f"not coalesce({_num('f_amount')} > 1000, false)"),
    "filter_bool_tree": _where(
        "(coalesce(f_type = 'error', false) or coalesce(f_type = 'purchase', false))"
        f" and coalesce({_num('f_status')} >= 400, false) and not origin = 'user-3'"
    ),
    "filter_exists": _where("f_amount is not null and f_amount <> ''"),
    "filter_not_exists": _where("f_amount is null and regexp_matches(raw, 'purchase')"),
    "filter_clauses": _where(
        f"f_type is not null and f_type <> 'click' and coalesce({_num('f_status')} >= 400, false)"
        " and coalesce(regexp_matches(f_k, '^[1-4]'), false) and coalesce(f_type = 'purchase', false)"
    ),
    "filter_lines": f"""with {DOCUMENT_LINES_SQL} select doc_id, line_no from document_lines
where regexp_matches(line, '[aeiou]{{2}}') and regexp_matches(line, '(?i)on')
  and not regexp_matches(line, '\\d') and not regexp_matches(line, 'the.*the$')""",
    "filter_field_rules": _where(
        "coalesce(regexp_matches(f_type, '^[cp]'), false)"
        " and not coalesce(regexp_matches(f_amount, '^[1-4]'), false)"
        " and not coalesce(regexp_matches(f_k, '9$'), false)"
    ),
    "severity_counts": f"""with {LOG_EVENTS_SQL}
select case when status in ('error', 'warn') then status else 'other' end severity, count(*) n
from log_events group by 1""",
    "time_bounded": """select event_id, ts, event_type from events
where ts >= timestamp '2024-01-18 18:30:00' and ts < timestamp '2024-01-20 06:30:00'""",
    "absolute_range": """select event_id, ts, event_type from events
where ts >= timestamp '2024-01-10 00:00:00' and ts < timestamp '2024-01-11 10:00:00'""",
    "multi_dataset": f"""with {LOG_EVENTS_SQL}
select 'app' collection, 'log-error' dataset, sequence, cast(null as varchar) source,
       cast(octet_length(encode(raw)) as int) bytes from log_events where status = 'error'
union all
select 'text', 'docs-en', doc_id, source, cast(octet_length(encode(text)) as int) from documents where lang = 'en'""",
    "recent_events": f"""with {LOG_EVENTS_SQL} select * from log_events order by event_time desc, sequence desc limit 100""",
    "oldest_events": f"""with {LOG_EVENTS_SQL} select * from log_events order by event_time, sequence limit 250""",
    "order_by_field": f"""with {LOG_EVENTS_SQL} select sequence, f_amount amount from parsed
order by {_num('f_amount')} desc nulls last, f_amount desc nulls last, sequence limit 200""",
    "top_values": f"""with {LOG_EVENTS_SQL} select origin, value, n as count from (
  select origin, f_k as value, count(*) n, row_number() over (partition by origin order by count(*) desc, f_k) r
  from parsed where f_k <> '' group by 1, 2) where r <= 3""",
    "first_seen": f"""with {LOG_EVENTS_SQL} select event_time, sequence, origin, f_type as type, raw from parsed
qualify row_number() over (partition by origin, f_type order by event_time, sequence) = 1""",
    "context_both": _context_sql(-3, 3),
    "context_before": _context_sql(-3, -1),
    "context_after": _context_sql(1, 3),
}
