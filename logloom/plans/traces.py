"""Span statistics, trees and shapes over the span view."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.functions.text import format_duration_ns
from logloom.operators import spans as sp
from logloom.operators import tree as tr
from logloom.plans.views import SPANS_SQL, raw_spans, unique_spans_sql


def spans(spark, sf_dir):
    return sp.normalize_spans(raw_spans(spark, sf_dir))


def _path_text(rows):
    hops = F.transform("path", lambda h: F.concat(h["service"], F.lit("/"), h["name"]))
    return rows.withColumn("path", F.array_join(hops, "|"))


def flagship_shape(spark, sf_dir):
    """Call tree below the entry span of every trace."""
    return _path_text(tr.shape(spans(spark, sf_dir), tr.EntryMatch(entry_only=True)))


def _attributes(spark, sf_dir):
    return sp.attributes(
        spans(spark, sf_dir).withColumn("priority", F.substring("service", 1, 1)), ["service.name", "$span.name", "priority"]
    )


def _empty_attribute():
    return F.when(F.col("status") == "STATUS_CODE_UNSET", "").when(F.col("kind") == "SERVER", "null").otherwise(F.col("name"))


def _attributes_missing(spark, sf_dir):
    rows = spans(spark, sf_dir).withColumn("zone", _empty_attribute())
    return sp.attributes(rows, ["zone", "service.name"], root_only=False, include_empty=True, n=7)


def _attributes_dropped(spark, sf_dir):
    rows = spans(spark, sf_dir).withColumn("zone", _empty_attribute())
    return sp.attributes_dropped(rows, ["zone", "service.name"], root_only=False)


def _attributes_client(spark, sf_dir):
    return sp.attributes(
        spans(spark, sf_dir), ["span.name"], root_only=False, kind="span_kind_client",
        service="svc-F", errors_only=True, where=F.col("duration_ns") > 2_000_000,
    )


def _sampled_spans(spark, sf_dir):
    rows = spans(spark, sf_dir)
    ids = sp.sample_traces(rows, sp.span_filter(kind="server", errors_only=True, min_ms=300), 50)
    return sp.spans_of(rows, ids).select("trace_id", "span_id", "name", "start_ns", "duration_ns")


def _sampled_shape(spark, sf_dir):
    rows = spans(spark, sf_dir)
    ids = sp.sample_traces(rows, sp.span_filter(kind="server"), 30)
    return _path_text(tr.shape(sp.spans_of(rows, ids), tr.EntryMatch(entry_only=True)))


def _labels(spark, sf_dir):
    return spans(spark, sf_dir).select(
        "trace_id", "span_id", format_duration_ns("duration_ns").alias("label")
    )


def _shape_view(spark, sf_dir):
    rows = tr.shape(spans(spark, sf_dir), tr.EntryMatch(entry_only=True))
    view = _path_text(tr.shape_view(rows))
    return view.select("path", "sibling", "presence", "axis_end_ns")


QUERIES = {
    "shape": flagship_shape,
    "shape_loose_entry": lambda s, d: _path_text(
        tr.shape(spans(s, d), tr.EntryMatch(service="svc-O", errors_only=True, min_ms=1))
    ),
    "shape_min_traces": lambda s, d: tr.min_traces(flagship_shape(s, d), 5),
    "shape_sampled": _sampled_shape,
    "shape_view": _shape_view,
    "spans_normalized": spans,
    "span_list": lambda s, d: sp.list_spans(spans(s, d), min_ms=100, errors_only=True),
    "services": lambda s, d: sp.services(spans(s, d)),
    "services_errors": lambda s, d: sp.services(spans(s, d), errors_only=True),
    "operations": lambda s, d: sp.operations(spans(s, d)),
    "operations_service": lambda s, d: sp.operations(spans(s, d), service="svc-F", errors_only=True),
    "attributes": _attributes,
    "attributes_missing": _attributes_missing,
    "attributes_dropped": _attributes_dropped,
    "attributes_client": _attributes_client,
    "trace_bounds": lambda s, d: sp.trace_bounds(spans(s, d)),
    "trace_sizes": lambda s, d: sp.trace_sizes(spans(s, d)),
    "batch_roots": lambda s, d: tr.batch_roots(spans(s, d)).select("trace_id", "span_id"),
    "orphans": lambda s, d: tr.orphans(spans(s, d)).select("trace_id", "span_id"),
    "children": lambda s, d: tr.children(spans(s, d)),
    "anchors": lambda s, d: tr.anchors(spans(s, d), tr.EntryMatch(service="svc-O")),
    "sample_traces": lambda s, d: sp.sample_traces(spans(s, d), sp.error_exact(), 40),
    "sampled_spans": _sampled_spans,
    "waterfall": lambda s, d: tr.waterfalls(spans(s, d)),
    "duration_labels": _labels,
}

_KNOWN = "known as (select distinct trace_id, span_id from spans)"
_ROOTED = """rooted as (select s.*, k.span_id is null as is_root from spans s
  left join known k on k.trace_id = s.trace_id and k.span_id = s.parent_span_id)"""
_ERROR = "status ilike '%error'"


def _shape_sql(match: str, tail: str = "select * from shaped", source: str = "spans") -> str:
    return f"""with recursive {SPANS_SQL}, sampled as (select * from {source}), chosen as {unique_spans_sql("sampled")}, {_KNOWN},
rooted as (select s.*, k.span_id is null as is_root from chosen s
  left join known k on k.trace_id = s.trace_id and k.span_id = s.parent_span_id),
ranked as (select *, row_number() over (partition by trace_id
    order by case when {match} then 0 when is_root then 1 else 2 end, start_ns, span_id) r from rooted),
walk(trace_id, span_id, path, depth, service, name, parent, t0, start_ns, duration_ns, status) as (
  select trace_id, span_id, concat(service, '/', name), 0, service, name, cast(null as varchar), start_ns, start_ns,
         duration_ns, status from ranked where r = 1
  union all
  select c.trace_id, c.span_id, concat(w.path, '|', c.service, '/', c.name), w.depth + 1, c.service, c.name,
         concat(w.service, '/', w.name), w.t0, c.start_ns, c.duration_ns, c.status
  from walk w join ranked c on c.trace_id = w.trace_id and c.parent_span_id = w.span_id and c.r > 1),
shaped as (
  select path, cast(depth as bigint) depth, service, name, parent, count(*) samples, count(distinct trace_id) traces,
         cast(sum(o) // count(*) as bigint) avg_offset_ns, cast(sum(d) // count(*) as bigint) avg_duration_ns,
         min(o) min_offset_ns, max(o + d) max_end_ns, count(*) filter (where {_ERROR}) errors
  from (select *, greatest(start_ns - t0, 0) o, greatest(duration_ns, 0) d from walk)
  group by path, depth, service, name, parent)
{tail}"""


def _stats_sql(keys: str, where: str = "true", limit: int = 50, order: str = "") -> str:
    return f"""with {SPANS_SQL} select {keys}, count(*) spans, cast(sum(duration_ns) // count(*) as bigint) avg_ns,
 max(duration_ns) max_ns from spans where {where} group by all order by spans desc, {order} limit {limit}"""


_ZONE = """case when status = 'STATUS_CODE_UNSET' then '<missing>' when kind = 'SERVER' then '<missing>' else name end"""
_MEASURES = """count(*) spans, count(*) filter (where status = 'STATUS_CODE_ERROR') errors,
 cast(printf('%.1f', count(*) filter (where status = 'STATUS_CODE_ERROR') / count(*) * 100) as double) error_pct,
 cast(sum(duration_ns) // count(*) as bigint) avg_ns, max(duration_ns) max_ns"""
_ENTRY = "kind = 'SERVER'"

ORACLES = {
    "shape": _shape_sql(_ENTRY),
    "shape_loose_entry": _shape_sql(f"service = 'svc-O' and {_ERROR} and duration_ns >= 1000000"),
    "shape_min_traces": _shape_sql(_ENTRY, "select * from shaped where traces >= 5"),
    "shape_sampled": _shape_sql(
        _ENTRY,
        source="""(select s.* from spans s join (select trace_id, max(start_ns) m from spans where kind = 'SERVER'
 group by 1 order by m desc, trace_id limit 30) i on i.trace_id = s.trace_id)""",
    ),
    "shape_view": _shape_sql(
        _ENTRY,
        """select path,
 row_number() over (partition by case when depth = 0 then '' else left(path, length(path) - length(service) - length(name) - 2) end
                    order by avg_offset_ns, avg_duration_ns desc, path) sibling,
 concat(cast(traces as varchar), '/', cast((select sum(traces) from shaped where depth = 0) as varchar)) presence,
 (select greatest(max(greatest(avg_offset_ns + avg_duration_ns, max_end_ns)), 1) from shaped) axis_end_ns from shaped""",
    ),
    "spans_normalized": f"with {SPANS_SQL} select * from spans",
    "span_list": f"""with {SPANS_SQL} select start_ns, service, name operation, duration_ns,
 replace(status, 'STATUS_CODE_', '') status, trace_id, span_id from spans
where duration_ns > 100000000 and status = 'STATUS_CODE_ERROR' order by start_ns desc, trace_id, span_id, name, duration_ns, service limit 50""",
    "services": _stats_sql("service", order="service"),
    "services_errors": _stats_sql("service", "status = 'STATUS_CODE_ERROR'", order="service"),
    "operations": _stats_sql("service, name as operation", limit=25, order="service, operation"),
    "operations_service": _stats_sql(
        "service, name as operation", "service = 'svc-F' and status = 'STATUS_CODE_ERROR'", 25, "service, operation"
    ),
    "attributes": f"""with {SPANS_SQL} select service "service.name", name "span.name", left(service, 1) priority, {_MEASURES}
from spans where parent_span_id = '' group by 1, 2, 3 order by spans desc, 1, 2, 3 limit 50""",
    "attributes_missing": f"""with {SPANS_SQL}, z as (
 select case when status = 'STATUS_CODE_UNSET' then '' when kind = 'SERVER' then 'null' else name end zone, * from spans),
g as (select zone z0, service "service.name", {_MEASURES} from z group by 1, 2)
select case when z0 in ('', 'null') then '<missing>' else z0 end zone, * exclude (z0) from g
order by spans desc, zone, "service.name" limit 7""",
    "attributes_dropped": f"""with {SPANS_SQL} select count(*) dropped from (
 select distinct case when status = 'STATUS_CODE_UNSET' then '' else 'null' end, service from spans
 where status = 'STATUS_CODE_UNSET' or kind = 'SERVER')""",
    "attributes_client": f"""with {SPANS_SQL} select name "span.name", count(*) spans,
 cast(sum(duration_ns) // count(*) as bigint) avg_ns, max(duration_ns) max_ns from spans
where kind = 'CLIENT' and service = 'svc-F' and status = 'STATUS_CODE_ERROR' and duration_ns > 2000000
group by 1 order by spans desc, 1 limit 50""",
    "trace_bounds": f"""with {SPANS_SQL}, b as (
 select trace_id, coalesce(min(start_ns) filter (where start_ns > 0), 0) start_ns, max(end_ns) e, max(duration_ns) d
 from spans group by 1)
select trace_id, start_ns, greatest(e, start_ns) end_ns, greatest(greatest(e, start_ns) - start_ns, d, 1) total_ns from b""",
    "trace_sizes": f"""with {SPANS_SQL} select trace_id, count(*) spans, count(distinct service) services
from spans group by 1""",
    "batch_roots": f"with {SPANS_SQL}, {_KNOWN}, {_ROOTED} select trace_id, span_id from rooted where is_root",
    "orphans": f"""with {SPANS_SQL}, {_KNOWN}, {_ROOTED} select trace_id, span_id from rooted
where is_root and parent_span_id <> ''""",
    "children": f"""with {SPANS_SQL}, {_KNOWN} select s.trace_id, s.parent_span_id, s.span_id from spans s
join known k on k.trace_id = s.trace_id and k.span_id = s.parent_span_id""",
    "anchors": f"""with {SPANS_SQL}, {_KNOWN}, {_ROOTED} select trace_id, span_id, start_ns from rooted
qualify row_number() over (partition by trace_id
 order by case when service = 'svc-O' then 0 when is_root then 1 else 2 end, start_ns, span_id) = 1""",
    "sample_traces": f"""with {SPANS_SQL} select trace_id, max(start_ns) latest from spans
where status = 'STATUS_CODE_ERROR' and trace_id <> '' group by 1 order by latest desc, trace_id limit 40""",
    "sampled_spans": f"""with {SPANS_SQL}, ids as (
 select trace_id, max(start_ns) m from spans where kind = 'SERVER' and status = 'STATUS_CODE_ERROR' and duration_ns > 300000000
 group by 1 order by m desc, trace_id limit 50)
select s.trace_id, s.span_id, s.name, s.start_ns, s.duration_ns from spans s join ids using (trace_id)""",
    "waterfall": f"""with recursive {SPANS_SQL}, chosen as {unique_spans_sql("spans")}, {_KNOWN},
rooted as (select s.*, k.span_id is null as is_root from chosen s
  left join known k on k.trace_id = s.trace_id and k.span_id = s.parent_span_id),
walk(trace_id, span_id, depth, path) as (
  select trace_id, span_id, 0, [struct_pack(s := start_ns, d := duration_ns, i := span_id)] from rooted where is_root
  union all
  select c.trace_id, c.span_id, w.depth + 1, list_append(w.path, struct_pack(s := c.start_ns, d := c.duration_ns, i := c.span_id))
  from walk w join chosen c on c.trace_id = w.trace_id and c.parent_span_id = w.span_id)
select w.trace_id, row_number() over (partition by w.trace_id order by w.path) as position, cast(w.depth as bigint) depth,
 s.service, s.name operation, s.span_id, s.parent_span_id, s.start_ns, s.duration_ns,
 replace(s.status, 'STATUS_CODE_', '') status, s.status ilike '%error' as error
from walk w join chosen s on s.trace_id = w.trace_id and s.span_id = w.span_id""",
    "duration_labels": f"""with {SPANS_SQL} select trace_id, span_id,
 case when duration_ns <= 0 then '—'
      when duration_ns / 1e6 < 1 then concat(printf('%.1f', duration_ns / 1e3), 'µs')
      when duration_ns / 1e6 < 1000 then concat(printf('%.2f', duration_ns / 1e6), 'ms')
      else concat(printf('%.2f', duration_ns / 1e6 / 1000), 's') end as label from spans""",
}
