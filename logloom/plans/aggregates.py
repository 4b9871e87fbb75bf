"""Grouped, sliced and trailing aggregates over events and orders."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from logloom.functions import predicates as p
from logloom.functions.text import event_time_ms
from logloom.operators import aggregate as ag
from logloom.operators import series as se
from logloom.operators.columns import group_rows, parse_group, select, series_rows
from logloom.operators.lint import Monitor, evaluate_monitor, monitor_history
from logloom.plans.views import LOG_EVENTS_SQL, log_events, parsed_events, table

START, END = datetime(2024, 1, 1), datetime(2024, 1, 31)


def _round6(column: str):
    return F.round(column, 6).alias(column)


def _group_avg_max(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rows = ag.group(
        events,
        ["event_type"],
        {
            "n": ag.count(),
            "avg_value": ag.avg(events, "value"),
            "max_value": ag.maximum(events, "value"),
            "min_value": ag.minimum(events, "value"),
        },
    )
    return rows.select("event_type", "n", _round6("avg_value"), "max_value", "min_value")


def _group_fields(spark, sf_dir):
    parsed = parsed_events(spark, sf_dir, ["type", "amount"])
    rows = ag.group(
        parsed, ["origin", "type"], {"n": ag.count(), "total_amount": ag.total(parsed, "amount")}
    )
    return rows.select("origin", "type", "n", _round6("total_amount"))


def _totals(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rows = ag.totals(
        orders,
        {"n": ag.count(), "avg_price": ag.avg(orders, "o_totalprice"), "max_price": ag.maximum(orders, "o_totalprice")},
    )
    return rows.select("n", F.round("avg_price", 4).alias("avg_price"), "max_price")


def _top_groups(spark, sf_dir):
    grouped = ag.group(table(spark, sf_dir, "orders"), ["o_custkey"])
    return ag.top_groups(grouped, ["o_custkey"], 20)


def _missing(include):
    def run(spark, sf_dir):
        grouped = ag.group(parsed_events(spark, sf_dir, ["type"]), ["type", "origin"])
        return ag.missing(grouped, ["type"], include)

    return run


def _dropped(spark, sf_dir):
    grouped = ag.group(parsed_events(spark, sf_dir, ["type"]), ["type", "origin"])
    return ag.dropped_groups(grouped, ["type"])


def _series(spark, sf_dir):
    return se.series(
        parsed_events(spark, sf_dir, ["type"]), 12, START, END, ["type"],
    )


def _histogram(spark, sf_dir):
    return se.histogram(log_events(spark, sf_dir), START, END)


def _histogram_filtered(spark, sf_dir):
    rare = parsed_events(spark, sf_dir, ["type", "k"]).filter(p.eq("type", "error") & p.gt("k", 95))
    return se.histogram(rare, START, END, 500)


def _usage(spark, sf_dir):
    return se.usage(log_events(spark, sf_dir), "6 hours")


def _daily(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n")
    )


def _trailing(spark, sf_dir):
    rows = se.trailing(_daily(spark, sf_dir), "event_type", "day", "n")
    return rows.select(
        "event_type", "day", "n", F.array_join(F.transform("history", lambda x: x.cast("string")), ",").alias("history")
    )


def _levels(spark, sf_dir):
    rows = se.trailing(_daily(spark, sf_dir), "event_type", "day", "n")
    level = F.transform(se.levels("history"), lambda x: x.cast("string"))
    return rows.select("event_type", "day", F.array_join(level, "").alias("levels"))


def _snapshot(spark, sf_dir):
    parsed = parsed_events(spark, sf_dir, ["type"])
    return ag.snapshot(parsed, keys=["type", "origin"], n=12)


def _series_rows(spark, sf_dir):
    """Nested usage payloads built from the events, unnested again."""
    events = log_events(spark, sf_dir)
    hourly = events.groupBy(
        F.col("status").alias("name"), F.date_trunc("hour", "event_time").alias("h")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("raw")).alias("b"))
    label = F.concat(
        F.date_format("h", "EEE MMM d HH:mm:ss"), F.lit(" UTC "), F.date_format("h", "yyyy")
    )
    # one array entry per hour: its length follows the time range, not the events
    nested = hourly.groupBy("name").agg(
        F.collect_list(
            F.struct(
                label.alias("time"),
                F.col("n").cast("string").alias("count"),
                F.concat(F.col("b").cast("string"), F.lit(".0")).alias("value"),
            )
        ).alias("series")
    )
    return series_rows(nested, multi=True)


def _group_texts(events):
    """Dumped group keys in every accepted spelling."""
    kind = F.col("event_id") % 5
    name, user = F.col("event_type"), F.col("user_id").cast("string")
    return (
        F.when(kind == 0, F.concat(F.lit('["'), name, F.lit('",'), user, F.lit(",null]")))
        .when(kind == 1, F.concat(F.lit('{"z":"'), name, F.lit('","a":'), user, F.lit("}")))
        .when(kind == 2, F.concat(F.lit("["), name, F.lit(", "), user, F.lit("]")))
        .when(kind == 3, F.concat(F.lit(" "), name))
        .otherwise(F.lit("[]"))
    )


def _parse_group(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.array_join(parse_group(_group_texts(events)), "|").alias("parts"))


def _group_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    counted = events.groupBy(_group_texts(events).alias("group")).agg(F.count(F.lit(1)).alias("n"))
    rows = group_rows(counted, "group", ["first", "second"])
    return rows.groupBy("first", "second").agg(F.sum("n").alias("n"))


def _event_times(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    kind = F.col("event_id") % 4
    ms = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    text = (
        F.when(kind == 0, F.concat(ms, F.lit(" UTC")))
        .when(kind == 1, F.concat(F.replace(ms, F.lit(" "), F.lit("T")), F.lit("Z")))
        .when(kind == 2, F.unix_millis(F.col("ts").cast("timestamp")).cast("string"))
        .otherwise(F.concat(F.lit("on "), ms))
    )
    return events.select("event_id", event_time_ms(text).alias("ms"))


_MONITOR = dict(threshold=12.0, window=timedelta(days=1))


def _monitor(spark, sf_dir):
    # rows of a dimension no larger than the event types
    monitor = Monitor("ABOVE", keys=["origin"], where=p.eq("@status", "error"), **_MONITOR)
    return evaluate_monitor(log_events(spark, sf_dir), monitor, datetime(2024, 1, 16))


def _monitor_history(spark, sf_dir):
    monitor = Monitor("BELOW_OR_EQUAL", keys=["origin"], where=p.eq("@status", "error"), **_MONITOR)
    return monitor_history(log_events(spark, sf_dir), monitor, "6 hours")


QUERIES = {
    "group_count": lambda s, d: ag.group(parsed_events(s, d, ["type"]), ["type"]),
    "group_avg_max": _group_avg_max,
    "group_two_keys": _group_fields,
    "totals": _totals,
    "top_groups": _top_groups,
    "missing_labelled": _missing(True),
    "missing_dropped": _missing(False),
    "dropped_groups": _dropped,
    "series_by_group": _series,
    "histogram": _histogram,
    "histogram_filtered": _histogram_filtered,
    "histogram_summary": lambda s, d: se.histogram_summary(_histogram(s, d)),
    "usage_rollup": _usage,
    "series_rows": _series_rows,
    "trailing_history": _trailing,
    "trend_levels": _levels,
    "snapshot": _snapshot,
    "parse_group": _parse_group,
    "group_rows": _group_rows,
    "event_times": _event_times,
    "monitor_eval": _monitor,
    "monitor_history": _monitor_history,
}

_SLICE = "cast(floor((epoch_us(event_time) - epoch_us(timestamp '2024-01-01')) * {n} // (30 * 86400000000)) as bigint)"
_DAILY = """daily as (select cast(date_trunc('day', ts) as timestamp) as day, event_type, count(*) n from events group by 1, 2),
hist as (select event_type, day, n, list(n) over (partition by event_type order by day rows between 11 preceding and current row) h from daily)"""
_GROUP_TEXT = """case event_id % 5 when 0 then concat(event_type, '|', cast(user_id as varchar), '|')
  when 1 then concat(cast(user_id as varchar), '|', event_type)
  when 2 then concat(event_type, '|', cast(user_id as varchar)) when 3 then event_type else '' end"""


def _histogram_sql(n: int, where: str = "true") -> str:
    return f"""with {LOG_EVENTS_SQL},
c as (select {_SLICE.format(n=n)} slice, count(*) n from parsed
      where event_time >= timestamp '2024-01-01' and event_time < timestamp '2024-01-31' and {where} group by 1)
select i as slice, cast((i * (30 * 86400000000) // {n} + epoch_us(timestamp '2024-01-01')) // 1000 as bigint) as timestamp,
       coalesce(c.n, 0) as count
from (select unnest(generate_series(0, {n - 1})) i) left join c on c.slice = i"""


ORACLES = {
    "group_count": f"with {LOG_EVENTS_SQL} select f_type as type, count(*) as count from parsed group by 1",
    "group_avg_max": """select event_type, count(*) n, round(avg(value), 6) avg_value, max(value) max_value,
 min(value) min_value from events group by 1""",
    "group_two_keys": f"""with {LOG_EVENTS_SQL} select origin, f_type as type, count(*) n,
 round(sum(try_cast(f_amount as double)), 6) total_amount from parsed group by 1, 2""",
    "totals": "select count(*) n, round(avg(o_totalprice), 4) avg_price, max(o_totalprice) max_price from orders",
    "top_groups": """select o_custkey, count(*) as count from orders group by 1
order by count desc, o_custkey limit 20""",
    "missing_labelled": f"""with {LOG_EVENTS_SQL} select coalesce(f_type, '<missing>') as type, origin, count(*) as count
from parsed group by 1, 2""",
    "missing_dropped": f"""with {LOG_EVENTS_SQL} select f_type as type, origin, count(*) as count from parsed
where f_type is not null group by 1, 2""",
    "dropped_groups": f"""with {LOG_EVENTS_SQL} select count(distinct origin) dropped from parsed where f_type is null""",
    "series_by_group": f"""with {LOG_EVENTS_SQL} select {_SLICE.format(n=12)} slice, f_type as type, count(*) as count
from parsed where event_time >= timestamp '2024-01-01' and event_time < timestamp '2024-01-31' group by 1, 2""",
    "histogram": _histogram_sql(24),
    "histogram_filtered": _histogram_sql(
        500, "f_type = 'error' and try_cast(f_k as double) > 95"
    ),
    "histogram_summary": f"""select cast(sum(count) as bigint) total, max(count) max_count,
 cast(30 * 3600000 as bigint) width_ms from ({_histogram_sql(24)})""",
    "usage_rollup": f"""with {LOG_EVENTS_SQL}
select time_bucket(interval '6 hours', event_time, timestamp '2024-01-01') as time, count(*) events,
 cast(sum(octet_length(encode(raw))) as bigint) volume from log_events group by 1""",
    "series_rows": f"""with {LOG_EVENTS_SQL}
select status metric, strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M') as time,
 cast(count(*) as double) events, cast(sum(octet_length(encode(raw))) as double) volume
from log_events group by 1, 2""",
    "trailing_history": f"""with {_DAILY} select event_type, day, n, array_to_string(h, ',') history from hist""",
    "trend_levels": f"""with {_DAILY} select event_type, day,
 array_to_string(list_transform(h, lambda x: cast(floor(x / list_max(h) * 7) as int)), '') levels from hist""",
    "snapshot": f"""with {LOG_EVENTS_SQL}, g as (
 select concat(coalesce(f_type, ''), ', ', origin) as "group", count(*) as count from parsed group by f_type, origin)
select "group", count from g order by count desc, "group" limit 12""",
    "parse_group": f"select event_id, {_GROUP_TEXT} parts from events",
    "group_rows": f"""select string_split(t, '|')[1] as first, coalesce(string_split(t, '|')[2], '') as second,
 cast(count(*) as bigint) n from (select {_GROUP_TEXT} t from events) group by 1, 2""",
    "event_times": """select event_id, case when event_id % 4 < 3 then epoch_us(ts) // 1000 end ms from events""",
    "monitor_eval": f"""with {LOG_EVENTS_SQL} select origin, count(*) as value, count(*) > 12 breached from log_events
where status = 'error' and event_time >= timestamp '2024-01-15' and event_time < timestamp '2024-01-16' group by 1""",
    "monitor_history": f"""with {LOG_EVENTS_SQL}, w as (
  select time_bucket(interval '6 hours', event_time, timestamp '2024-01-01') - to_hours(6 * i) window_start, origin
  from log_events, unnest(generate_series(0, 3)) g(i) where status = 'error')
select window_start, window_start + interval 1 day window_end, origin, count(*) as value, count(*) <= 12 breached
from w group by 1, 2, 3""",
}
