"""Streaming operators run to the end of the event table, against their batch meaning.

Each run writes below the cluster's shared folder and is read back from there.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions import predicates as p
from logloom.operators.lint import Monitor
from logloom.plans.ingests import AS_OF, LINES_SQL, STAMP, ingest_lines
from logloom.plans.views import LOG_EVENTS_SQL, table
from logloom.session import shared_dir
from logloom.streaming import ingest as si
from logloom.streaming import live, tail
from logloom.streaming.poll import poll

# Longer than the whole table spans: a replay in any file order loses nothing.
# The keys then stay in state to the end, on disk in RocksDB rather than on the heap.
REPLAY = "3650 days"


def _workspace(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/streams-{uuid.uuid4().hex}"


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of log events."""
    schema = table(spark, sf_dir, "events").schema
    # a pattern, since the table may be one file or a folder of files
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return rows.select(
        F.col("event_id").alias("sequence"),
        F.to_timestamp_ltz(F.col("ts").cast("string")).alias("event_time"),
        F.col("event_type").alias("status"),
        F.concat(F.lit("user-"), (F.col("user_id") % 5).cast("string")).alias("origin"),
        F.col("props").alias("raw"),
        "value",
    )


def _appended(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run an append stream to its end and read the result."""
    live.use_rocksdb(spark)
    where = _workspace(spark)
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", f"{where}/out")
    tail.catch_up(writer, f"{where}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{where}/out")


def _updated(spark: SparkSession, stream: DataFrame, keys: list[str]) -> DataFrame:
    live.use_rocksdb(spark)
    where = _workspace(spark)
    tail.catch_up(live.upsert_files(stream, f"{where}/out"), f"{where}/checkpoint")
    return live.latest_rows(spark, f"{where}/out", keys)


def _utc(*columns: str):
    """Windows as plain timestamps in the session's zone."""
    return [F.col(c).cast("timestamp_ntz").alias(c) for c in columns]


def _tail_dedup(spark, sf_dir):
    """Every event delivered twice, as overlapping polls do."""
    events = event_stream(spark, sf_dir)
    twice = events.unionByName(event_stream(spark, sf_dir))
    kept = tail.tail(
        twice, REPLAY, include=[r"\d"], exclude=["9}$"], exclude_fields=[("@origin", "4$")]
    )
    return _appended(spark, kept).select("sequence", "status", "severity", "raw")


def _window_counts(spark, sf_dir):
    stream = event_stream(spark, sf_dir)
    rows = live.live_aggregate(
        stream, "1 day", "12 hours", ["status"], {"n": F.count(F.lit(1)), "top": F.max("value")}
    )
    keys = ["window_start", "window_end", "status"]
    return _updated(spark, rows, keys).select(*_utc("window_start", "window_end"), "status", "n", "top")


def _histogram(spark, sf_dir):
    rows = live.live_histogram(event_stream(spark, sf_dir), "3 hours")
    return _updated(spark, rows, ["window_start", "window_end"]).select(
        *_utc("window_start", "window_end"), "count"
    )


def _monitor(spark, sf_dir):
    monitor = Monitor("ABOVE_OR_EQUAL", 60, timedelta(days=1), ["origin"], where=p.eq("@status", "error"))
    rows = live.live_monitor(event_stream(spark, sf_dir), monitor, "1 day")
    return _updated(spark, rows, ["window_start", "window_end", "origin"]).select(
        *_utc("window_start", "window_end"), "origin", "value", "breached"
    )


def _trend(spark, sf_dir):
    """Daily counts per type as ticks; the stream of ticks keeps a 12-value history."""
    events = table(spark, sf_dir, "events")
    daily = events.groupBy(
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_type"
    ).agg(F.count(F.lit(1)).alias("n"))
    where = _workspace(spark)
    daily.write.parquet(f"{where}/ticks")
    ticks = spark.readStream.schema(daily.schema).parquet(f"{where}/ticks")
    rows = _appended(spark, live.live_trend(ticks, "event_type", "day", "n"))
    history = F.array_join(F.transform("history", lambda x: x.cast("bigint").cast("string")), ",")
    return rows.select("group", "tick", F.col("value").cast("bigint").alias("n"), history.alias("history"))


def _ordered(spark, sf_dir):
    """Batches written in time order; the place inside its file shows it."""
    where = _workspace(spark)

    def sink(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{where}/out/epoch={epoch}")

    tail.catch_up(tail.ordered_batches(event_stream(spark, sf_dir), sink), f"{where}/checkpoint")
    return spark.read.parquet(f"{where}/out").select("sequence", *_utc("event_time"), "status")


def _stream_ingest(spark, sf_dir):
    """Lines written as text files, ingested as a stream, read back as JSON."""
    where = _workspace(spark)
    ingest_lines(spark, sf_dir).select("value").write.text(f"{where}/in")
    lines = si.read_line_stream(spark, f"{where}/in")
    tail.catch_up(si.stream_ingest(lines, f"{where}/out", AS_OF, "events", "app"), f"{where}/checkpoint")
    schema = "message string, timestamp string, n bigint, collection string, dataset string"
    rows = spark.read.schema(schema).json(f"{where}/out")
    return rows.groupBy("collection", "dataset", "message", "timestamp", "n").agg(F.count(F.lit(1)).alias("events"))


def _polls(spark, sf_dir):
    """A month of a growing event table, replayed in polls of five days that look back eight."""
    where = _workspace(spark)
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("sequence"), F.to_timestamp_ltz(F.col("ts").cast("string")).alias("event_time"), F.col("event_type").alias("dataset")
    )
    events.write.partitionBy("dataset").parquet(f"{where}/table")
    begin = datetime(2024, 1, 1)
    polls = poll(
        spark, f"{where}/table", begin, f"{where}/positions", begin + timedelta(days=31), interval="5d", window="8d", limit=2**62
    )
    writer = polls.writeStream.format("parquet").option("path", f"{where}/out")
    query = tail.follow(writer, f"{where}/checkpoint", "0 seconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(polls.schema).parquet(f"{where}/out").select("sequence", *_utc("event_time", "poll_end"))


def _bounded(spark, sf_dir):
    """Every event delivered twice in a row, as by a sender that retries."""
    events = event_stream(spark, sf_dir)
    twice = events.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    return _appended(spark, tail.dedup_bounded(twice)).select("sequence", "status", "raw")


def _dense(spark, sf_dir):
    """Clicks per half hour from before the first event on, up to the watermark."""
    clicks = event_stream(spark, sf_dir).filter("status = 'click'")
    rows = _appended(spark, live.live_dense_histogram(clicks, "30m", datetime(2023, 12, 31, 21, 10), "1 hour"))
    return rows.select(*_utc("window_start", "window_end"), "count")


def _top(spark, sf_dir):
    """The three types and origins with most events of each two days, every day, up to the watermark."""
    aggs = {"n": F.count(F.lit(1)), "top": F.max("value")}
    rows = _appended(
        spark, live.live_top_groups(event_stream(spark, sf_dir), "2 days", "1 day", ["status", "origin"], "1 hour", aggs, n=3)
    )
    return rows.select(*_utc("window_start", "window_end"), "group", "n", "top")


def _sent(spark, sf_dir):
    """Lines in batches of up to forty per sender; the last ones close with the end of the input."""
    live.use_rocksdb(spark)
    where = _workspace(spark)
    ingest_lines(spark, sf_dir).select("value").write.text(f"{where}/in/a")
    spark.createDataFrame([("END",)], "value string").coalesce(1).write.text(f"{where}/in/b")
    lines = spark.readStream.schema("value string").text(f"{where}/in/*")
    batches = si.stream_batches(lines, "value", F.col("value") == "END", senders=4, max_events=40, flush_ms=None)
    sent = _appended(spark, batches).select(F.explode("events").alias("value"), (F.size("events") <= 40).alias("fits"))
    return sent.groupBy("value", "fits").agg(F.count(F.lit(1)).alias("events"))


QUERIES = {
    "tail_polls": _polls,
    "tail_dedup_bounded": _bounded,
    "live_dense_histogram": _dense,
    "live_top_groups": _top,
    "stream_batches": _sent,
    "tail_dedup": _tail_dedup,
    "ordered_batches": _ordered,
    "live_window_counts": _window_counts,
    "live_histogram": _histogram,
    "live_monitor": _monitor,
    "live_trend": _trend,
    "stream_ingest": _stream_ingest,
}

_BUCKET = "time_bucket(interval '{w}', ts, timestamp '2024-01-01')"

ORACLES = {
    "tail_polls": """with polls as (select least(timestamp '2024-01-01' + to_days(cast(5 * i as int)), timestamp '2024-02-01') poll_end
  from unnest(generate_series(1, 7)) g(i))
select event_id as sequence, ts as event_time, poll_end from events join polls on ts < poll_end and ts >= poll_end - interval 8 days""",
    "tail_dedup_bounded": "select event_id as sequence, event_type as status, props as raw from events",
    "live_dense_histogram": """with clicks as (select ts, cast(floor(epoch(ts - timestamp '2023-12-31 21:10:00') / 1800) as bigint) slice
  from events where event_type = 'click'),
done as (select cast(floor(epoch(date_trunc('millisecond', max(ts)) - interval 1 hour - timestamp '2023-12-31 21:10:00') / 1800) as bigint) n from clicks),
slices as (select unnest(range(n)) slice from done)
select timestamp '2023-12-31 21:10:00' + to_minutes(cast(30 * s.slice as bigint)) window_start,
 timestamp '2023-12-31 21:10:00' + to_minutes(cast(30 * (s.slice + 1) as bigint)) window_end, count(ts) as count
from slices s left join clicks using (slice) group by s.slice""",
    "live_top_groups": """with w as (select date_trunc('day', ts)::timestamp - to_days(i) window_start, concat(event_type, ', user-', cast(user_id % 5 as varchar)) "group", value
  from events, unnest([0, 1]) g(i)),
g as (select window_start, window_start + interval 2 days window_end, "group", count(*) n, max(value) top from w group by 1, 2, 3)
select * from g where window_end <= (select date_trunc('millisecond', max(ts)) - interval 1 hour from events)
qualify row_number() over (partition by window_start order by n desc, "group") <= 3""",
    "stream_batches": f"""with {LINES_SQL} select value, true fits, count(*) events from lines group by 1""",
    "tail_dedup": """select event_id as sequence, event_type as status, case event_type when 'error' then 'error' else 'other' end severity,
 props as raw from events where regexp_matches(props, '\\d') and not regexp_matches(props, '9}$') and user_id % 5 <> 4""",
    "ordered_batches": "select event_id as sequence, ts as event_time, event_type as status from events",
    "live_window_counts": f"""with w as (
 select {_BUCKET.format(w='12 hours')} - to_hours(12 * i) window_start, event_type as status, value
 from events, unnest(generate_series(0, 1)) g(i))
select window_start, window_start + interval 1 day window_end, status, count(*) n, max(value) top from w group by 1, 2, 3""",
    "live_histogram": f"""select {_BUCKET.format(w='3 hours')} window_start,
 {_BUCKET.format(w='3 hours')} + interval 3 hours window_end, count(*) as count from events group by 1, 2""",
    "live_monitor": """select date_trunc('day', ts)::timestamp window_start, date_trunc('day', ts)::timestamp + interval 1 day window_end,
 concat('user-', cast(user_id % 5 as varchar)) origin, count(*) as value, count(*) >= 60 breached
from events where event_type = 'error' group by 1, 2, 3""",
    "live_trend": """with d as (select date_trunc('day', ts)::timestamp tick, event_type as "group", count(*) n from events group by 1, 2)
select "group", tick, n, array_to_string(list(n) over (partition by "group" order by tick rows between 11 preceding and current row), ',') history
from d""",
    "stream_ingest": f"""with {LINES_SQL}, e as (select 'app' collection, 'events' dataset,
 case event_id % 6 when 0 then concat('<', event_type, '>') else value end message,
 case event_id % 6 when 0 then 't1' when 3 then '5' else '{STAMP}' end as timestamp,
 case when event_id % 6 in (0, 1, 3) then cast(k as bigint) end n from lines)
select *, count(*) events from e group by all""",
}
