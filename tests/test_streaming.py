"""Streams run to their end give what the batch operators give."""

import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from logloom.operators import aggregate as ag
from logloom.streaming import ingest as si
from logloom.streaming import live, tail


def event_stream(spark, folder, batches):
    """A stream with one micro-batch per given list of (sequence, second, raw)."""
    schema = "sequence bigint, event_time timestamp, raw string, status string"
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "sequence bigint, s bigint, raw string")
        df = df.select("sequence", F.timestamp_seconds("s").alias("event_time"), "raw", F.lit("error").alias("status"))
        df.coalesce(1).write.mode("append").parquet(f"{folder}/in/b{i}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")


def test_overlapping_polls_show_an_event_once(spark, tmp_path):
    polls = [
        [(1, 10, "error a"), (2, 11, "error healthz"), (3, 12, "fine")],
        [(2, 11, "error healthz"), (3, 12, "fine"), (4, 14, "error b"), (1, 10, "error a")],
        [(4, 14, "error b"), (None, 15, "error c"), (None, 15, "error c"), (None, 15, "error d")],
    ]
    stream = event_stream(spark, tmp_path, polls)
    kept = tail.tail(stream, "30 seconds", include=["error"], exclude=["healthz"])
    writer = kept.writeStream.format("parquet").option("path", f"{tmp_path}/out")
    tail.catch_up(writer, f"{tmp_path}/checkpoint")
    got = sorted(r["raw"] for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == ["error a", "error b", "error c", "error d"]
    # a second run from the checkpoint finds nothing new
    tail.catch_up(writer, f"{tmp_path}/checkpoint")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4


def test_batches_are_ordered_inside(spark, tmp_path):
    stream = event_stream(spark, tmp_path, [[(3, 12, "c"), (2, 9, "b"), (1, 9, "a")], [(5, 8, "late"), (4, 10, "d")]])
    seen = []
    tail.catch_up(
        tail.ordered_batches(stream, lambda batch, epoch: seen.append([r["raw"] for r in batch.collect()])),
        f"{tmp_path}/checkpoint",
    )
    assert sorted(seen) == [["a", "b", "c"], ["late", "d"]]


def test_sliding_windows_equal_batch(spark, tmp_path):
    polls = [[(i, i * 7, "x" if i % 3 else "y") for i in range(n, n + 20)] for n in (0, 20, 40)]
    stream = event_stream(spark, tmp_path, polls)
    rows = live.live_aggregate(stream, "1 minute", "20 seconds", ["raw"], {"n": ag.count()})
    tail.catch_up(live.upsert_files(rows, f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
    got = live.latest_rows(spark, f"{tmp_path}/out", ["window_start", "window_end", "raw"])
    static = spark.read.parquet(f"{tmp_path}/in/*")
    expected = live.live_aggregate(static, "1 minute", "20 seconds", ["raw"], {"n": ag.count()})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_trend_keeps_history_across_batches(spark, tmp_path):
    live.use_rocksdb(spark)
    for start in (0, 6, 12):
        rows = [("a", t, t) for t in range(start, start + 6)] + [("b", start, 1)]
        spark.createDataFrame(rows, "g string, tick bigint, v bigint").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{start:02}")
    ticks = spark.readStream.schema("g string, tick bigint, v bigint").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    rows = live.live_trend(ticks, "g", "tick", "v")
    tail.catch_up(rows.writeStream.format("parquet").option("path", f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
    got = {(r["group"], r["tick"]): r["history"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got["a", 17] == [float(v) for v in range(6, 18)] and got["b", 12] == [1.0, 1.0, 1.0]


def test_line_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text('plain\n\n{"message":"m","timestamp":"t","k":1}\n')
    as_of = datetime(2026, 7, 7, 12, tzinfo=timezone.utc)
    writer = si.stream_ingest(si.read_line_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), as_of, "web", "app")
    tail.catch_up(writer, str(tmp_path / "checkpoint"))
    (tmp_path / "in" / "b.log").write_text("later\n")
    tail.catch_up(writer, str(tmp_path / "checkpoint"))
    rows = spark.read.text(str(tmp_path / "out")).collect()
    events = sorted((json.loads(r["value"]) for r in rows), key=lambda e: e["message"])
    assert [e["message"] for e in events] == ["later", "m", "plain"]
    assert events[1] == {"message": "m", "timestamp": "t", "k": 1} and rows[0]["dataset"] == "web"
