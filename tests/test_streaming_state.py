"""Stateful streaming operators: bounded memory, timers, and their batch twins."""

import time
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from logloom.operators import series
from logloom.streaming import ingest as si
from logloom.streaming import live, tail

T0 = datetime(2026, 7, 7, 12, tzinfo=timezone.utc)


@pytest.fixture(autouse=True)
def rocksdb(spark):
    live.use_rocksdb(spark)


def files(spark, folder, schema, batches):
    """A stream that takes one file, in order, per micro-batch."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/b{i:03}")
        time.sleep(0.01)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def run(stream, folder):
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out")
    query = tail.catch_up(writer, f"{folder}/checkpoint")
    return query, stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


def follow_until(stream, folder, rows, rest=0):
    """Follow until so many rows are out, for a minute at most, and ``rest`` seconds more: rows in the state per batch, and what is out."""
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out")
    query = tail.follow(writer, f"{folder}/checkpoint", "200 milliseconds")
    try:
        deadline, found = time.time() + 60, []
        while time.time() < deadline and len(found) < rows:
            time.sleep(0.5)
            if query.exception():
                raise query.exception()
            if list(Path(folder).glob("out/*.parquet")):
                found = stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out").collect()
        time.sleep(rest)
        return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]], found
    finally:
        query.stop()


def twin(keys, capacity):
    seen, order, out = set(), [], []
    for key in keys:
        if key in seen:
            continue
        if len(order) >= capacity:
            half = len(order) // 2
            seen -= set(order[:half])
            order = order[half:]
        seen.add(key)
        order.append(key)
        out.append(key)
    return out


def test_bounded_memory_forgets_the_oldest_half(spark, tmp_path):
    keys = [*range(150), *range(40, 160), *range(30), *range(155, 165), *range(300), *range(250, 310)]
    batches = [[(k, T0, f"r{k}") for k in keys[i : i + 70]] for i in range(0, len(keys), 70)]
    stream = files(spark, tmp_path / "in", "sequence bigint, event_time timestamp, raw string", batches)
    query, out = run(tail.dedup_bounded(stream, capacity=100, buckets=1), tmp_path)
    assert sorted(r["sequence"] for r in out.collect()) == sorted(twin(keys, 100)) and out.columns == stream.columns
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1
    with pytest.raises(ValueError):
        tail.dedup_bounded(stream, capacity=10, buckets=8)


def test_nothing_comes_twice_within_the_bound(spark, tmp_path):
    batches = [[(k % 90, T0, "x") for k in range(i, i + 60)] for i in range(0, 600, 60)]
    stream = files(spark, tmp_path / "in", "sequence bigint, event_time timestamp, raw string", batches)
    _, out = run(tail.dedup_bounded(stream, capacity=4_000, buckets=8), tmp_path)
    assert sorted(r["sequence"] for r in out.collect()) == list(range(90))


def test_trend_starts_with_a_history_and_forgets_idle_groups(spark, tmp_path):
    schema = "g string, tick bigint, v bigint"
    before = spark.createDataFrame([("a", [1.0, 2.0]), ("c", [9.0])], "group string, history array<double>")
    stream = files(spark, tmp_path / "in", schema, [[("a", 1, 3), ("b", 1, 7)]])
    make = lambda s: live.live_trend(s, "g", "tick", "v", n=3, ttl="4s", before=before)
    held, _ = follow_until(make(stream), tmp_path, 2, rest=8)
    assert max(held) == 3 and held[-1] == 0
    spark.createDataFrame([("a", 2, 4)], schema).coalesce(1).write.parquet(f"{tmp_path}/in/b900")
    _, out = follow_until(make(stream), tmp_path, 3)
    got = {(r["group"], r["tick"]): r["history"] for r in out}
    assert got == {("a", 1): [1.0, 2.0, 3.0], ("b", 1): [7.0], ("a", 2): [4.0]}


def test_dense_histogram_equals_batch(spark, tmp_path):
    seconds = [5, 7, 70, 71, 72, 400, 401, 30, 420, 1000, 1001, 1290, 3]
    rows = [(T0 + timedelta(seconds=s),) for s in seconds]
    # 30 comes within the watermark of two minutes, the last row after it
    batches = [rows[:3], rows[3:7], [(T0 + timedelta(seconds=300),)], rows[8:12], rows[12:], [(T0 + timedelta(seconds=1300),)]]
    stream = files(spark, tmp_path / "in", "event_time timestamp", batches)
    query, out = run(live.live_dense_histogram(stream, "1m", T0, "2 minutes"), tmp_path)
    static = spark.createDataFrame([r for b in batches for r in b if r != rows[12]], "event_time timestamp")
    n = (1300 - 120) // 60
    want = series.histogram(static, T0, T0 + timedelta(minutes=n), n).collect()
    got = sorted((r["window_start"].replace(tzinfo=timezone.utc), r["count"]) for r in out.collect())
    assert got == [(T0 + timedelta(minutes=r["slice"]), r["count"]) for r in want] and 0 in {c for _, c in got}
    assert live.late_rows(query) == 1


def test_top_groups_per_closed_window(spark, tmp_path):
    rows = [(T0 + timedelta(seconds=7 * i), f"g{i % (3 + i // 40)}", i) for i in range(300)]
    late = [(T0 + timedelta(seconds=1), "g0", 0)] * 3
    batches = [rows[:120], rows[120:240], late, rows[240:]]
    stream = files(spark, tmp_path / "in", "event_time timestamp, g string, v bigint", batches)
    aggs = {"n": F.count(F.lit(1)), "top": F.max("v")}
    query, out = run(live.live_top_groups(stream, "10 minutes", "5 minutes", ["g"], "1 minute", aggs, n=2, parts=3), tmp_path)
    assert live.late_rows(query) == 2  # of two windows, put together within their task
    counts = {}
    for t, g, v in rows:
        at = int((t - T0).total_seconds()) // 300
        for w in (at - 1, at):
            n, top = counts.get((w, g), (0, 0))
            counts[w, g] = (n + 1, max(top, v))
    closed = (7 * 299 - 60) // 300 - 2
    want = []
    for w in range(-1, closed + 1):
        best = sorted((-n, g, top) for (x, g), (n, top) in counts.items() if x == w)[:2]
        want += [(T0 + timedelta(minutes=5 * w), g, -n, top) for n, g, top in best]
    got = sorted((r["window_start"].replace(tzinfo=timezone.utc), r["group"], r["n"], r["top"]) for r in out.collect())
    assert got == sorted(want)


def batches_of(out):
    return sorted((r["sender"], r["batch"], r["cause"], sorted(r["events"])) for r in out.collect())


def test_batches_close_on_events_bytes_and_end(spark, tmp_path):
    schema = "event string, over boolean"
    batches = [[(f"e{i}", None) for i in range(5)], [("x" * 100, False)], [("y", None), ("z", None), ("", True)]]
    stream = files(spark, tmp_path / "in", schema, batches)
    made = si.stream_batches(stream, ends=F.col("over"), senders=1, max_events=4, max_bytes=50, flush_ms=None)
    _, out = run(made, tmp_path)
    got = batches_of(out)
    assert [(b, c, len(e)) for _, b, c, e in got] == [(0, "events", 4), (1, "bytes", 2), (2, "end", 2)]
    assert sorted(e for g in got for e in g[3]) == sorted([f"e{i}" for i in range(5)] + ["x" * 100, "y", "z"])
    # nothing new: nothing is sent again
    _, out = run(made, tmp_path)
    assert batches_of(out) == got


def test_batches_close_on_time_and_survive_a_restart(spark, tmp_path):
    schema = "event string"
    stream = files(spark, tmp_path / "in", schema, [[("a",), ("b",)]])
    make = lambda: si.stream_batches(stream, senders=2, flush_ms=700)
    follow_until(make(), tmp_path, 1)
    spark.createDataFrame([("c",)], schema).coalesce(1).write.parquet(f"{tmp_path}/in/b900")
    _, got = follow_until(make(), tmp_path, 3)
    assert sorted(e for r in got for e in r["events"]) == ["a", "b", "c"] and {r["cause"] for r in got} == {"time"}
