"""The polling tail reads what batch reads of the same windows return."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from logloom.streaming import tail
from logloom.streaming.poll import poll

T0 = datetime(2026, 7, 7, 12, tzinfo=timezone.utc)


def write(spark, folder, rows):
    df = spark.createDataFrame(rows, "sequence bigint, s double, raw string")
    df = df.select("sequence", F.timestamp_micros((F.unix_micros(F.lit(T0)) + F.col("s") * 1e6).cast("bigint")).alias("event_time"), "raw")
    df.withColumn("dataset", F.concat(F.lit("d"), F.col("sequence") % 2)).write.mode("append").partitionBy("dataset").parquet(folder)


def drain(stream, out, checkpoint):
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def polls(spark, out):
    seen = {}
    for r in spark.read.parquet(out).collect():
        seen.setdefault((r["poll_end"].replace(tzinfo=timezone.utc) - T0).total_seconds(), []).append(r["sequence"])
    return {end: sorted(s) for end, s in sorted(seen.items())}


def test_windows_and_restart(spark, tmp_path):
    rows = [(i, i * 1.5, f"e{i}") for i in range(40)]  # 0 .. 58.5 s
    write(spark, str(tmp_path / "t"), rows)
    args = {"start": T0, "positions": str(tmp_path / "p"), "interval": "10s", "window": "25s", "limit": 1000}
    half = poll(spark, str(tmp_path / "t"), until=T0 + timedelta(seconds=30), **args)
    assert half.columns == ["sequence", "event_time", "raw", "dataset", "poll_end"]
    drain(half, str(tmp_path / "out"), str(tmp_path / "c"))
    write(spark, str(tmp_path / "t"), [(100, 22.0, "late"), (101, 2.0, "too late")])
    rest = poll(spark, str(tmp_path / "t"), until=T0 + timedelta(seconds=60), **args)
    drain(rest, str(tmp_path / "out"), str(tmp_path / "c"))
    want = {end: [i for i, s, _ in rows if end - 25 <= s < end] for end in range(10, 61, 10)}
    want[40].append(100)
    assert polls(spark, str(tmp_path / "out")) == want


def test_limit_slows_but_loses_nothing(spark, tmp_path):
    rows = [(i, float(i // 4), "x") for i in range(100)] + [(200 + i, 30.0, "burst") for i in range(50)]
    write(spark, str(tmp_path / "t"), rows)
    stream = poll(
        spark, str(tmp_path / "t"), T0, str(tmp_path / "p"), until=T0 + timedelta(seconds=60), interval="20s", window="1s", limit=10
    )
    kept = tail.dedup(stream, "60 seconds")
    drain(kept, str(tmp_path / "out"), str(tmp_path / "c"))
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["sequence"] for r in found.collect()) == sorted(i for i, _, _ in rows)
    # the instant with 50 rows comes whole, the others in polls of two instants
    counts = found.groupBy("poll_end").count().collect()
    assert sorted(r["count"] for r in counts)[-1] == 50 and all(r["count"] <= 10 for r in counts if r["count"] != 50)


def test_follows_the_clock(spark, tmp_path):
    now = datetime.now(timezone.utc)
    df = spark.range(5).select(F.col("id").alias("sequence"), F.timestamp_micros(F.lit(int(now.timestamp()) * 1_000_000 - 5_000_000) + F.col("id")).alias("event_time"))
    df.write.parquet(str(tmp_path / "t"))
    stream = poll(spark, str(tmp_path / "t"), now - timedelta(minutes=1), str(tmp_path / "p"), interval="1s", window="30s")
    drain(tail.dedup(stream.withColumn("raw", F.lit("")), "30 seconds"), str(tmp_path / "out"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_arguments(spark, tmp_path):
    with pytest.raises(ValueError):
        poll(spark, "x", T0, "p", interval="0s")
    with pytest.raises(ValueError):
        poll(spark, "x", T0, "p", limit=0)
