"""Order, limits, neighbourhoods, running totals and slices."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logloom.operators import aggregate as ag
from logloom.operators import events as ev
from logloom.operators import series as se
from logloom.operators.ranking import running
from logloom.sources.lines import first_lines


def skewed(spark, n=3000):
    """One dataset holds most rows; times repeat."""
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.8 else f"d{i % 7}", i, rng.randint(0, 500)) for i in range(n)]
    df = spark.createDataFrame(rows, "dataset string, sequence bigint, t int").repartition(6)
    return rows, df.select("dataset", "sequence", F.timestamp_seconds("t").alias("event_time"))


def test_neighbours_equal_slices_of_the_sorted_dataset(spark):
    rows, df = skewed(spark)
    ordered = {}
    for d, s, t in sorted(rows, key=lambda r: (r[2], r[1])):
        ordered.setdefault(d, []).append(s)
    rng = random.Random(4)
    picked = rng.sample(range(len(rows)), 40) + [ordered["hot"][0], ordered["hot"][-1]]
    anchors = df.filter(F.col("sequence").isin(picked)).select("dataset", "sequence", "event_time")
    for direction, low, high in (("both", -2, 2), ("before", -2, -1), ("after", 1, 2)):
        expected = set()
        for s in set(picked):
            own = ordered[rows[s][0]]
            at = own.index(s)
            expected |= {(s, o, own[at + o]) for o in range(low, high + 1) if 0 <= at + o < len(own)}
        got = ev.neighbours(df, anchors, 2, direction).select("anchor_sequence", "offset", "sequence").collect()
        assert {tuple(r) for r in got} == expected and len(got) == len(expected)
    one = picked[0]
    at = ordered[rows[one][0]].index(one)
    near = ev.around(df, rows[one][0], one, datetime(1970, 1, 1) + timedelta(seconds=rows[one][2]), 3)
    assert [r["sequence"] for r in near.collect()] == ordered[rows[one][0]][max(at - 3, 0) : at + 4]
    with pytest.raises(ValueError):
        ev.neighbours(df, anchors, 2, "sideways")


def test_running_totals(spark):
    rows, df = skewed(spark)
    got = running(df.withColumn("v", F.col("sequence") % 10), ["dataset"], ["event_time", "-sequence"], {"total": "v"}, partitions=16)
    out = {}
    for r in got.collect():
        out.setdefault(r["dataset"], {})[r["rank"]] = (r["sequence"], r["total"])
    for d in {r[0] for r in rows}:
        total, expected = 0, {}
        for i, (_, s, _) in enumerate(sorted((r for r in rows if r[0] == d), key=lambda r: (r[2], -r[1])), 1):
            total += s % 10
            expected[i] = (s, total)
        assert out[d] == expected


def test_orders(spark):
    rows = [(5, 1, {"x": "10"}), (5, None, {"x": "9"}), (4, 7, {"x": "b"}), (6, 0, {})]
    df = spark.createDataFrame(rows, "t int, sequence bigint, attrs map<string,string>").withColumn("event_time", F.timestamp_seconds("t"))
    assert [(r["t"], r["sequence"]) for r in ev.chronological(df).collect()] == [(4, 7), (5, None), (5, 1), (6, 0)]
    assert [r["t"] for r in ev.recent(df, 2).collect()] == [6, 5]
    assert [r["attrs"].get("x") for r in ev.order_by(df, "x").collect()] == ["9", "10", "b", None]
    assert [r["attrs"].get("x") for r in ev.order_by(df, "x", desc=True).collect()] == ["10", "9", "b", None]
    assert ev.head(df, 3).count() == 3
    with pytest.raises(ValueError):
        ev.limit(df, 0)


def test_recent_is_a_bounded_top_n(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumnRenamed("ts", "event_time")
    assert "TakeOrderedAndProject" in ev.recent(events)._jdf.queryExecution().executedPlan().toString()


def test_histogram(spark):
    start = datetime(2026, 1, 1)
    times = [start + timedelta(minutes=i % 12) for i in range(150)] + [start + timedelta(minutes=18), start - timedelta(seconds=1)]
    df = spark.createDataFrame([(t,) for t in times], "event_time timestamp_ntz")
    end = start + timedelta(minutes=18)
    rows = [tuple(r) for r in se.histogram(df, start, end, 3).collect()]
    base = 1767225600000
    assert rows == [(0, base, 78), (1, base + 360000, 72), (2, base + 720000, 0)]
    summary = se.histogram_summary(se.histogram(df, start, end, 3)).first()
    assert tuple(summary) == (150, 78, 360000)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert [r["count"] for r in se.histogram(df, start, end, 3).collect()] == [78, 72, 0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_snapshot(spark):
    df = spark.createDataFrame([("web-1",)] * 3 + [("web-2",)] * 5, "host string")
    got = [tuple(r) for r in ag.snapshot(df, {"count(*)": ag.count()}, ["host"]).collect()]
    assert got == [("web-2", 5), ("web-1", 3)]
    assert [tuple(r) for r in ag.snapshot(df).collect()] == [("total", 8)]


def test_trailing(spark):
    ticks = spark.createDataFrame([("a", i, i) for i in range(15)], "g string, tick int, v int")
    last = se.trailing(ticks, "g", "tick", "v").filter("tick = 14").first()
    assert last["history"] == list(range(3, 15))


def test_first_lines_in_input_order(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = []
    for f in range(7):
        own = [f"f{f} line {i} {'even' if i % 2 == 0 else 'odd'}" for i in range(40)]
        (tmp_path / "in" / f"{f}.log").write_text("\n".join(own[:20]) + "\n\n  \n" + "\n".join(own[20:]) + "\n")
        lines += own
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")  # several splits a file
    try:
        for n, keep, want in ((5, None, lines[:5]), (130, None, lines[:130]), (90, F.endswith("value", F.lit("odd")), lines[1::2][:90]), (999, None, lines)):
            got = [(r["place"], r["value"]) for r in first_lines(spark, str(tmp_path / "in"), n, keep).orderBy("place").collect()]
            assert got == list(enumerate(want, 1))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert first_lines(spark, str(tmp_path / "in"), 3, F.lit(False)).count() == 0
