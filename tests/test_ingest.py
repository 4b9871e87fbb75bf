"""Ingest lines, batches and sinks."""

import csv
import gzip
import json
import random
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from logloom.functions import predicates as p
from logloom.operators.batching import greedy_batches
from logloom.sources import ingest as ig
from logloom.sources import sinks
from logloom.sources.lines import parse_lines
from logloom.sources.payload import extract_path, payload_rows

AS_OF = datetime(2026, 7, 7, 12, tzinfo=timezone.utc)
STAMP = "2026-07-07T12:00:00Z"


def test_normalize(spark):
    lines = [
        "plain log line", '{"level":"info"}', "[1,2]", '{"message": 123}', '  \t{"message":"m","timestamp":"t"}',
        '{"a":1} trailing', '{"a":1},{"b":2}', '{"n":4367602734065516544,"message":"<&>"}', "{}",
        '{"a":1}] junk', '{"a":1,"a":{"b":2}}', '{"a":1,"a":2} x', '{"a":1},5]',
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    rows = {r["i"]: r for r in ig.normalize_ingest(df, AS_OF).collect()}
    for i in (0, 2, 5, 6, 9, 11, 12):
        assert json.loads(rows[i]["event"]) == {"message": lines[i], "timestamp": STAMP}
    assert json.loads(rows[1]["event"]) == {"level": "info", "message": lines[1], "timestamp": STAMP}
    assert json.loads(rows[3]["event"])["message"] == lines[3]
    assert json.loads(rows[4]["event"]) == {"message": "m", "timestamp": "t"}
    assert '"n":4367602734065516544' in rows[7]["event"] and '"<&>"' in rows[7]["event"]
    assert json.loads(rows[10]["event"]) == {"a": {"b": 2}, "message": lines[10], "timestamp": STAMP}
    assert json.loads(rows[8]["event"]) == {"message": "{}", "timestamp": STAMP}


def test_plan(spark):
    lines = [" ab ", "", "   ", "ü"] + ["x" * 9] * 20
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    assert tuple(ig.ingest_plan(df).first()) == (22, 2 + 2 + 180)


def greedy(sizes, max_events, max_bytes):
    out, batch, events, held = [], 0, 0, 0
    for size in sizes:
        events, held = events + 1, held + size
        out.append(batch)
        if events >= max_events or held >= max_bytes:
            batch, events, held = batch + 1, 0, 0
    return out


@pytest.mark.parametrize("max_events,max_bytes,chunk", [(6, 35, 7), (50, 300, 64), (1, 1, 10), (500, 10**9, 1000), (40, 90, 100_000)])
def test_batches_are_those_of_one_sender(spark, max_events, max_bytes, chunk):
    draw = random.Random(max_events)
    sizes = [draw.choice([1, 1, 2, 9, draw.randrange(1, 60), 700 if draw.random() < 0.05 else 3]) for _ in range(1_500)]
    sizes[200:900] = [1] * 400 + [draw.randrange(1, 30) for _ in range(300)]
    df = spark.createDataFrame([(i, "x" * (n - 1)) for i, n in enumerate(sizes)], "i int, value string").repartition(5)
    got = greedy_batches(df, ["i"], F.octet_length("value") + 1, max_events, max_bytes, chunk).collect()
    assert [r["batch"] for r in sorted(got)] == greedy(sizes, max_events, max_bytes)


def test_batches_of_little(spark):
    df = spark.createDataFrame([(1, "a", "other")], "i int, value string, batch_bytes string")
    assert [tuple(r) for r in ig.ingest_batches(df, ["i"], "value").collect()] == [(1, "a", "other", 0)]
    assert ig.ingest_batches(df.filter("i > 1"), ["i"], "value").count() == 0
    with pytest.raises(ValueError):
        ig.ingest_batches(df, ["i"], "value", max_events=0)


def test_write_events(spark, tmp_path):
    df = spark.createDataFrame([("a", "m1"), ("b", "m2")], "value string, message string")
    events = df.select("message", F.to_json(F.struct("message")).alias("event"))
    out = str(tmp_path / "out")
    sinks.write_events(events, out, "web", "app", {"team": "x"}, max_events=1)
    files = list(Path(out).glob("collection=app/dataset=web/tags=*/*.gz"))
    lines = sorted(line for f in files for line in gzip.open(f, "rt").read().splitlines())
    assert lines == ['{"message":"m1"}', '{"message":"m2"}']
    with pytest.raises(ValueError):
        sinks.write_events(events, out, "web", tags=["novalue"])
    bad = events.withColumn("message", F.lit(""))
    with pytest.raises(Exception, match="non-empty"):
        sinks.write_events(bad, str(tmp_path / "bad"), "web")
    valid, rejected = sinks.split_valid(events.unionByName(bad))
    assert (valid.count(), rejected.count()) == (2, 2)


def test_output_formats(spark, tmp_path):
    lines = ['{"level":"error","status":502,"tags":["a","b"]}', 'say "hi", ok']
    df = parse_lines(spark.createDataFrame([(i, r) for i, r in enumerate(lines)], "sequence bigint, raw string"))
    df = df.withColumn("big", F.lit(12345678.0)).withColumn("list", F.array(F.lit(1), F.lit(2))).coalesce(1)
    sinks.to_csv(df, str(tmp_path / "csv"), ["sequence", "big", "list", "level", "raw", "none"])
    (part,) = (tmp_path / "csv").glob("*.csv")
    rows = list(csv.reader(part.open()))
    assert rows[0] == ["sequence", "big", "list", "level", "raw", "none"]
    assert sorted(rows[1:]) == [["0", "12345678", "[1,2]", "error", lines[0], ""], ["1", "12345678", "[1,2]", "", lines[1], ""]]
    sinks.to_jsonl(df.drop("big", "list"), str(tmp_path / "jsonl"))
    (part,) = (tmp_path / "jsonl").glob("*.txt")
    got = [json.loads(line) for line in part.read_text().splitlines()]
    assert got[0] == {"@sequence": 0, "@raw": lines[0], "level": "error", "status": "502", "tags": '["a","b"]'}
    assert got[1] == {"@sequence": 1, "@raw": lines[1]}
    sinks.to_jsonl(df, str(tmp_path / "few"), ["level"])
    (part,) = (tmp_path / "few").glob("*.txt")
    assert part.read_text().splitlines() == ['{"level":"error"}', "{}"]
    sinks.to_raw(df, str(tmp_path / "raw"))
    (part,) = (tmp_path / "raw").glob("*.txt")
    assert part.read_text().splitlines() == lines
    sinks.export(df.select("raw"), str(tmp_path / "export"), F.col("raw").contains("hi"))
    (part,) = (tmp_path / "export").glob("*.gz")
    assert json.loads(gzip.open(part, "rt").read()) == {"@raw": lines[1]}


def test_payloads(spark):
    cases = [
        ('{"items":[{"a":1},2],"keys":[3]}', ["items"], ['{"a":1}', '{"value":2}']),
        ('[{"a":1}]', [], ['{"a":1}']),
        ('{"only":[1],"n":2}', [], ['{"value":1}']),
        ('{"x":[1],"y":[2]}', [], ['{"x":[1],"y":[2]}']),
        ("7", [], ['{"value":7}']),
    ]
    for body, keys, expected in cases:
        df = spark.createDataFrame([(body,)], "body string")
        got = [r[0] for r in payload_rows(df, "body", keys).select(F.to_json("row")).collect()]
        assert got == expected
    nested = spark.createDataFrame([('{"a":[{"b":[1,4367602734065516544]},{"b":[]},{"c":1}]}',), ("x",)], "body string")
    assert [r[0] for r in extract_path(nested, "body", "$.a[*].b[*]").collect()] == ["1", "4367602734065516544"]


def test_event_table_prunes(spark, tmp_path):
    rows = [("app", "web" if i % 4 else "db", i, '{"http":{"status":%d}}' % (200 + i), 1767225600 + i * 7200) for i in range(40)]
    df = spark.createDataFrame(rows, "collection string, dataset string, sequence bigint, raw string, s bigint")
    parsed = parse_lines(df.withColumn("event_time", F.timestamp_seconds("s")).drop("s"))
    sinks.write_table(parsed, str(tmp_path / "t"), promote=["http.status"])
    table = spark.read.parquet(str(tmp_path / "t"))
    hits = table.filter((F.col("dataset") == "web") & (F.col("day") == "2026-01-02") & p.ge(F.col("`http.status`"), 215))
    assert sorted(r["sequence"] for r in hits.select("sequence").collect()) == [15, 17, 18, 19, 21, 22, 23]
    plan = hits.select("sequence")._jdf.queryExecution().executedPlan().toString()
    assert "attrs" not in plan.split("ReadSchema")[1] and "dataset" in plan.split("PartitionFilters")[1]
    assert table.count() == 40
