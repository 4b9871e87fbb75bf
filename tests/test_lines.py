"""Reading lines: JSON, plain text, flattening and picked fields."""

import gzip

from pyspark.sql import functions as F

from logloom.functions import predicates as p
from logloom.operators.columns import select
from logloom.sources.lines import parse_lines, read_lines

LINES = [
    '{"level":"error","status":502,"path":"/api/v1/checkout","gateway":"stripe"}',
    '{"level":"info","status":200,"path":"/health"}',
    "plain text line with timeout error",
    '{"level":"error","status":500,"seq":4367602734065516544}',
]


def numbered(spark, lines):
    return spark.createDataFrame(list(enumerate(lines, 1)), "n int, raw string")


def kept(df):
    return sorted(r["n"] for r in df.collect())


def test_offline_search(spark):
    for fields in (None, ["status", "seq", "level"]):
        df = parse_lines(numbered(spark, LINES), fields=fields)
        assert kept(df) == [1, 2, 3, 4]
        assert kept(df.filter(p.ge("status", 500))) == [1, 4]
        assert kept(df.filter(p.match("@raw", "timeout"))) == [3]
        row = select(df.filter(p.eq("status", 500)), ["seq"]).first()
        assert row["seq"] == "4367602734065516544"


def test_files_of_any_mix(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n".join(LINES[:2]) + "\n\n   \n")
    (tmp_path / "c.log").write_bytes(b"one\rline\r\n")
    with gzip.open(tmp_path / "b.log.gz", "wt") as f:
        f.write("  " + LINES[2] + "  \n" + LINES[3])
    assert sorted(r["raw"] for r in read_lines(spark, str(tmp_path)).collect()) == sorted([*LINES, "one\rline"])


def test_flatten(spark):
    lines = [
        '{"a":{"b":{"c":[1, 2],"d":null}},"e":{},"s":"{not json}","t":true,"q":"{\\"a\\":1}"}',
        '{"a":1,"b":2,"a":{"x":3}}',
        '{"a":1} trailing',
        '{"a":1',
        "[1,2]",
        '{"@raw":"own","big":123456789012345678901234567890}',
        '{"a.b":"flat","k":"v"}',
        '{"x":{"a.b":{"c":5}}}',
    ]
    rows = {r["n"]: r for r in parse_lines(numbered(spark, lines)).collect()}
    assert rows[1]["attrs"] == {
        "a.b.c": "[1,2]", "a.b.d": None, "s": "{not json}", "t": "true", "q": '{"a":1}'
    }
    assert rows[2]["attrs"] == {"b": "2", "a.x": "3"}
    assert rows[3]["attrs"] == {"a": "1"} and rows[3]["raw"] == lines[2]
    assert rows[4]["attrs"] == {} and rows[5]["attrs"] == {}
    assert rows[6]["raw"] == "own"
    assert rows[6]["attrs"]["big"] == "123456789012345678901234567890"
    assert rows[8]["attrs"] == {"x.a.b.c": "5"}


def test_picked_fields_equal_the_flattened_ones(spark):
    lines = LINES + [
        '{"a":{"b":{"c":[1, 2],"d":null}},"s":"{not json}"}',
        '{"a":1,"a":{"b":"last"}}',
        '{"a.b":"flat"}',
        '{"x":{"a.b":{"c":5}}}',
        "{broken",
        '{"a":{}}',
    ]
    names = ["status", "a", "a.b", "a.b.c", "a.b.d", "s", "x.a.b.c", "level"]
    full = select(parse_lines(numbered(spark, lines)), ["n", *names])
    picked = select(parse_lines(numbered(spark, lines), fields=names), ["n", *names])
    assert sorted(map(str, full.collect())) == sorted(map(str, picked.collect()))


def test_odd_names(spark):
    lines = ['{"a\\"b":1,"a b":2,"$x":3,"":4,"a..b":5,"é[0]":6}']
    names = ['a"b', "a b", "$x", "", "a..b", "é[0]"]
    for fields in (names, ["a b", "$x", "é[0]"]):
        attrs = parse_lines(numbered(spark, lines), fields=fields).first()["attrs"]
        assert [attrs[n] for n in names if n in fields] == [str(names.index(n) + 1) for n in names if n in fields]


def test_depth_limit_keeps_json(spark):
    df = parse_lines(numbered(spark, ['{"a":{"b":{"c":{"d":1}}}}']), max_depth=2)
    assert df.first()["attrs"] == {"a.b": '{"c":{"d":1}}'}


def test_time_filter_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("raw", F.col("props"))
    df = parse_lines(events).filter(p.gt("k", 50)).filter("ts < timestamp_ntz'2024-01-02 00:00:00'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts" in plan.split("PushedFilters")[1]
    assert plan.count("parseJson") == 1


def test_any_depth_and_repeats_inside(spark):
    deep = '{"a":' * 12 + "1" + "}" * 12
    lines = [deep, '{"c":{"d":1,"d":2},"x":1}', '{"c":{"d":{"e":1}},"k":{"z":1,"z":[3]},"c":{"f":"t","g":{}},"n":null}', '{"c":{"d":1,"d":']
    rows = {r["n"]: r["attrs"] for r in parse_lines(numbered(spark, lines)).collect()}
    assert rows[1] == {".".join("a" * 12): "1"}
    assert rows[2] == {"c.d": "2", "x": "1"}
    assert rows[3] == {"c.f": "t", "k.z": "[3]", "n": None}
    assert rows[4] == {}


def test_named_fields_mean_the_same_by_either_way(spark):
    lines = ['{"a":{"b":{"c":{"d":{"e":{"f":7}}}}},"x":1}', "plain"]
    rows = parse_lines(numbered(spark, lines), fields=["a.b.c.d.e.f", "gone"]).orderBy("n").collect()
    assert rows[0]["attrs"] == {"a.b.c.d.e.f": "7", "gone": None, "@raw": None}
    assert rows[1]["attrs"] == {"a.b.c.d.e.f": None, "gone": None, "@raw": None} and rows[1]["raw"] == "plain"
