"""Fields of a shredded table are asked for by themselves, and say the same as the map."""

import random

import pytest
from pyspark.sql import functions as F

from logloom.functions import predicates as p
from logloom.sources.lines import parse_lines
from logloom.sources.shredded import attrs, field, write_shredded

ODD = ['{"k":"007","http":{"status":"5d"}}', '{"k":1.5,"w\'x":"a\\"b\\\\ \\u0001"}', '{"k":null,"type":""}', "plain", '{"k":-0,"n":12345678901234567890}', "{}"]


def events(spark, n=3_000):
    draw = random.Random(4)
    lines = [
        '{"type":"t%d","k":%d,"http":{"status":%d},"text":"%s"%s}'
        % (i % 7, draw.randrange(100), 200 + 100 * (i % 4), "".join(draw.choices("abcdefghijklmnop", k=300)), ',"amount":"9"' if i % 3 else "")
        for i in range(n)
    ] + ODD
    df = spark.createDataFrame(list(enumerate(lines)), "sequence bigint, raw string")
    times = F.timestamp_seconds(F.lit(1_767_225_600) + F.col("sequence") * 60)
    return parse_lines(df.select("sequence", times.alias("event_time"), F.lit("app").alias("collection"), F.lit("web").alias("dataset"), "raw"))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shredded") / "t")
    parsed = events(spark)
    write_shredded(parsed, path)
    return parsed, spark.read.parquet(path)


def test_same_fields_and_predicates(tables):
    parsed, table = tables
    want = {r["sequence"]: {k: v for k, v in r["attrs"].items() if v is not None} for r in parsed.collect()}
    assert {r["sequence"]: r["a"] for r in table.select("sequence", attrs().alias("a")).collect()} == want
    for test in (
        lambda f: p.eq(f("k"), 7), lambda f: p.eq(f("k"), "7"), lambda f: p.eq(f("k"), "007"), lambda f: p.ne(f("amount"), 9),
        lambda f: p.ge(f("http.status"), 400) & p.match(f("type"), "[1-3]$"), lambda f: p.exists(f("type")) & ~p.exists(f("amount")),
        lambda f: p.nmatch(f("k"), "^1"), lambda f: p.lt(f("k"), 2), lambda f: p.eq(f("w'x"), 'a"b\\ \x01'),
    ):
        shown = sorted(r["sequence"] for r in table.filter(test(field)).select("sequence").collect())
        assert shown == sorted(r["sequence"] for r in parsed.filter(test(lambda n: F.col("attrs")[n])).select("sequence").collect())


def test_the_scan_is_asked_for_the_field(tables):
    _, table = tables
    one = table.filter(p.eq(field("k"), "7")).select("sequence")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "fields:struct<0:string>" in plan.split("ReadSchema")[1]
    numbers = table.filter(field("k", "bigint") > 90).select("sequence")
    plan = numbers._jdf.queryExecution().executedPlan().toString()
    assert "fields:struct<0:bigint>" in plan.split("ReadSchema")[1] and "GreaterThan(fields.`0`,90)" in plan
    every = table.filter(p.eq(attrs()["k"], "7")).select("sequence")
    assert sorted(one.collect()) == sorted(every.collect())
    with pytest.raises(ValueError):
        field("a'b\"c")


def test_settings_come_back(spark, tables):
    assert spark.conf.get("spark.sql.variant.writeShredding.enabled", None) == spark.newSession().conf.get("spark.sql.variant.writeShredding.enabled", None)
