"""Dataset references, rollups and monitor definitions."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logloom.operators import catalog as ca
from logloom.operators import lint as li

CATALOG = [("app", "web", "id-1"), ("sys", "web", "id-2"), ("app", "db", "id-3"), ("app", "", "id-4")]
GOOD = {
    "name": "m", "comparison_operator": "ABOVE", "threshold": 5, "window": "Last 10 minutes",
    "actions": [{"type": "EMAIL", "email": "a@b.c"}, {"type": "INTEGRATION"}],
    "queries": [{"name": "q", "select": ["count(*)"], "where": "", "from": ["id-1"]}],
}


def table(spark):
    return spark.createDataFrame(CATALOG, "collection string, name string, id string")


def test_references(spark):
    uuid = "123e4567-e89b-12d3-a456-426614174000"
    refs = spark.createDataFrame([("web",), ("app/web",), ("db",), ("app/none",), ("nope",), (uuid,)], "ref string")
    got = {r["ref"]: (r["status"], r["id"]) for r in ca.resolve_refs(refs, table(spark)).collect()}
    assert got == {
        "web": ("ambiguous", None), "app/web": ("ok", "id-1"), "db": ("ok", "id-3"),
        "app/none": ("not_found", None), "nope": ("not_found", None), uuid: ("ok", uuid),
    }


def test_rollups(spark):
    labels = {r["id"]: r["label"] for r in ca.qualify_names(table(spark)).collect()}
    assert labels == {"id-1": "app/web", "id-2": "sys/web", "id-3": "db"}
    rows = {r["collection"]: (r["datasets"], r["names"]) for r in ca.collections_rollup(table(spark)).collect()}
    assert rows == {"app": (3, "db, web"), "sys": (1, "web")}
    objects = spark.createDataFrame(
        [('{"last_logins":{"Password":1784526811,"SSO":5},"widget_ids":[1,2],"metadata":{"last_heartbeat_at":1500}}',), ("{}",)],
        "definition string",
    )
    first, second = ca.catalog_stats(objects).select(F.unix_seconds("last_login").alias("s"), F.unix_millis("last_activity").alias("a"), "widgets", "components").collect()
    assert tuple(first) == (1784526811, 1500, 2, None) and tuple(second) == (None, None, None, None)
    masked = ca.mask_columns(spark.createDataFrame([("0123456789abc", "k")], "secret string, key string"), ["secret"])
    assert tuple(masked.first()) == ("01234567…", "k")


def problems(spark, body):
    text = body if isinstance(body, str) else json.dumps(body)
    return sorted(r["problem"] for r in li.lint_monitors(spark.createDataFrame([(text,)], "definition string")).collect())


def test_lint(spark):
    assert problems(spark, GOOD) == []
    assert len(problems(spark, {})) == 6
    assert problems(spark, "{") == ["unreadable definition"]
    for window, part in (("Last 1 minutes", "under"), ("Last 2 days", "over"), ("last week", "unreadable"), ("Last 99999999999999999999 days", "over")):
        (found,) = problems(spark, {**GOOD, "window": window})
        assert part in found
    bad = {
        **GOOD, "comparison_operator": "OVER", "actions": [{"type": "EMAIL"}, 7, {"type": "SMS"}],
        "queries": [{"select": []}, "q"],
    }
    assert problems(spark, bad) == sorted([
        'no comparison: OVER', "actions[0] mails nobody", "actions[1] is no object",
        'actions[2] has an unheard-of type: SMS', "queries[0] has no name",
        "queries[0] selects nothing", "queries[0] has no condition",
        "queries[0] reads from nowhere", "queries[1] is no object",
    ])
    assert problems(spark, {**GOOD, "actions": [], "queries": {}}) == [
        "actions lists nothing", "queries lists nothing"
    ]
    rows = spark.createDataFrame([(json.dumps({**GOOD, "queries": [{"from": ["id-1", "gone", ""]}]}),)], "definition string")
    assert [r["id"] for r in li.unknown_datasets(rows, table(spark)).collect()] == ["gone"]


def test_monitor(spark):
    now = datetime(2026, 1, 1, 12)
    rows = [("web", now - timedelta(minutes=m)) for m in (0, 1, 2, 4, 5, 30)]
    df = spark.createDataFrame(rows, "host string, event_time timestamp_ntz")
    monitor = li.Monitor("ABOVE", 3, keys=["host"])
    assert tuple(li.evaluate_monitor(df, monitor, now).first()) == ("web", 4, True)
    assert not li.evaluate_monitor(df, li.Monitor("EQUAL", 3), now).first()["breached"]
    for bad in ({"comparison": "OVER"}, {"comparison": "ABOVE", "window": timedelta(minutes=1)}, {"comparison": "ABOVE", "window": timedelta(days=2)}):
        with pytest.raises(ValueError):
            li.Monitor(threshold=1, **bad)


def test_text_epochs_are_no_logins(spark):
    objects = spark.createDataFrame([('{"last_logins":{"a":"900","b":7}}',), ('{"last_logins":{"a":"900"}}',)], "definition string")
    assert [r["s"] for r in ca.catalog_stats(objects).select(F.unix_seconds("last_login").alias("s")).collect()] == [7, None]
