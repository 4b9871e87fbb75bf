"""Column ranking, unpivoting, group keys and profiles."""

from pyspark.sql import functions as F

from logloom.operators import columns as co
from logloom.operators import names as nm
from logloom.operators import profile as pr
from logloom.operators import series as se
from logloom.functions import text as tx


def events(spark, rows):
    data = [
        (r.get("@time"), r.get("@status"), r.get("@raw"), {k: v for k, v in r.items() if not k.startswith("@") or k == "@timestamp"})
        for r in rows
    ]
    return spark.createDataFrame(data, "event_time string, status string, raw string, attrs map<string,string>")


def ranked(spark, rows, cap=8):
    return [r["key"] for r in co.rank_columns(events(spark, rows), cap).collect()]


BASE = {"@time": "t", "@status": "ok", "@raw": "line"}


def test_rank_columns(spark):
    rows = [{**BASE, "common": "1", "rare": "1"}, {**BASE, "common": "2"}, {**BASE, "common": "3", "other": "1"}]
    del rows[1]["@raw"]
    assert ranked(spark, [{k: v for k, v in r.items() if k != "@raw"} for r in rows]) == [
        "@time", "@status", "common", "other", "rare"
    ]
    two = [{**BASE, "a": "1", "b": "1"}]
    assert ranked(spark, two) == ["@time", "@status", "a", "b", "@raw"]
    assert ranked(spark, [{**BASE, "a": "1", "b": "1", "c": "1"}]) == ["@time", "@status", "a", "b", "c"]
    many = [{**BASE, **{k: "1" for k in "abcdefg"}}]
    assert ranked(spark, many) == ["@time", "@status", *"abcdef"]
    assert ranked(spark, [{**BASE, "a": "1", "b": "1", "c": "1"}], 5) == ["@time", "@status", "a", "b", "@raw"]
    varied = [{"constant": "1", "varied": str(i), "empty": None, "n": "null", "x.timestamp": "1", "@timestamp": "1", "links": "l"} for i in range(2)]
    assert ranked(spark, varied) == ["varied", "constant"]


def test_core_columns_rank_by_their_own_values(spark):
    df = events(spark, [{"@time": "t", "@status": s, "@raw": r, "f": "1"} for s, r in (("a", "x"), ("b", "y"), ("b", None), ("", "null"))])
    df = df.withColumn("origin", F.col("status")).withColumn("sequence", F.monotonically_increasing_id())
    got = {r["key"]: (r["present"], r["variety"]) for r in co.column_stats(df).collect()}
    assert got == {"@time": (4, 1), "@status": (3, 2), "@raw": (2, 2), "@origin": (3, 2), "@sequence": (4, 4), "f": (4, 1)}
    assert [r["key"] for r in co.rank_columns(df, 0).collect()] == ["@time", "@status", "@sequence", "f", "@origin"]


def test_listed_columns(spark):
    df = events(spark, [{"@raw": "r", "z": "1", "b": "2"}, {"@time": "t", "a": "3", "z": None}]).withColumn("n", F.monotonically_increasing_id())
    got = [r["key"] for r in co.listed_columns(df.coalesce(1), ["n"]).orderBy("position").collect()]
    assert got == ["@time", "@raw", "b", "z", "a"]
    assert co.listed_columns(df, ["n"], 2).count() == 2


def test_expand_and_keep(spark):
    df = spark.createDataFrame([(1, {"z": "1", "a": "2", "@time": "t"})], "id int, attrs map<string,string>")
    got = [(r["position"], r["key"]) for r in co.expand_rows(df, ["@time", "@status"], ["id"]).orderBy("position").collect()]
    assert got == [(1, "@time"), (2, "a"), (3, "z")]
    assert co.keep_fields(df, ["a", "none"]).first()["attrs"] == {"a": "2"}
    assert [r["key"] for r in co.field_union(df).collect()] == ["@time", "a", "z"]


def test_parse_group(spark):
    cases = {
        '["a","b",null,4]': ["a", "b", "", "4"], '{"b":1,"a":"x"}': ["x", "1"], "[a, b]": ["a", "b"],
        " web ": ["web"], "[]": [], "5": ["5"], '"q"': ["q"], None: [],
    }
    df = spark.createDataFrame([(k,) for k in cases], "g string")
    got = {r["g"]: r["p"] for r in df.select("g", co.parse_group("g").alias("p")).collect()}
    assert got == cases


def test_merge_profiles(spark):
    rows = [
        ("status", 5.0, "NUMBER", "MESSAGE_KVP", ["b", "a"]), ("ci_marker", 5.0, "STRING", "ATTRIBUTE", []),
        ("status", 2.0, "", "", ["a", "c"]), ("host", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "key string, rank double, type string, source string, values array<string>")
    got = [tuple(r) for r in pr.merge_profiles(df).collect()]
    assert got == [
        ("status", 7.0, "number", "message", ["a", "b", "c"]),
        ("ci_marker", 5.0, "string", "attribute", None),
        ("host", 0.0, None, None, None),
    ]


def test_field_profile_types(spark):
    df = spark.createDataFrame(
        [({"n": "1", "b": "true", "$s": "x", "nil": None},), ({"n": "2.5", "b": "false", "$s": "1"},)],
        "attrs map<string,string>",
    )
    got = {r["key"]: (r["count"], r["type"], r["source"], r["values"]) for r in pr.field_profile(df).collect()}
    assert got == {
        "n": (2, "number", "message", ["1", "2.5"]), "b": (2, "boolean", "message", ["false", "true"]),
        "$s": (2, "string", "attribute", ["1", "x"]),
    }
    assert [r["value"] for r in pr.field_values(df, "S").collect()] == ["1", "x"]


def profile(spark, names):
    return spark.createDataFrame([(n, c) for c, n in enumerate(reversed(names), 1)], "key string, count bigint")


def test_resolve_and_candidates(spark):
    known = profile(spark, ["$model", "$final_model", "$duration_ms", "$model_swapped", "Model2", "$model2"])
    names = spark.createDataFrame([("MODEL",), ("mdl",), ("$model",), ("model2",), ("zzzzzz",)], "name string")
    got = {r["name"]: (r["status"], r["field"]) for r in pr.resolve_field(known, names).collect()}
    assert got == {
        "MODEL": ("ok", "$model"), "mdl": ("unknown", None), "$model": ("ok", "$model"),
        "model2": ("ambiguous", None), "zzzzzz": ("unknown", None),
    }
    close = {}
    for r in pr.field_candidates(names, known).orderBy("name", "position").collect():
        close.setdefault(r["name"], []).append(r["candidate"])
    assert close["mdl"] == ["$model"] and "zzzzzz" not in close
    assert close["MODEL"] == ["$final_model", "$model", "$model2"]


def test_nearest_equals_all_pairs(spark):
    import random

    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(80)})
    names, known = words[::2], words[1::2]
    ranks = {k: i % 4 for i, k in enumerate(known)}

    def distance(a, b):
        prev = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            cur = [i]
            for j, y in enumerate(b, 1):
                cur.append(min(cur[-1] + 1, prev[j] + 1, prev[j - 1] + (x != y)))
            prev = cur
        return prev[-1]

    expected = {}
    for a in names:
        best = min((distance(a, b), -ranks[b], b) for b in known)
        if best[0] <= 2:
            expected[a] = (best[2], best[0])
    got = nm.nearest(
        spark.createDataFrame([(n,) for n in names], "name string"),
        spark.createDataFrame(list(ranks.items()), "key string, count int"),
    )
    assert {r["name"]: (r["nearest"], r["distance"]) for r in got.collect()} == expected


def test_suggestions_and_check(spark):
    known = profile(spark, ["status", "level"])
    refs = spark.createDataFrame([("stauts",), ("levl",), ("zzzzzz",), ("status",), ("@raw",), ("$x",)], "field string")
    got = {r["field"]: (r["status"], r["suggestion"]) for r in pr.check_fields(refs, known).collect()}
    assert got == {
        "stauts": ("warning", "status"), "levl": ("warning", "level"), "zzzzzz": ("warning", None),
        "status": ("known", None), "@raw": ("known", None), "$x": ("known", None),
    }


def test_labels(spark):
    ns = [0, -5, 500, 999999, 10**6, 9820000, 999000000, 10**9, 83500000000]
    df = spark.createDataFrame([(n,) for n in ns], "ns bigint")
    got = [r[0] for r in df.select(tx.format_duration_ns("ns")).collect()]
    assert got == ["—", "—", "0.5µs", "1000.0µs", "1.00ms", "9.82ms", "999.00ms", "1.00s", "83.50s"]
    texts = spark.createDataFrame(
        [("Fri Jul 10 18:53:00 UTC 2026",), ("whenever",), ("FATAL",), ("short",), ("0123456789abcdef",), ("",)], "t string"
    )
    rows = texts.select(tx.bucket_time("t"), tx.severity_class("t"), tx.mask_secret("t"), tx.label_missing("t")).collect()
    assert rows[0][0] == "2026-07-10 18:53" and rows[1][0] == "whenever"
    assert rows[2][1] == "error" and rows[1][1] == "other"
    assert rows[3][2] == "…" and rows[4][2] == "01234567…" and rows[5][2] == ""
    assert rows[5][3] == "<missing>"


def test_event_times(spark):
    cases = {
        "2026-01-02 15:04:05.123 UTC": 1767366245123, "2026-01-02T15:04:05.123Z": 1767366245123,
        "2026-01-02T16:04:05+01:00": 1767366245000, "1767366245123": 1767366245123, "soon": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r["t"]: r["ms"] for r in df.select("t", tx.event_time_ms("t").alias("ms")).collect()} == cases


def test_levels_and_series_rows(spark):
    df = spark.createDataFrame([([0, 4, 8],), ([0, 0],)], "h array<bigint>")
    got = [r[0] for r in df.select(se.levels("h")).collect()]
    assert got == [[0, 3, 7], [0, 0]]
    usage = spark.createDataFrame(
        [("bytes", [("Fri Jul 10 18:53:00 UTC 2026", "6", "21667.0"), ("odd", "x", None)])],
        "name string, series array<struct<time:string,count:string,value:string>>",
    )
    assert [tuple(r) for r in co.series_rows(usage).collect()] == [
        ("2026-07-10 18:53", 6.0, 21667.0), ("odd", 0.0, 0.0)
    ]
