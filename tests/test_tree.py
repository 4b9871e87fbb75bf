"""Spans: normalisation, tables, waterfalls and shapes."""

import random

import pytest
from pyspark.sql import functions as F

from logloom.operators import spans as sp
from logloom.operators import tree as tr

SCHEMA = (
    "trace_id string, span_id string, parent_span_id string, name string, service string, kind string, "
    "start_ns bigint, duration_ns bigint, end_ns bigint, status string"
)
SHAPE = [
    ("t1", "a1", "", "POST /add", "cart", "SERVER", 1000, 100, 1100, ""),
    ("t1", "b1", "a1", "HGET", "cart", "CLIENT", 1010, 30, 1040, ""),
    ("t2", "a2", "", "POST /add", "cart", "SERVER", 5000, 120, 5120, ""),
    ("t2", "b2", "a2", "HGET", "cart", "CLIENT", 5020, 40, 5060, "STATUS_CODE_ERROR"),
    ("t2", "c2", "a2", "HGET", "cart", "CLIENT", 5070, 20, 5090, ""),
]
WATERFALL = [
    ("t", "root", "", "POST /add", "cart", "", 0, 100, 100, ""),
    ("t", "c1", "root", "HGET", "cart", "", 10, 30, 40, ""),
    ("t", "c2", "root", "HMSET", "cart", "", 50, 40, 90, "STATUS_CODE_ERROR"),
    ("t", "orphan", "gone", "stray", "web", "", 5, 10, 15, ""),
]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_normalize(spark):
    rows = [
        {"$span.duration_nano": "0", "$span.start_time_unix_nano": "100", "$span.end_time_unix_nano": "250.0"},
        {"$span.start_time_unix_nano": "100", "$span.duration_nano": "50", "$span.kind": "SPAN_KIND_SERVER"},
        {"$span.start_time_unix_nano": "1700000000000000001", "$span.duration_nano": "x"},
    ]
    got = sp.normalize_spans(spark.createDataFrame([(r,) for r in rows], "attrs map<string,string>")).collect()
    assert got[0]["duration_ns"] == 150 and got[1]["end_ns"] == 150 and got[1]["kind"] == "SERVER"
    assert got[2]["start_ns"] == 1700000000000000001 and got[2]["duration_ns"] == 0 and got[2]["service"] == ""


def test_shape(spark):
    rows = {r["name"]: r for r in tr.shape(table(spark, SHAPE), tr.EntryMatch(entry_only=True)).collect()}
    assert len(rows) == 2
    top, child = rows["POST /add"], rows["HGET"]
    assert (top["depth"], top["parent"], top["samples"], top["traces"]) == (0, None, 2, 2)
    assert (child["samples"], child["traces"], child["errors"]) == (3, 2, 1)
    assert (child["avg_offset_ns"], child["min_offset_ns"], child["max_end_ns"]) == (33, 10, 90)
    assert child["parent"] == "cart/POST /add"
    shape = tr.shape(table(spark, SHAPE))
    assert tr.min_traces(shape, 2).count() == 2 and tr.min_traces(shape, 3).count() == 0
    view = {r["name"]: (r["presence"], r["axis_end_ns"], r["sibling"]) for r in tr.shape_view(shape).collect()}
    assert view == {"POST /add": ("2/2", 120, 1), "HGET": ("2/2", 120, 1)}


def test_anchor_falls_through(spark):
    spans = table(spark, SHAPE)
    picked = {r["trace_id"]: r["span_id"] for r in tr.anchors(spans, tr.EntryMatch(service="none")).collect()}
    assert picked == {"t1": "a1", "t2": "a2"}
    errors = {r["trace_id"]: r["span_id"] for r in tr.anchors(spans, tr.EntryMatch(errors_only=True)).collect()}
    assert errors == {"t1": "a1", "t2": "b2"}


def test_waterfall(spark):
    spans = table(spark, WATERFALL)
    got = [(r["span_id"], r["depth"]) for r in tr.waterfall(spans, "t").collect()]
    assert got == [("root", 0), ("c1", 1), ("c2", 1), ("orphan", 0)]
    assert [r["span_id"] for r in tr.orphans(spans).collect()] == ["orphan"]
    bounds = sp.trace_bounds(spans).first()
    assert (bounds["start_ns"], bounds["end_ns"], bounds["total_ns"]) == (5, 100, 100)
    with pytest.raises(LookupError):
        tr.waterfall(spans, "none")
    cycle = [("t", "a", "b", "x", "s", "", 20, 1, 21, ""), ("t", "b", "a", "y", "s", "", 10, 1, 11, "")]
    got = [(r["span_id"], r["depth"]) for r in tr.waterfall(table(spark, cycle), "t").collect()]
    assert got == [("b", 0), ("a", 1)]


def test_tables(spark):
    rows = [("t", str(i), "", "op", "cart", "SERVER", 1, 2_000_000, 0, "") for i in range(3)]
    rows += [("t", "w", "x", "op", "web", "SERVER", 1, 9_000_000, 0, "STATUS_CODE_ERROR")]
    spans = table(spark, rows)
    got = [tuple(r) for r in sp.services(spans).collect()]
    assert got == [("cart", 3, 2_000_000, 2_000_000), ("web", 1, 9_000_000, 9_000_000)]
    assert [r["service"] for r in sp.services(spans, errors_only=True).collect()] == ["web"]
    routed = spans.withColumn("attrs", F.create_map(F.lit("$http.route"), F.when(F.col("service") == "web", "").otherwise(F.concat(F.lit("/"), "span_id"))))
    by = sp.attributes(routed, ["http.route"], root_only=False, n=2)
    assert by.columns == ["http.route", "spans", "errors", "error_pct", "avg_ns", "max_ns"]
    assert [r["http.route"] for r in by.collect()] == ["/0", "/1"]
    assert sp.attributes_dropped(routed, ["http.route"], root_only=False).first()["dropped"] == 1
    labelled = sp.attributes(routed, [" $http.route "], root_only=False, include_empty=True)
    assert ("<missing>", 1, 1, 100.0) in [tuple(r)[:4] for r in labelled.collect()]
    assert sp.list_spans(spans, min_ms=2).count() == 1
    for bad in ("", " $"):
        with pytest.raises(ValueError):
            sp.attribute_name(bad)
    with pytest.raises(ValueError):
        sp.kind_is("master")
    assert spans.filter(sp.kind_is("span_kind_Server")).count() == 4


def plain_waterfall(rows):
    """Depth-first walk over deduplicated spans of one trace."""
    first = {}
    for r in sorted(rows, key=lambda r: (r[6], r[3], r)):
        first.setdefault(r[1] if r[1] else ("nameless", r), r)
    spans = list(first.values())
    ids = {r[1] for r in spans if r[1]}
    roots = [r for r in spans if r[2] not in ids] or [min(spans, key=lambda r: (r[6], r[1]))]
    key = lambda r: (r[6], r[7], r[1])
    out, seen = [], set()

    def visit(r, depth):
        if r[1]:
            if r[1] in seen:
                return
            seen.add(r[1])
        out.append((r[1], depth))
        if r[1]:
            for kid in sorted((k for k in spans if k[2] == r[1]), key=key):
                visit(kid, depth + 1)

    for root in sorted(roots, key=key):
        visit(root, 0)
    return out


def test_random_forests(spark):
    rng = random.Random(11)
    rows = []
    for t in range(25):
        n = rng.randint(1, 14)
        for i in range(n):
            shape = t % 5
            parent = {
                0: f"s{i - 1}" if i else "",  # a chain
                1: f"s{rng.randint(0, n)}",  # anything: cycles, self-parents, orphans
                2: f"s{rng.randint(0, i - 1)}" if i else "",
                3: f"s{(i + 1) % n}",  # one cycle
                4: f"s{rng.randint(0, i - 1)}" if i > 2 else "gone",
            }[shape]
            span = "" if shape == 2 and rng.random() < 0.2 else f"s{i}"
            if shape == 4 and rng.random() < 0.2:
                span = f"s{max(i - 1, 0)}"  # a repeated id
            rows.append((f"t{t}", span, parent, f"n{rng.randint(0, 2)}", "svc", "", rng.randint(1, 40), rng.randint(0, 9), 0, ""))
    got = {}
    for r in tr.waterfalls(table(spark, rows)).orderBy("trace_id", "position").collect():
        got.setdefault(r["trace_id"], []).append((r["span_id"], r["depth"]))
    expected = {f"t{t}": plain_waterfall([r for r in rows if r[0] == f"t{t}"]) for t in range(25)}
    assert got == expected


def test_one_trace_with_most_spans(spark):
    rows = [("hot", "root", "", "in", "gw", "SERVER", 10, 900, 0, "")]
    rows += [("hot", f"k{i}", "root", f"op{i % 3}", "db", "CLIENT", 10 + i, 5, 0, "") for i in range(4000)]
    rows += [(f"t{i}", "r", "", "in", "gw", "SERVER", 10, 50, 0, "") for i in range(50)]
    shape = {r["name"]: (r["samples"], r["traces"], r["depth"]) for r in tr.shape(table(spark, rows)).collect()}
    assert shape == {"in": (51, 51, 0), "op0": (1334, 1, 1), "op1": (1333, 1, 1), "op2": (1333, 1, 1)}
    hot = tr.waterfall(table(spark, rows), "hot").collect()
    assert [r["span_id"] for r in hot] == ["root"] + [f"k{i}" for i in range(4000)]


def test_deep_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    keep = tr._split_counts
    monkeypatch.setattr(tr, "_split_counts", lambda s: rounds.append(1) or keep(s))
    chain = [("t", f"s{i:03}", f"s{i - 1:03}" if i else "", "n", "s", "", i + 1, 1, 0, "") for i in range(130)]
    got = tr.waterfalls(table(spark, chain))
    assert got.agg(F.max("depth")).first()[0] == 129
    assert len(rounds) <= 10


def test_one_decimal_as_printed(spark):
    pairs = [(n, d) for d in range(1, 401) for n in range(d + 1)]
    from logloom.operators.spans import one_decimal

    rows = spark.createDataFrame(pairs, "n int, d int").select("n", "d", one_decimal(F.col("n") / F.col("d") * 100).alias("v")).collect()
    assert not [r for r in rows if r["v"] != float(f"{r['n'] / r['d'] * 100:.1f}")]
