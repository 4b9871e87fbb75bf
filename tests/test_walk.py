"""Trees walked inside a task against those walked by joins, and against plain Python."""

import random

import pyarrow as pa
import pytest
from test_tree import SCHEMA, plain_waterfall, table

from logloom.operators import tree as tr
from logloom.operators import walk


def forests(traces, seed=3, length=12):
    """Chains, cycles, self-parents, orphans, spans without id, repeated ids, equal starts."""
    rng, rows = random.Random(seed), []
    for t in range(traces):
        n = rng.randint(1, length)
        for i in range(n):
            parent = rng.choice([f"s{rng.randint(0, n)}", f"s{max(i - 1, 0)}", f"s{i}", "", "gone"])
            span = rng.choice([f"s{i}", f"s{i}", f"s{rng.randint(0, n)}", ""])
            status = rng.choice(["", "STATUS_CODE_ERROR", "error"])
            kind = rng.choice(["SERVER", "CLIENT"])
            rows.append((f"t{t}", span, parent, f"n{rng.randint(0, 2)}", rng.choice("ab"), kind, rng.randint(0, 6), rng.randint(-3, 9), 0, status))
    return rows


def shown(rows):
    """As ``plain_waterfall`` has it, without the order of spans that share start, duration and the empty id."""
    got = {}
    for r in rows:
        got.setdefault(r["trace_id"], []).append((r["position"], r["span_id"], r["depth"]))
    return {t: [x[1:] for x in sorted(found)] for t, found in got.items()}


@pytest.fixture
def no_broadcast(spark):
    """Joins as over large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("large", [None, 0])
def test_repeated_ids_without_broadcast(spark, no_broadcast, large):
    rows = forests(60, seed=5)
    found = tr.waterfalls(table(spark, rows), **({} if large is None else {"large": large})).collect()
    assert shown(found) == {t: plain_waterfall([r for r in rows if r[0] == t]) for t in {r[0] for r in rows}}


def same_rows(a, b):
    assert a.dtypes == b.dtypes
    a, b = (sorted(map(repr, x.collect())) for x in (a, b))
    assert a == b and a


def test_walk_and_joins_agree(spark):
    rows = forests(40)
    spans = table(spark, rows)
    without_position = [c for c in tr.waterfalls(spans).columns if c != "position"]
    whole = tr.waterfalls(spans)
    for large in (0, 7):  # all by joins, some
        same_rows(whole.select(without_position), tr.waterfalls(spans, large).select(without_position))
        assert shown(whole.collect()) == shown(tr.waterfalls(spans, large).collect())
    for match in (tr.EntryMatch(), tr.EntryMatch(entry_only=True), tr.EntryMatch(service="a", errors_only=True, min_ms=3e-6)):
        found = tr.shape(spans, match)
        same_rows(found, tr.shape(spans, match, 7))
        same_rows(found, tr.shape_stats(tr.shape_paths(spans, match)))


def test_nulls_go_by_joins(spark):
    rows = forests(20)
    rng = random.Random(1)
    for i in rng.sample(range(len(rows)), 12):
        gone = rng.choice([0, 1, 2, 3, 4, 6, 7, 9])
        rows[i] = (*rows[i][:gone], None, *rows[i][gone + 1 :])
    spans = table(spark, rows)
    same_rows(tr.shape(spans), tr.shape_stats(tr.shape_paths(spans)))
    same_rows(tr.waterfalls(spans).drop("position"), tr.waterfalls(spans, 0).drop("position"))


def test_short_traces_are_not_stored(spark, monkeypatch):
    stored, keep = [], tr.materialize
    monkeypatch.setattr(tr, "materialize", lambda df: stored.append(1) or keep(df))
    spans = table(spark, forests(30))
    tr.shape(spans, tr.EntryMatch(entry_only=True)).collect()
    tr.waterfalls(spans).collect()
    assert not stored


@pytest.mark.parametrize(("batch", "least"), [(1, 1), (3, 4), (7, 20), (1000, 1)])
def test_stretches_are_whole_traces(monkeypatch, batch, least):
    monkeypatch.setattr(walk, "STRETCH", least)
    rows = sorted(forests(30), key=lambda r: r[0])
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    whole = pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)})
    found = list(walk.stretches(iter(whole.to_batches(batch))))
    assert pa.concat_tables(found).to_pylist() == whole.to_pylist()
    held = [set(t["trace_id"].to_pylist()) for t in found]
    assert sum(map(len, held)) == len(set().union(*held))
    assert not list(walk.stretches(iter([])))


def test_long_paths_and_large_sums(spark, monkeypatch):
    monkeypatch.setattr(walk, "HOPS", 50)
    chain = [("t", f"s{i}", f"s{i - 1}" if i else "", "n", "s", "", i + 1, 1, 0, "") for i in range(300)]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    rows = pa.table({n: [r[i] for r in chain] for i, n in enumerate(names)}).append_column("_error", pa.array([False] * 300))
    parts = list(walk.shape_parts(tr._first_by(tr._SHAPE), False)(iter(rows.to_batches())))
    assert len(parts) > 200
    assert sorted(len(p) for x in parts for p in x["path"].to_pylist()) == list(range(1, 301))
    long = [("t", "r", "", "n", "s", "", 1, 1, 0, "")] + [("t", f"k{i}", "r", "k", "s", "", 2, 1 << 62, 0, "") for i in range(4)]
    found = {r["name"]: r["avg_duration_ns"] for r in tr.shape(table(spark, long)).collect()}
    assert found == {"n": 1, "k": 1 << 62}
    with pytest.raises(OverflowError):
        walk._minus(*(pa.array([x]).to_numpy() for x in (-(1 << 63), 1)))
    with pytest.raises(OverflowError):
        walk._plus(*(pa.array([x]).to_numpy() for x in ((1 << 63) - 1, 1)))
