"""Masking and clustering against a line-by-line implementation of the rules."""

import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from logloom.functions.mask import mask_line
from logloom.operators import templates as tm
from logloom.operators.templates import template_clusters, template_counts

LETTERS = str.maketrans("0123456789ABCDEFGHIJKLMNOP", "abcdefghijklmnopqrstuvwxyz")


def brute_force(token_lists, similarity=0.5):
    by_arity = {}
    for tokens, line in token_lists:
        clusters = by_arity.setdefault(len(tokens), [])
        best, best_hits = None, 0
        for c in clusters:
            hits = sum(a == b or a == "<*>" for a, b in zip(c["t"], tokens))
            if hits > best_hits:
                best, best_hits = c, hits
        if best is None or best_hits / len(tokens) < similarity:
            clusters.append({"t": list(tokens), "n": 1, "e": line})
            continue
        best["n"] += 1
        best["t"] = [a if a == b else "<*>" for a, b in zip(best["t"], tokens)]
    return sorted((" ".join(c["t"]), c["n"], c["e"]) for cs in by_arity.values() for c in cs)


def check(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "seq bigint, line string").repartition(4)
    masked = dict(df.select("seq", mask_line("line")).collect())
    expected = brute_force([(masked[i].split(" "), line) for i, line in enumerate(lines)])
    got = sorted(map(tuple, template_clusters(df, "line", ["seq"]).collect()))
    assert got == expected
    return got


def test_mask_tokens(spark):
    cases = {
        "id=550e8400-e29b-41d4-a716-446655440000 n=42 h=deadbeefdeadbeef plain": "id=<uuid> n=<num> h=<hex> plain",
        "GET /api/v1/users/12 200 36ms": "GET /api/v1/users/<num> <num> <num>",
        "a==5 =5 x=/a/1 [12],": "a==5 =5 x=/a/<num> [<num>],",
        "k=a=7 1.5kb -3 12:30 /": "k=a=<num> <num> <num> 12:30 /",
        "abcdefabcdef Abcdef 99%": "<hex> Abcdef <num>",
    }
    df = spark.createDataFrame([(k,) for k in cases], "line string")
    got = {r[0]: r[1] for r in df.select("line", mask_line("line")).collect()}
    assert got == cases


def test_three_shapes(spark):
    lines = [f"GET /api/v1/users/{i} 200 {3 * i}ms" for i in range(50)]
    lines += [f"connection pool exhausted pool=worker-{i}" for i in range(5)]
    lines.append("totally unique line about nothing else at all")
    got = sorted(check(spark, lines), key=lambda r: -r[1])
    assert [r[1] for r in got] == [50, 5, 1]
    assert "GET" in got[0][0] and "<num>" in got[0][0]
    assert got[1][0].startswith("connection pool exhausted")


def test_token_counts_do_not_mix(spark):
    assert len(check(spark, ["a b c", "a b c", "a b c d"])) == 2


def test_random_lines_equal_line_by_line(spark, monkeypatch):
    # small blocks, so that the result needs several rounds
    monkeypatch.setattr(tm, "FIRST_BLOCK", 7)
    monkeypatch.setattr(tm, "LARGEST_BLOCK", 40)
    for seed in range(3):
        rng = random.Random(seed)
        words = ["alpha", "beta", "gamma", "delta", "7", "<*>", "x=1"][: 5 + seed]
        lines = [
            " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 4, 6]))) for _ in range(400)
        ]
        check(spark, lines)


def numbered_brute_force(rows, similarity=0.5):
    """As ``brute_force`` for lines of one token count, as codes: {template codes: count}; -1 is the wildcard."""
    clusters, counts = np.empty((0, len(rows[0])), dtype=np.int64), []
    for row in rows:
        hits = ((clusters == row) | (clusters == -1)).sum(axis=1)
        at = int(hits.argmax()) if len(hits) else -1
        if at < 0 or hits[at] < similarity * len(row):
            clusters, counts = np.vstack([clusters, row]), [*counts, 1]
            continue
        counts[at] += 1
        clusters[at][clusters[at] != row] = -1
    return sorted((tuple(c), n) for c, n in zip(clusters.tolist(), counts))


def test_one_token_count_with_100_000_forms(spark):
    """No ordered step sees a tenth of the forms, and the result is still that of the sequence."""
    assert 10 * tm.LARGEST_BLOCK <= 100_000
    rng = np.random.default_rng(7)
    shapes = rng.integers(0, 400, (150, 10))
    rows = shapes[rng.integers(0, 150, 110_000)]
    free = rng.random(rows.shape) < np.where(np.arange(10) < 4, 0.5, 0.02)
    rows = np.where(free, rng.integers(1_000, 50_000, rows.shape), rows)
    rows = rows[np.sort(np.unique(rows, axis=0, return_index=True)[1])][:100_000]
    assert len(rows) == 100_000
    name = lambda codes: " ".join("<*>" if c < 0 else "w" + np.base_repr(c, 26).translate(LETTERS) for c in codes)
    lines = [(i, name(row)) for i, row in enumerate(rows.tolist())]
    df = spark.createDataFrame(pd.DataFrame(lines, columns=["seq", "line"])).repartition(8)
    got = sorted((r.template, r["count"]) for r in template_clusters(df, "line", ["seq"]).collect())
    assert got == sorted((name(t), n) for t, n in numbered_brute_force(rows))


def test_counts_keep_first_example(spark):
    df = spark.createDataFrame(
        [(2, "took 5ms"), (1, "took  9ms"), (3, "other"), (4, "  ")], "seq int, line string"
    )
    got = {tuple(r) for r in template_counts(df, "line", ["seq"]).collect()}
    assert got == {("took <num>", 2, "took  9ms"), ("other", 1, "other")}


def test_counts_on_driver_lines_match_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    got = {r["template"]: r["count"] for r in template_counts(lines, "line", ["line"]).collect()}
    num = re.compile(r"-?\d+(\.\d+)?(ms|us|ns|s|m|h|d|%|b|kb|mb|gb|KB|MB|GB)?")
    uuid = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
    expected = {}
    for (line,) in lines.collect():
        out = []
        for token in line.split():
            prefix, rest = re.match(r"((?:[^=]+=)*)(.*)$", token, re.S | re.A).groups()
            parts = rest.split("/") if len(rest) > 1 else [rest]
            for i, part in enumerate(parts):
                core = part.strip("\"',;:()[]{}")
                for rx, tag in ((num, "<num>"), (uuid, "<uuid>"), (re.compile("[0-9a-fA-F]{12,}"), "<hex>")):
                    if core and rx.fullmatch(core):
                        parts[i] = part.replace(core, tag, 1)
                        break
            out.append(prefix + "/".join(parts))
        if out:
            expected[" ".join(out)] = expected.get(" ".join(out), 0) + 1
    assert got == expected
