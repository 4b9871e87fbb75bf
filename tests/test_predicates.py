"""Two-valued predicate semantics."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logloom.functions import predicates as p
from logloom.functions.coerce import to_int64, to_number
from logloom.functions.regex import java_regex


def event(spark, attrs):
    return spark.createDataFrame([(attrs, "raw line")], "attrs map<string,string>, raw string")


def holds(df, predicate):
    value = df.select(predicate.alias("p")).first()["p"]
    assert value is not None
    return value


def test_truth_tables(spark):
    one = event(spark, {"status": "502", "level": "error", "duration_ms": "120.5", "path": "/api/v1/checkout"})
    true = [
        p.ge("status", 500), p.eq("status", 502), p.eq("level", "error"),
        p.gt("duration_ms", 100) & p.ge("status", 500), p.eq("level", "info") | p.eq("status", 502),
        ~p.eq("level", "info"), p.match("path", "checkout$"),
        (p.eq("level", "info") | p.eq("level", "error")) & p.ge("status", 500),
    ]
    false = [
        p.lt("status", 500), p.ne("status", 502), p.ne("level", "error"), p.eq("level", "info"),
        ~p.ge("status", 500), p.nmatch("path", "checkout$"), p.match("path", "^/admin"),
    ]
    row = one.select(*[c.alias(f"c{i}") for i, c in enumerate(true + false)]).first()
    assert list(row) == [True] * len(true) + [False] * len(false)


def test_absent_and_null(spark):
    df = event(spark, {"present": "x", "nil": None, "empty": ""})
    assert not holds(df, p.eq("missing", "x"))
    assert not holds(df, p.ne("missing", "x"))
    assert holds(df, ~p.eq("missing", "x"))
    assert not holds(df, p.eq("nil", "x")) and not holds(df, p.ne("nil", "x"))
    assert holds(df, p.match("present", "x")) and not holds(df, p.gt("present", 5))
    assert not holds(df, p.nmatch("missing", "x"))
    assert holds(df, p.exists("present")) and not holds(df, p.exists("empty"))
    # an exclude rule keeps what an absent field cannot match
    assert holds(df, p.field_rules(exclude=[("missing", "x")]))
    assert not holds(df, p.field_rules(include=[("missing", "x")]))


def test_text_number_and_bool_literals(spark):
    df = event(spark, {"status": "502", "padded": "0502", "flag": "true"})
    assert holds(df, p.ge("status", 500)) and holds(df, p.eq("status", 502))
    assert holds(df, p.eq("padded", 502)) and not holds(df, p.eq("padded", "502"))
    assert holds(df, p.eq("flag", True)) and not holds(df, p.gt("flag", 0))
    assert not holds(df, p.gt("status", "500"))


def test_numbers(spark):
    texts = ["5", "5d", " 5 ", "1_0", ".5", "5.", "1e3", "1e999", "inf", "-Infinity", "nan", "", "0x1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["n"] for r in df.select("t", to_number("t").alias("n")).collect()}
    assert got == {
        "5": 5.0, "5d": None, " 5 ": None, "1_0": None, ".5": 0.5, "5.": 5.0, "1e3": 1000.0, "1e999": None,
        "inf": float("inf"), "-Infinity": float("-inf"), "nan": None, "": None, "0x1": None,
    }
    ints = spark.createDataFrame([("4367602734065516545",), ("250.9",), ("x",), (None,)], "t string")
    assert [r[0] for r in ints.select(to_int64("t")).collect()] == [4367602734065516545, 250, 0, 0]


def test_clause_typing(spark):
    df = event(spark, {"status": "502", "level": "error", "ok": "true", "k": "7"})
    assert holds(df, p.clauses([("status", ">=", "500"), ("level", "=", "error"), ("k", "~", "7"), ("ok", "=", "true")]))
    assert not holds(df, p.clauses([("status", ">", "abc")]))
    assert holds(df, p.clauses([]))
    with pytest.raises(ValueError):
        p.clauses([("a", "<>", "1")])


def test_line_rules(spark):
    df = spark.createDataFrame([("error healthz",), ("error here",), ("fine",), (None,)], "raw string")
    got = df.filter(p.line_rules(["error"], ["healthz"])).collect()
    assert [r["raw"] for r in got] == ["error here"]


def test_regex_dialect(spark):
    for bad in ("[", "(?=a)", "(?<!a)b", r"(a)\1", "a++", "(a"):
        with pytest.raises(ValueError):
            java_regex(bad)
    df = spark.createDataFrame([("abc\n",), ("abc",), ("a$b",), ("a[b",), ("a\rb",)], "raw string")

    def found(pattern):
        return {r["raw"] for r in df.filter(p.match("@raw", pattern)).collect()}

    assert found("c$") == {"abc"}
    assert found(r"a\$b") == {"a$b"} and found("a[$]b") == {"a$b"} and found("a[[]b") == {"a[b"}
    assert "a\rb" in found("a.b")
    assert found("(?P<x>a)bc") == {"abc", "abc\n"}
    assert found("^[[:alpha:]]+$") == {"abc"}


VALUES = st.one_of(
    st.none(), st.sampled_from(["5", "05", "5.0", "-1", "abc", "true", "", "1e2", "5d", "nan"]),
)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from("abc"), VALUES), min_size=1, max_size=8),
       st.sampled_from([5, -1.0, "5", "abc", True]), st.sampled_from(["=", "!=", ">", ">=", "<", "<="]))
def test_leaves_match_a_plain_evaluation(spark, events, literal, op):
    import re

    number = re.compile(p.to_number.__globals__["DECIMAL_TEXT"])

    def plain(attrs):
        value = attrs.get("a")
        if value is None:
            return False
        left = float(value) if number.match(value) else None
        numeric = isinstance(literal, (int, float)) and not isinstance(literal, bool)
        if op in ("=", "!="):
            text = {True: "true"}.get(literal) if isinstance(literal, bool) else literal
            same = (left is not None and left == literal) if numeric else value == text
            return same if op == "=" else not same
        if left is None or not numeric:
            return False
        return {">": left > literal, ">=": left >= literal, "<": left < literal, "<=": left <= literal}[op]

    df = spark.createDataFrame([(i, e) for i, e in enumerate(events)], "i int, attrs map<string,string>").coalesce(1)
    leaf = p.clauses([("a", op, literal)]) if not isinstance(literal, str) else p._OPERATORS[op]("a", literal)
    got = {r["i"]: (r["x"], r["y"]) for r in df.select("i", leaf.alias("x"), (~leaf).alias("y")).collect()}
    assert got == {i: (plain(e), not plain(e)) for i, e in enumerate(events)}


def test_core_columns_reach_the_scan(spark, tmp_path):
    rows = [(i, "error" if i % 3 else None, "u", {"k": str(i)}) for i in range(20)]
    df = spark.createDataFrame(rows, "sequence bigint, status string, origin string, attrs map<string,string>")
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    test = p.eq("@status", "error") & p.ge("@sequence", 5) & p.ne("@origin", "x") & p.lt("@sequence", 9.5) & p.gt("k", 6)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    kept = stored.filter(test)
    pushed = kept._jdf.queryExecution().executedPlan().toString().split("PushedFilters: [")[1].split("ReadSchema")[0]
    for part in ("EqualTo(status,error)", "GreaterThanOrEqual(sequence,5)", "Not(EqualTo(origin,x))"):
        assert part in pushed
    assert sorted(r["sequence"] for r in kept.collect()) == [7, 8]
    other = stored.filter(~p.eq("@status", "error"))
    assert sorted(r["sequence"] for r in other.collect()) == [0, 3, 6, 9, 12, 15, 18]
    assert stored.filter(p.eq("@sequence", 7) | p.eq("@sequence", "8")).count() == 2


def test_columns_as_fields(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("7", None), ("x", "y")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    tests = [p.eq(a, 7), p.ne(a, 7), p.gt(a, 5), p.le(a, 5), p.match(a, "^x"), p.nmatch(b, "z"), p.exists(b), ~p.eq(b, "y")]
    rows = [tuple(r) for r in df.select(*[t.alias(f"t{i}") for i, t in enumerate(tests)]).collect()]
    assert rows == [
        (True, False, True, False, False, False, False, True), (False, True, False, False, True, True, True, False)
    ]
