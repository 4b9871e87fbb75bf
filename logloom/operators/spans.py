"""Span tables: normalisation, filters, and service / operation / attribute statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.coerce import to_int64
from logloom.functions.predicates import field
from logloom.functions.text import is_error, kind_short, status_short
from logloom.operators.aggregate import any_missing, merged_aggs, missing

# Span columns, the attribute that carries each, kinds and limits.
TEXT_FIELDS = {
    "trace_id": "$span.trace_id",
    "span_id": "$span.span_id",
    "parent_span_id": "$span.parent_span_id",
    "name": "$span.name",
    "kind": "$span.kind",
    "service": "$service.name",
    "status": "$span.status_code",
}
NUMBER_FIELDS = {
    "start_ns": "$span.start_time_unix_nano",
    "end_ns": "$span.end_time_unix_nano",
    "duration_ns": "$span.duration_nano",
}
SPAN_COLUMNS = [*TEXT_FIELDS, *NUMBER_FIELDS]
KINDS = ("SERVER", "CLIENT", "INTERNAL", "PRODUCER", "CONSUMER")
ERROR_STATUS = "STATUS_CODE_ERROR"
LIST_LIMIT = 50
SERVICE_LIMIT = 50
OPERATION_LIMIT = 25
ATTRIBUTE_LIMIT = 50


def normalize_spans(df: DataFrame) -> DataFrame:
    """Span columns out of events (``$span.*`` fields) or an already flat table.

    Missing text is empty, numbers are tolerant (0 when they do not parse),
    ``kind`` loses its prefix, a missing duration comes from the bounds and
    then a missing end from the duration. Other columns pass through.
    """

    def source(column: str, attribute: str) -> Column | None:
        if column in df.columns:
            return F.col(f"`{column}`")
        return field(attribute) if "attrs" in df.columns else None

    columns = {}
    for name, attribute in TEXT_FIELDS.items():
        found = source(name, attribute)
        text = F.lit("") if found is None else F.coalesce(found.cast("string"), F.lit(""))
        columns[name] = kind_short(text) if name == "kind" else text
    for name, attribute in NUMBER_FIELDS.items():
        found = source(name, attribute)
        if found is None:
            columns[name] = F.lit(0).cast("bigint")
        elif dict(df.dtypes).get(name) == "bigint":
            columns[name] = F.coalesce(found, F.lit(0).cast("bigint"))
        else:
            columns[name] = to_int64(found)
    rest = [c for c in df.columns if c not in SPAN_COLUMNS]
    staged = df.select(*[c.alias(n) for n, c in columns.items()], *[F.col(f"`{c}`") for c in rest])
    start, end, duration = F.col("start_ns"), F.col("end_ns"), F.col("duration_ns")
    staged = staged.withColumn(
        "duration_ns",
        F.when((duration == 0) & (end > start) & (start > 0), end - start).otherwise(duration),
    )
    return staged.withColumn(
        "end_ns",
        F.when((end == 0) & (start > 0) & (duration > 0), start + duration).otherwise(end),
    )


def error_exact() -> Column:
    """The strict error test of the tables and samplers."""
    return F.col("status").isNotNull() & (F.col("status") == ERROR_STATUS)


def error_loose() -> Column:
    """The tolerant error test of trees and entry matching."""
    return is_error("status")


def kind_is(kind: str) -> Column:
    """Span kind, with or without prefix and in any case; ValueError when unknown."""
    bare = kind.strip().upper().removeprefix("SPAN_KIND_")
    if bare not in KINDS:
        raise ValueError(f"unknown span kind {kind!r}, expected one of {', '.join(KINDS)}")
    return F.col("kind").isin(bare, f"SPAN_KIND_{bare}")


def longer_than(ms: float) -> Column:
    """Strictly longer, as lists and samplers test it."""
    return F.col("duration_ns") > int(ms * 1e6)


def at_least(ms: float) -> Column:
    """At least as long, as entry matching tests it."""
    return F.col("duration_ns").cast("double") >= ms * 1e6


def root_only() -> Column:
    """Spans whose own record names no parent."""
    return F.col("parent_span_id").isNull() | (F.col("parent_span_id") == "")


def span_filter(
    service: str = "",
    operation: str = "",
    min_ms: float = 0,
    errors_only: bool = False,
    kind: str = "",
    where: Column | None = None,
) -> Column:
    """AND of the given tests: the selection of lists and of trace samples."""
    test = F.lit(True)
    if kind:
        test = test & kind_is(kind)
    if service:
        test = test & (F.col("service") == service)
    if operation:
        test = test & (F.col("name") == operation)
    if min_ms > 0:
        test = test & longer_than(min_ms)
    if errors_only:
        test = test & error_exact()
    return test if where is None else test & where


def _recency(spans: DataFrame) -> str:
    return "event_time" if "event_time" in spans.columns else "start_ns"


def list_spans(
    spans: DataFrame,
    service: str = "",
    operation: str = "",
    min_ms: float = 0,
    errors_only: bool = False,
    n: int = LIST_LIMIT,
) -> DataFrame:
    """Most recent matching spans; ties by trace, span, name, duration and service."""
    kept = spans.filter(span_filter(service, operation, min_ms, errors_only))
    time = _recency(spans)
    return (
        kept.orderBy(F.desc(time), "trace_id", "span_id", "name", "duration_ns", "service")
        .limit(n)
        .select(
            time,
            "service",
            F.col("name").alias("operation"),
            "duration_ns",
            status_short("status").alias("status"),
            "trace_id",
            "span_id",
        )
    )


def services(spans: DataFrame, errors_only: bool = False, n: int = SERVICE_LIMIT) -> DataFrame:
    """Spans, mean and maximum duration per service, busiest first."""
    kept = spans.filter(error_exact()) if errors_only else spans
    rows = merged_aggs(kept, ["service"], "duration_ns")
    return rows.orderBy(F.desc("spans"), F.asc("service")).limit(n)


def operations(
    spans: DataFrame, service: str = "", errors_only: bool = False, n: int = OPERATION_LIMIT
) -> DataFrame:
    """As :func:`services`, per service and operation."""
    kept = spans.filter(span_filter(service, errors_only=errors_only))
    rows = merged_aggs(kept.withColumn("operation", F.col("name")), ["service", "operation"], "duration_ns")
    return rows.orderBy(F.desc("spans"), F.asc("service"), F.asc("operation")).limit(n)


def attribute_name(name: str) -> str:
    bare = name.strip()
    if not bare or bare == "$":
        raise ValueError("attribute name is empty")
    return bare if bare.startswith("$") else f"${bare}"


def attribute(spans: DataFrame, name: str) -> Column:
    """Value of a span attribute: a span column, a column of that name, or an ``attrs`` entry."""
    full = attribute_name(name)
    for column, carried in {**TEXT_FIELDS, **NUMBER_FIELDS}.items():
        if carried == full:
            return F.col(column).cast("string")
    if full[1:] in spans.columns:
        return F.col(f"`{full[1:]}`").cast("string")
    return F.coalesce(field(full), field(full[1:]))


def _attribute_groups(
    spans: DataFrame,
    by: list[str],
    root_only_: bool,
    service: str,
    kind: str,
    where: Column | None,
    errors_only: bool,
) -> tuple[DataFrame, list[str]]:
    keys = [attribute_name(name)[1:] for name in by]
    test = span_filter(service, kind=kind, errors_only=errors_only, where=where)
    kept = spans.filter(root_only() & test if root_only_ else test)
    keyed = kept.select(
        *[F.coalesce(attribute(spans, name), F.lit("")).alias(key) for name, key in zip(by, keys)],
        "duration_ns",
        error_exact().alias("_error"),
    )
    return merged_aggs(keyed, keys, "duration_ns", F.col("_error")), keys


def one_decimal(value: Column) -> Column:
    """A double from 0 to 100 as ``%.1f`` prints it: its exact binary value is rounded, ties to even.

    ``round`` and ``bround`` go by the shortest decimal text instead, which moves ties.
    """
    whole = F.floor(value)
    tenths = ((value - whole) * float(1 << 57)).cast("bigint") * 10
    down, rest, half = F.shiftright(tenths, 57), tenths.bitwiseAND((1 << 57) - 1), 1 << 56
    up = (rest > half) | ((rest == half) & ((whole * 10 + down) % 2 == 1))
    return (whole * 10 + down + up.cast("bigint")).cast("double") / 10


def attributes(
    spans: DataFrame,
    by: list[str],
    root_only: bool = True,
    service: str = "",
    kind: str = "",
    where: Column | None = None,
    errors_only: bool = False,
    include_empty: bool = False,
    n: int = ATTRIBUTE_LIMIT,
) -> DataFrame:
    """Spans, errors, error share and durations per attribute values, busiest first.

    Groups with a missing value are dropped (:func:`attributes_dropped` counts
    them) or labelled. ``error_pct`` has one decimal, ties go to the even one.
    With ``errors_only`` the error columns say nothing and are left out.
    """
    grouped, keys = _attribute_groups(spans, by, root_only, service, kind, where, errors_only)
    rows = missing(grouped, keys, include_empty)
    measured = [] if errors_only else ["errors", one_decimal(F.col("errors") / F.col("spans") * 100).alias("error_pct")]
    return (
        rows.orderBy(F.desc("spans"), *[F.asc(f"`{k}`") for k in keys])
        .limit(n)
        .select(*[F.col(f"`{k}`") for k in keys], "spans", *measured, "avg_ns", "max_ns")
    )


def attributes_dropped(
    spans: DataFrame,
    by: list[str],
    root_only: bool = True,
    service: str = "",
    kind: str = "",
    where: Column | None = None,
    errors_only: bool = False,
) -> DataFrame:
    grouped, keys = _attribute_groups(spans, by, root_only, service, kind, where, errors_only)
    return grouped.agg(F.count_if(any_missing(keys)).alias("dropped"))


def sample_traces(spans: DataFrame, where: Column | None = None, n: int = 30) -> DataFrame:
    """Up to ``n`` trace ids, the one with the most recent matching span first."""
    kept = spans.filter("trace_id <> ''")
    kept = kept if where is None else kept.filter(where)
    latest = kept.groupBy("trace_id").agg(F.max(_recency(spans)).alias("latest"))
    return latest.orderBy(F.desc("latest"), F.asc("trace_id")).limit(n)


def spans_of(spans: DataFrame, ids: DataFrame) -> DataFrame:
    """Every span of the given traces.

    No hint: the runtime size of ``ids`` decides between a broadcast (a sample)
    and a shuffle (a large id table).
    """
    return spans.join(ids.select("trace_id").distinct(), "trace_id", "left_semi")


def trace_bounds(spans: DataFrame) -> DataFrame:
    """Start, end and total length of every trace; a start of 0 does not count."""
    zero = F.lit(0).cast("bigint")
    grouped = spans.groupBy("trace_id").agg(
        F.coalesce(F.min(F.when(F.col("start_ns") > 0, F.col("start_ns"))), zero).alias("start_ns"),
        F.greatest(F.max("end_ns"), zero).alias("_end"),
        F.greatest(F.max("duration_ns"), F.lit(1).cast("bigint")).alias("_longest"),
    )
    end = F.greatest("_end", "start_ns")
    return grouped.select(
        "trace_id",
        "start_ns",
        end.alias("end_ns"),
        F.greatest(end - F.col("start_ns"), F.col("_longest")).alias("total_ns"),
    )


def trace_sizes(spans: DataFrame) -> DataFrame:
    """Spans and distinct services per trace."""
    return spans.groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("spans"), F.count_distinct("service").alias("services")
    )
