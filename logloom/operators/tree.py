"""Span trees of many traces at once: roots, waterfalls and cross-trace shapes.

Traces of up to ``LARGE`` spans are dealt out by trace once and walked where
they lie (:mod:`logloom.operators.walk`). A longer trace is never held by one
task, however many spans it has: there a span's path is found by pointer
doubling. Each span starts with its parent as pointer and every round replaces
the pointer by the pointer's own pointer, so a tree of depth ``d`` takes about
``log2(d)`` shuffles keyed by (trace, span).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import is_error, status_short
from logloom.operators import walk
from logloom.operators.ranking import running
from logloom.operators.spans import kind_is
from logloom.session import materialize

_WATERFALL = ["trace_id", "span_id", "parent_span_id", "service", "name", "start_ns", "duration_ns", "status"]
_SHAPE = ["trace_id", "span_id", "parent_span_id", "service", "name", "kind", "start_ns", "duration_ns", "status"]

# Spans of a trace that one task walks at most, and the numbers of spans counted to find the longer ones.
LARGE, COUNTED = 200_000, 8192


@dataclass(frozen=True)
class EntryMatch:
    """Which span of a trace is its entry; all tests must hold."""

    entry_only: bool = False
    service: str = ""
    operation: str = ""
    errors_only: bool = False
    min_ms: float = 0

    @property
    def active(self) -> bool:
        return bool(
            self.entry_only or self.service or self.operation or self.errors_only or self.min_ms > 0
        )

    def column(self) -> Column:
        test = F.lit(True)
        if self.entry_only:
            test = test & kind_is("SERVER")
        if self.service:
            test = test & (F.col("service") == self.service)
        if self.operation:
            test = test & (F.col("name") == self.operation)
        if self.errors_only:
            test = test & is_error("status")
        if self.min_ms > 0:
            test = test & (F.col("duration_ns").cast("double") >= self.min_ms * 1e6)
        return test


def _first_by(columns: list[str]) -> list[str]:
    """Which span of a repeated id stays: the earliest, then by name, then by the other columns."""
    return ["start_ns", "name", *[c for c in columns if c not in ("trace_id", "span_id", "start_ns", "name")]]


def _by_length(spans: DataFrame, large: int) -> tuple[DataFrame, DataFrame | None]:
    """The spans of traces that one task can walk, and all others, if any.

    The others are traces of more than ``large`` spans or with a null. Only
    sums over ``COUNTED`` hash values are counted first; traces are counted one
    by one just where such a sum is large.
    """
    odd = reduce(Column.__or__, [F.col(c).isNull() for c in spans.columns])
    sums = [F.count(F.lit(1)).alias("_n"), F.count_if(odd).alias("_odd")]
    apart = (F.col("_n") > large) | (F.col("_odd") > 0)
    slot = F.pmod(F.xxhash64("trace_id"), F.lit(COUNTED))
    slots = [r["_slot"] for r in spans.groupBy(slot.alias("_slot")).agg(*sums).filter(apart).collect()]
    if not slots:
        return spans, None
    found = spans.filter(slot.isin(slots)).groupBy("trace_id").agg(*sums).filter(apart)
    found = materialize(found.select(F.col("trace_id").alias("_apart")))
    if found.isEmpty():
        return spans, None
    same = F.col("trace_id").eqNullSafe(F.col("_apart"))
    return spans.join(found, same, "left_anti"), spans.join(found, same, "left_semi")


def _dealt(spans: DataFrame) -> DataFrame:
    """Whole traces in each task, one after the other."""
    return spans.repartition("trace_id").sortWithinPartitions("trace_id")


def unique_spans(spans: DataFrame) -> DataFrame:
    """One row per (trace, span id), the earliest; spans without id are all kept.

    ``spans`` is read several times, so pass a stored table. Repeated ids are
    rare: a narrow count finds them and only their rows are compared.
    """
    keys = ["trace_id", "span_id"]
    repeated = spans.filter("span_id <> ''").groupBy(*keys).count().filter("count > 1").select(*keys)
    if repeated.isEmpty():
        return spans
    repeated = materialize(repeated)
    rest = [c for c in spans.columns if c not in keys]
    # stored: a union of two sides dealt out by the same keys pairs their partitions (Spark 4.1),
    # and fails when their numbers are changed at run time
    first = materialize(
        spans.join(repeated, keys, "left_semi")
        .groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*_first_by(spans.columns))).alias("_s"))
        .select(*keys, "_s.*")
        .select(*spans.columns)
    )
    return spans.join(repeated, keys, "left_anti").select(*spans.columns).unionByName(first)


def children(spans: DataFrame) -> DataFrame:
    """(trace, parent span, child span) edges inside a trace."""
    parents = spans.filter("span_id <> ''").select(
        "trace_id", F.col("span_id").alias("parent_span_id")
    ).distinct()
    kids = spans.filter("span_id <> parent_span_id")
    return kids.join(parents, ["trace_id", "parent_span_id"], "left_semi").select(
        "trace_id", "parent_span_id", "span_id"
    )


def with_roots(spans: DataFrame) -> DataFrame:
    """Add ``is_root``: no span of the same trace in this table is the parent."""
    known = spans.filter("span_id <> ''").select(
        "trace_id", F.col("span_id").alias("parent_span_id"), F.lit(False).alias("_inside")
    ).distinct()
    joined = spans.join(known, ["trace_id", "parent_span_id"], "left")
    return joined.select(*spans.columns, F.col("_inside").isNull().alias("is_root"))


def batch_roots(spans: DataFrame) -> DataFrame:
    """Spans whose parent is not in the table: true roots and orphans."""
    known = spans.filter("span_id <> ''").select(
        "trace_id", F.col("span_id").alias("parent_span_id")
    ).distinct()
    return spans.join(known, ["trace_id", "parent_span_id"], "left_anti").select(*spans.columns)


def orphans(spans: DataFrame) -> DataFrame:
    """Batch roots that do name a parent."""
    return batch_roots(spans).filter("parent_span_id <> ''")


def anchors(spans: DataFrame, match: EntryMatch = EntryMatch()) -> DataFrame:
    """One span per trace: the earliest match, else the earliest batch root, else the earliest.

    Start ties go to the smaller span id. A mergeable minimum, no per-trace sort.
    """
    choice = F.when(F.col("is_root"), 1).otherwise(2)
    if match.active:
        choice = F.when(match.column(), 0).otherwise(choice)
    best = with_roots(spans).groupBy("trace_id").agg(
        F.min(F.struct(choice.alias("rank"), "start_ns", "span_id")).alias("_a")
    )
    return best.select(
        "trace_id", F.col("_a.span_id").alias("span_id"), F.col("_a.start_ns").alias("start_ns")
    )


def _split_counts(state: DataFrame) -> tuple[int, int]:
    """How many spans have reached a top, and how many have not."""
    return tuple(
        state.agg(F.count_if(F.col("above").isNull()), F.count_if(F.col("above").isNotNull())).first()
    )


def resolve_paths(nodes: DataFrame) -> DataFrame:
    """``path`` (hops from a top span down to the span) of every span below a top.

    ``nodes``: ``trace_id, span_id, parent_span_id, is_top, hop`` and columns to
    carry. Spans that reach no top (other subtrees, cycles) are left out, as is
    anything below a span without id.
    """
    carried = [c for c in nodes.columns if c not in ("parent_span_id", "is_top", "hop")]
    state = materialize(
        nodes.select(
            *carried,
            F.when(~F.col("is_top"), F.col("parent_span_id")).alias("above"),
            F.array("hop").alias("path"),
        ).filter("above is null or (above <> '' and above <> span_id)")
    )
    done = [state.filter("above is null")]
    pending, waiting = state.filter("above is not null"), _split_counts(state)[1]
    while waiting:
        links = reduce(DataFrame.unionByName, [*done, pending]).filter("span_id <> ''")
        upper = links.select(
            F.col("trace_id"),
            F.col("span_id").alias("above"),
            F.col("above").alias("_above"),
            F.col("path").alias("_path"),
        )
        stepped = materialize(
            pending.join(upper, ["trace_id", "above"]).select(
                *carried,
                F.col("_above").alias("above"),
                F.concat("_path", "path").alias("path"),
            )
        )
        arrived, waiting = _split_counts(stepped)
        # a span at depth d arrives in round log2(d): what waits after a round
        # without arrivals hangs below a cycle
        if not arrived:
            break
        done.append(stepped.filter("above is null"))
        pending = stepped.filter("above is not null")
    return reduce(DataFrame.unionByName, done).drop("above")


def _with_tops(spans: DataFrame) -> DataFrame:
    """Add ``is_top``: every batch root, or the earliest span of a trace that has none."""
    flagged = with_roots(spans)
    rootless = (
        flagged.groupBy("trace_id")
        .agg(
            F.bool_or("is_root").alias("_rooted"),
            F.min(F.struct("start_ns", "span_id")).alias("_first"),
        )
        .filter("not _rooted")
        .select("trace_id", "_first.*", F.lit(True).alias("_earliest"))
    )
    joined = flagged.join(rootless, ["trace_id", "start_ns", "span_id"], "left")
    top = F.col("is_root") | F.coalesce("_earliest", F.lit(False))
    return joined.select(*spans.columns, top.alias("is_top"))


def _waterfalls_by_joins(spans: DataFrame) -> DataFrame:
    base = unique_spans(materialize(spans))
    nodes = _with_tops(base).select(
        "*",
        F.col("parent_span_id").alias("parent"),
        F.struct("start_ns", "duration_ns", "span_id").alias("hop"),
    )
    ordered = running(resolve_paths(nodes), ["trace_id"], ["path"], rank="position")
    return ordered.withColumn("depth", (F.size("path") - 1).cast("bigint")).withColumnRenamed("parent", "parent_span_id")


def waterfalls(spans: DataFrame, large: int = LARGE) -> DataFrame:
    """Depth-first rows of every trace: ``trace_id, position, depth`` and the span.

    Siblings are ordered by (start, duration, span id); spans only reachable
    through a cycle are left out. Traces of more than ``large`` spans are spread
    over tasks.
    """
    whole, apart = _by_length(spans.select(*_WATERFALL), large)
    kinds = dict(whole.dtypes)
    schema = ", ".join(f"{c} {kinds.get(c, 'bigint')}" for c in [*_WATERFALL, "position", "depth"])
    ordered = _dealt(whole).mapInArrow(walk.display_order(_first_by(_WATERFALL)), schema)
    if apart is not None:
        ordered = ordered.unionByName(materialize(_waterfalls_by_joins(apart).select(*ordered.columns)))
    return ordered.select(
        "trace_id",
        "position",
        "depth",
        "service",
        F.col("name").alias("operation"),
        "span_id",
        "parent_span_id",
        "start_ns",
        "duration_ns",
        status_short("status").alias("status"),
        is_error("status").alias("error"),
    )


def waterfall(spans: DataFrame, trace_id: str) -> DataFrame:
    """Rows of one trace in display order; LookupError when it has no spans."""
    own = spans.filter(F.col("trace_id") == trace_id)
    if own.isEmpty():
        raise LookupError(f"no spans found for trace {trace_id!r}")
    return waterfalls(own).orderBy("position")


def shape_paths(spans: DataFrame, match: EntryMatch = EntryMatch()) -> DataFrame:
    """Each span below its trace's anchor: ``path`` of (service, name) hops, offset, duration."""
    base = unique_spans(materialize(spans.select(*_SHAPE)))
    anchor = anchors(base, match).withColumn("_anchor", F.lit(True))
    # the anchor's start reaches the spans below it as the first hop of their path
    nodes = base.join(anchor, ["trace_id", "span_id", "start_ns"], "left").select(
        "trace_id",
        "span_id",
        "parent_span_id",
        "start_ns",
        F.greatest("duration_ns", F.lit(0).cast("bigint")).alias("duration_ns"),
        is_error("status").alias("error"),
        F.coalesce("_anchor", F.lit(False)).alias("is_top"),
        F.struct("service", "name", F.col("start_ns").alias("t")).alias("hop"),
    )
    paths = resolve_paths(nodes)
    offset = F.when(F.col("start_ns") == 0, F.lit(0).cast("bigint")).otherwise(
        F.greatest(F.col("start_ns") - F.col("path")[0]["t"], F.lit(0).cast("bigint"))
    )
    hops = F.transform("path", lambda h: F.struct(h["service"].alias("service"), h["name"].alias("name")))
    return paths.select(
        "trace_id", hops.alias("path"), offset.alias("offset_ns"), "duration_ns", "error"
    )


def shape_parts(paths: DataFrame) -> DataFrame:
    """Sums per path; those of different traces add up."""
    offset, duration = F.col("offset_ns"), F.col("duration_ns")
    return paths.groupBy("path").agg(
        F.count(F.lit(1)).alias("samples"),
        F.count_distinct("trace_id").alias("traces"),
        F.sum(offset.cast("decimal(38,0)")).alias("offsets"),
        F.sum(duration.cast("decimal(38,0)")).alias("durations"),
        F.min(offset).alias("min_offset_ns"),
        F.max(offset + duration).alias("max_end_ns"),
        F.count_if("error").alias("errors"),
    )


def shape_rows(parts: DataFrame) -> DataFrame:
    """Merge the sums of equal paths (no trace is in two parts) into one row per path."""
    sums = [F.sum(c).alias(c) for c in ("samples", "traces", "offsets", "durations", "errors")]
    grouped = parts.groupBy("path").agg(
        *sums, F.min("min_offset_ns").alias("min_offset_ns"), F.max("max_end_ns").alias("max_end_ns")
    )
    last = F.element_at("path", -1)
    above = F.try_element_at("path", F.lit(-2))
    parent = F.when(
        F.size("path") > 1, F.concat(above["service"], F.lit("/"), above["name"])
    )
    return grouped.select(
        "path",
        (F.size("path") - 1).cast("bigint").alias("depth"),
        last["service"].alias("service"),
        last["name"].alias("name"),
        parent.alias("parent"),
        "samples",
        "traces",
        F.expr("cast(offsets div samples as bigint)").alias("avg_offset_ns"),
        F.expr("cast(durations div samples as bigint)").alias("avg_duration_ns"),
        "min_offset_ns",
        "max_end_ns",
        "errors",
    )


def shape_stats(paths: DataFrame) -> DataFrame:
    """Merge equal paths across traces."""
    return shape_rows(shape_parts(paths))


def shape(spans: DataFrame, match: EntryMatch = EntryMatch(), large: int = LARGE) -> DataFrame:
    """The common call tree of many traces, each re-rooted at its anchor.

    Traces of more than ``large`` spans are spread over tasks.
    """
    whole, apart = _by_length(spans.select(*_SHAPE), large)
    flagged = _dealt(whole).select(
        *_SHAPE, is_error("status").alias("_error"), F.coalesce(match.column(), F.lit(False)).alias("_match")
    )
    parts = flagged.mapInArrow(walk.shape_parts(_first_by(_SHAPE), match.active), walk.PARTS)
    if apart is not None:
        parts = parts.unionByName(materialize(shape_parts(shape_paths(apart, match))))
    return shape_rows(parts)


def min_traces(shape_rows: DataFrame, n: int) -> DataFrame:
    """Paths seen in at least ``n`` traces."""
    return shape_rows.filter(F.col("traces") >= n)


def shape_sort(shape_rows: DataFrame) -> DataFrame:
    return shape_rows.orderBy("depth", "avg_offset_ns", "path")


def sibling_rank(shape_rows: DataFrame) -> DataFrame:
    """Place of a path among its siblings: earliest first, then longest."""
    keyed = shape_rows.withColumn("_up", F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0))))
    ranked = running(
        keyed, ["_up"], ["avg_offset_ns", "-avg_duration_ns", "path"], rank="sibling"
    )
    return ranked.drop("_up")


def traces_used(shape_rows: DataFrame) -> DataFrame:
    """Number of traces behind an unfiltered shape (each has one anchor)."""
    top = F.when(F.col("depth") == 0, F.col("traces"))
    return shape_rows.agg(F.coalesce(F.sum(top), F.lit(0)).cast("bigint").alias("traces_used"))


def shape_view(shape_rows: DataFrame, used: int | None = None) -> DataFrame:
    """Add ``sibling``, ``presence`` (``k/N`` traces) and the common ``axis_end_ns``."""
    rows = materialize(shape_rows)
    total = F.lit(used) if used is not None else traces_used(rows).scalar()
    end = F.greatest(F.col("avg_offset_ns") + F.col("avg_duration_ns"), F.col("max_end_ns"))
    axis = rows.agg(F.greatest(F.max(end), F.lit(1).cast("bigint")).alias("axis_end_ns")).scalar()
    return sibling_rank(rows).select(
        "*",
        F.concat(F.col("traces").cast("string"), F.lit("/"), total.cast("string")).alias("presence"),
        axis.alias("axis_end_ns"),
    )
