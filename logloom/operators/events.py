"""Ordering, limits, first-seen rows and neighbourhoods of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.functions.coerce import to_number
from logloom.functions.predicates import field
from logloom.operators.ranking import running

# Default limits.
LIMIT = 100
CONTEXT = 50


def _time_order(df: DataFrame) -> list[Column]:
    """Time, then sequence where there is one (absent counts as 0)."""
    ties = [F.coalesce("sequence", F.lit(0))] if "sequence" in df.columns else []
    return [F.col("event_time"), *ties]


def chronological(df: DataFrame) -> DataFrame:
    """By time, then sequence (an absent one counts as 0)."""
    return df.orderBy(*[c.asc() for c in _time_order(df)])


def recent(df: DataFrame, n: int | None = LIMIT) -> DataFrame:
    """Newest first; with ``n`` a top-n, not a full sort."""
    ordered = df.orderBy(*[c.desc() for c in _time_order(df)])
    return ordered if n is None else ordered.limit(n)


def oldest(df: DataFrame, n: int | None = LIMIT) -> DataFrame:
    ordered = chronological(df)
    return ordered if n is None else ordered.limit(n)


def order_by(df: DataFrame, name: str, desc: bool = False, ties: list[str] = ()) -> DataFrame:
    """By a field: numbers before text, each in its own order, absent last."""
    text = F.col(f"`{name}`").cast("string") if name in df.columns else field(name)
    number = to_number(text)
    if desc:
        keys = [number.desc_nulls_last(), text.desc_nulls_last()]
    else:
        keys = [number.asc_nulls_last(), text.asc_nulls_last()]
    return df.orderBy(*keys, *ties)


def limit(df: DataFrame, n: int = LIMIT) -> DataFrame:
    if n < 1:
        raise ValueError("limit must be at least 1")
    return df.limit(n)


def head(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows, stopping the scan early (input order is not kept)."""
    return df.limit(n)


def top_values(df: DataFrame, name: str, k: int, keys: list[str] = ()) -> DataFrame:
    """The ``k`` most frequent values of a field per group (value ascending on ties)."""
    text = F.col(f"`{name}`").cast("string") if name in df.columns else field(name)
    counted = (
        df.select(*keys, text.alias("value"))
        .filter("value <> ''")
        .groupBy(*keys, "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    if not keys:
        return counted.orderBy(F.desc("count"), F.asc("value")).limit(k)
    # the rank filter is also applied before the shuffle, k rows per partition and group
    place = F.row_number().over(
        Window.partitionBy(*keys).orderBy(F.desc("count"), F.asc("value"))
    )
    return counted.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")


def first_seen(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of every key in ``order``: a mergeable minimum, no per-key sort."""
    rest = [c for c in df.columns if c not in key]
    ranked = F.struct(*order)
    first = df.groupBy(*key).agg(F.min_by(F.struct(*rest), ranked).alias("_first"))
    return first.select(*key, "_first.*").select(*df.columns)


def _inside(direction: str) -> tuple[bool, bool]:
    if direction not in ("before", "after", "both"):
        raise ValueError(f"direction must be before, after or both; got {direction!r}")
    return direction != "after", direction != "before"


def around(
    events: DataFrame,
    dataset: str,
    sequence: int,
    at,
    n: int = CONTEXT,
    direction: str = "both",
) -> DataFrame:
    """Up to ``n`` events on each side of one event of a dataset, in time order.

    Two bounded top-n reads with the dataset and time tests pushed into the
    scan. The event itself is part of ``both`` only.
    """
    before, after = _inside(direction)
    own = events.filter(F.col("dataset") == dataset)
    here = F.struct(F.col("event_time"), F.col("sequence"))
    dtype = events.schema["event_time"].dataType
    time = F.lit(at).cast(dtype)
    anchor = F.struct(time.alias("event_time"), F.lit(sequence).cast("bigint").alias("sequence"))
    parts = []
    if before:
        older = own.filter((F.col("event_time") <= time) & (here < anchor))
        parts.append(older.orderBy(F.desc("event_time"), F.desc("sequence")).limit(n))
    if before and after:
        parts.append(own.filter((F.col("event_time") == time) & (F.col("sequence") == sequence)))
    if after:
        newer = own.filter((F.col("event_time") >= time) & (here > anchor))
        parts.append(newer.orderBy(F.asc("event_time"), F.asc("sequence")).limit(n))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy("event_time", "sequence")


def neighbours(
    events: DataFrame, anchors: DataFrame, n: int = CONTEXT, direction: str = "both"
) -> DataFrame:
    """:func:`around` for a whole table of anchors (``dataset, sequence, event_time``).

    Events get their position in the dataset once; an anchor then asks for the
    positions next to its own, so the join key is unique and no dataset, however
    large, ends up in one task. Adds ``anchor_sequence`` and ``offset``.
    """
    before, after = _inside(direction)
    wanted = anchors.select("dataset", "sequence", "event_time").distinct()
    own = events.join(wanted.select("dataset").distinct(), "dataset", "left_semi")
    ranked = running(own, ["dataset"], ["event_time", "sequence"], rank="_rank")
    found = ranked.join(wanted, ["dataset", "sequence", "event_time"], "left_semi").select(
        "dataset", F.col("sequence").alias("anchor_sequence"), F.col("_rank").alias("_at")
    )
    steps = F.sequence(F.lit(-n if before else 1), F.lit(n if after else -1))
    asked = found.select(
        "dataset", "anchor_sequence", "_at", F.explode(steps).alias("offset")
    ).withColumn("_rank", F.col("_at") + F.col("offset"))
    return ranked.join(asked, ["dataset", "_rank"]).select(
        "anchor_sequence", F.col("offset").cast("bigint").alias("offset"), *events.columns
    )
