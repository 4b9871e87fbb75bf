"""Time-sliced aggregates, dense histograms, usage rollups and trends."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from logloom.operators.aggregate import count, key_columns
from logloom.sources.scan import TimeRange, within

# Default number of slices, history length and sparkline levels.
SLICES = 24
HISTORY = 12
LEVELS = 8

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _micros(value: datetime) -> int:
    aware = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    return (aware - _EPOCH) // timedelta(microseconds=1)


def _utc_micros(df: DataFrame, column: str) -> Column:
    """Epoch microseconds; a timestamp without zone reads as UTC whatever the session's zone is."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        if df.sparkSession.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
            value = F.convert_timezone(F.lit("UTC"), F.current_timezone(), value)
        value = value.cast("timestamp")
    return F.unix_micros(value)


def slice_number(df: DataFrame, column: str, start: datetime, end: datetime, n: int) -> Column:
    """0-based slice of ``[start, end)`` cut into ``n`` equal parts."""
    lo, span = _micros(start), _micros(end) - _micros(start)
    if span <= 0 or n <= 0:
        raise ValueError("the range must not be empty and n must be positive")
    offset = _utc_micros(df, column) - F.lit(lo)
    if span * n >= 2**63:
        offset = offset.cast("decimal(38,0)")
    return F.call_function("div", offset * F.lit(n), F.lit(span)).cast("bigint")


def series(
    df: DataFrame,
    n: int,
    start: datetime,
    end: datetime,
    keys: list[str] = (),
    aggs: dict[str, Column] | None = None,
    column: str = "event_time",
) -> DataFrame:
    """Aggregates per (slice, keys); slices without events have no row."""
    inside = df.filter(within(column, TimeRange(start, end), df.schema[column].dataType))
    named = aggs or {"count": count()}
    return inside.groupBy(
        slice_number(df, column, start, end, n).alias("slice"), *key_columns(df, list(keys))
    ).agg(*[c.alias(name) for name, c in named.items()])


def histogram(
    df: DataFrame,
    start: datetime,
    end: datetime,
    n: int = SLICES,
    column: str = "event_time",
) -> DataFrame:
    """Dense counts: one row per slice, zero-filled, with its start in epoch ms."""
    counts = series(df, n, start, end, column=column)
    lo, span = _micros(start), _micros(end) - _micros(start)
    # n is an argument, so both sides of this join are n rows at most
    slices = df.sparkSession.range(n).withColumnRenamed("id", "slice")
    starts = F.expr(f"cast((cast(slice as decimal(38,0)) * {span} div {n} + {lo}) div 1000 as bigint)")
    dense = slices.join(counts, "slice", "left")
    return dense.select(
        "slice",
        starts.alias("timestamp"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
    ).orderBy("slice")


def histogram_summary(buckets: DataFrame) -> DataFrame:
    """Total, largest count, and bucket width of a histogram."""
    first = F.min("timestamp")
    second = F.min(F.when(F.col("slice") == 1, F.col("timestamp")))
    return buckets.agg(
        F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.max("count"), F.lit(0)).cast("bigint").alias("max_count"),
        (second - first).alias("width_ms"),
    )


def usage(df: DataFrame, bucket: str = "1 hour", column: str = "event_time", raw: str = "raw") -> DataFrame:
    """Events and bytes per time bucket."""
    grouped = df.groupBy(F.window(column, bucket).alias("w")).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.octet_length(raw).cast("bigint")).alias("volume"),
    )
    return grouped.select(F.col("w.start").alias("time"), "events", "volume")


def trailing(
    ticks: DataFrame, key: str, tick: str, value: str, n: int = HISTORY
) -> DataFrame:
    """The last ``n`` values of a group at each tick, oldest first.

    ``ticks`` holds one aggregated row per (group, tick).
    """
    w = Window.partitionBy(key).orderBy(tick).rowsBetween(1 - n, 0)
    return ticks.withColumn("history", F.collect_list(value).over(w))


def levels(history: Column | str) -> Column:
    """Scale a history to its own maximum: levels 0..7, all 0 when the maximum is 0."""
    values = F.col(history) if isinstance(history, str) else history
    top = F.greatest(F.array_max(values), F.lit(0))
    return F.transform(
        values,
        lambda x: F.when(top > 0, F.floor(x / top * (LEVELS - 1)).cast("int")).otherwise(F.lit(0)),
    )
