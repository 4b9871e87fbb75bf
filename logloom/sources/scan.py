"""Scans of event tables: dataset selection and time bounds."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Relative range units.
UNITS = {
    "s": timedelta(seconds=1),
    "m": timedelta(minutes=1),
    "h": timedelta(hours=1),
    "d": timedelta(days=1),
    "w": timedelta(weeks=1),
}
LONGEST = timedelta(microseconds=(2**63 - 1) // 1000)

_SINCE = re.compile(r"(?:[0-9]+[smhdw])+")
_RFC3339 = re.compile(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d+)?(?:Z|[+-]\d\d:\d\d)")


@dataclass(frozen=True)
class TimeRange:
    """Half-open ``[start, end)`` in UTC; None leaves that side open."""

    start: datetime | None = None
    end: datetime | None = None


def since(text: str) -> timedelta:
    """``15m`` or ``1h30m`` as a timedelta."""
    if not _SINCE.fullmatch(text):
        raise ValueError(f"cannot parse since={text!r}: use forms like 30s, 15m, 1h, 2d, 1w or 1h30m")
    total = timedelta()
    for number, unit in re.findall(r"([0-9]+)([smhdw])", text):
        if int(number) > LONGEST / UNITS[unit]:
            raise ValueError(f"since={text!r} is too large")
        total += int(number) * UNITS[unit]
    if total > LONGEST:
        raise ValueError(f"since={text!r} is too large")
    return total


def _instant(name: str, value: str | datetime) -> datetime:
    if isinstance(value, str):
        if not _RFC3339.fullmatch(value):
            raise ValueError(f"{name}={value!r} is not RFC 3339")
        value = datetime.fromisoformat(value)
    return value if value.tzinfo else value.replace(tzinfo=timezone.utc)


def time_range(
    last: str | None = None,
    frm: str | datetime | None = None,
    to: str | datetime | None = None,
    as_of: datetime | None = None,
) -> TimeRange:
    """Resolve a relative range (``last``) or absolute bounds, never both, against ``as_of``."""
    if last and (frm or to):
        raise ValueError("a relative range cannot be combined with absolute bounds")
    if to and not frm:
        raise ValueError("an end needs a start")
    now = _instant("as_of", as_of) if as_of else datetime.now(timezone.utc)
    if last:
        span = since(last)
        floor = datetime.min.replace(tzinfo=timezone.utc)
        return TimeRange(now - span if span <= now - floor else floor, now)
    if frm:
        return TimeRange(_instant("frm", frm), _instant("to", to) if to else now)
    return TimeRange()


def within(column: str, bounds: TimeRange, dtype: T.DataType | None = None) -> Column:
    """Range predicate that reaches the file scan (the column itself is not cast)."""
    plain = isinstance(dtype, T.TimestampNTZType)

    def literal(value: datetime) -> Column:
        text = value.astimezone(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
        return F.lit(text).cast("timestamp_ntz") if plain else F.lit(f"{text}+00:00").cast("timestamp")

    tests = [F.col(column) >= literal(bounds.start)] if bounds.start else []
    tests += [F.col(column) < literal(bounds.end)] if bounds.end else []
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def between(df: DataFrame, column: str = "event_time", **bounds) -> DataFrame:
    """Rows of ``df`` inside :func:`time_range` of the keyword arguments."""
    return df.filter(within(column, time_range(**bounds), df.schema[column].dataType))


def scan(
    spark: SparkSession,
    path: str,
    datasets: list[str] | None = None,
    selector: Column | None = None,
    column: str = "event_time",
    **bounds,
) -> DataFrame:
    """Scan a parquet event table.

    ``datasets`` are names or ``collection/name``; they and ``selector`` (a
    boolean Column over catalog columns) prune partitions when the table is
    laid out by ``collection`` and ``dataset``.
    """
    df = spark.read.parquet(path)
    if datasets is not None:
        df = df.filter(in_datasets(datasets))
    if selector is not None:
        df = df.filter(selector)
    return between(df, column, **bounds) if bounds else df


def in_datasets(names: list[str]) -> Column:
    bare = [n for n in names if "/" not in n]
    tests = [F.col("dataset").isin(bare)] if bare else []
    for name in names:
        if "/" in name:
            collection, dataset = name.split("/", 1)
            tests.append((F.col("collection") == collection) & (F.col("dataset") == dataset))
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def union_datasets(frames: list[DataFrame]) -> DataFrame:
    """Rows of several datasets with differing columns; an absent column reads as null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
