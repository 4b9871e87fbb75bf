"""Live aggregates, histograms, trends and monitors on a stream."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from logloom.operators.aggregate import count, key_columns
from logloom.operators.lint import Monitor, monitor_history
from logloom.operators.series import HISTORY
from logloom.sources.scan import since
from logloom.streaming.poll import micros

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def live_aggregate(
    stream: DataFrame,
    window: str,
    interval: str,
    keys: list[str] = (),
    aggs: dict[str, Column] | None = None,
    watermark: str | None = None,
    offset: str | None = None,
) -> DataFrame:
    """Aggregates over a trailing ``window``, re-evaluated every ``interval``.

    ``watermark`` bounds the state and drops later events; without it nothing
    is dropped and the state holds every window (for catch-up runs). Windows start
    at ``offset`` after the epoch's multiples of ``interval``.
    """
    source = stream if watermark is None else stream.withWatermark("event_time", watermark)
    named = aggs or {"count": count()}
    grouped = source.groupBy(
        F.window("event_time", window, interval, offset).alias("w"), *key_columns(stream, list(keys))
    ).agg(*[c.alias(n) for n, c in named.items()])
    return grouped.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *[F.col(f"`{k}`") for k in keys],
        *named,
    )


def live_histogram(stream: DataFrame, width: str, watermark: str | None = None) -> DataFrame:
    """Counts per tumbling window."""
    return live_aggregate(stream, width, width, watermark=watermark)


def live_monitor(
    stream: DataFrame, monitor: Monitor, every: str, watermark: str | None = None
) -> DataFrame:
    """The monitor re-evaluated over its trailing window every ``every``."""
    source = stream if watermark is None else stream.withWatermark("event_time", watermark)
    return monitor_history(source, monitor, every)


class _Trend(StatefulProcessor):
    """Keeps the last values of a group and emits them with every tick."""

    def __init__(self, n: int, ttl_ms: int | None):
        self.n, self.ttl_ms = n, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.history = handle.getValueState("history", "values array<double>", self.ttl_ms)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.history.update(([float(v) for v in initialState["history"].iloc[0]][-self.n :],))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ticks = pd.concat(list(rows)).sort_values("tick")
        kept = list(self.history.get()[0]) if self.history.exists() else []
        out = []
        for tick, value in zip(ticks["tick"], ticks["value"], strict=True):
            kept = (kept + [float(value)])[-self.n :]
            out.append((key[0], tick, float(value), list(kept)))
        self.history.update((kept,))
        yield pd.DataFrame(out, columns=["group", "tick", "value", "history"])

    def close(self) -> None:
        pass


def live_trend(
    stream: DataFrame,
    key: str,
    tick: str,
    value: str,
    n: int = HISTORY,
    ttl: str | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Last ``n`` values of every group at each tick (``group, tick, value, history``).

    ``stream`` carries one aggregated row per (group, tick), such as a watermarked :func:`live_aggregate`, so a batch
    holds a handful of rows per group. A group without ticks for ``ttl`` (such as ``2h``, by the clock) leaves the
    state and starts anew later; such a query is followed, as a catch-up run would wait for the clock. ``before`` (``group, history``: one row per group, oldest value first) is what the
    groups bring along when the query first starts. Needs the RocksDB state store (:func:`use_rocksdb`).
    """
    ticks = stream.select(
        F.col(key).cast("string").alias("group"),
        F.col(tick).alias("tick"),
        F.col(value).cast("double").alias("value"),
    )
    tick_type = ticks.schema["tick"].dataType.simpleString()
    lasting = int(since(ttl).total_seconds() * 1000) if ttl else None
    return ticks.groupBy("group").transformWithStateInPandas(
        _Trend(n, lasting),
        f"group string, tick {tick_type}, value double, history array<double>",
        "Append",
        "ProcessingTime" if ttl else "None",
        None if before is None else before.select(F.col("group").cast("string"), "history").groupBy("group"),
    )


class _Dense(StatefulProcessor):
    """Fills the slices between counts with zeros; what lies before the watermark is final."""

    def __init__(self, start: int, width: int):
        self.start, self.width = start, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.following = handle.getValueState("following", "slice bigint")

    def _next(self) -> int:
        return self.following.get()[0] if self.following.exists() else 0

    def _rows(self, counts: list[tuple[int, int]]) -> pd.DataFrame:
        first = [pd.Timestamp(self.start + s * self.width, unit="us", tz="UTC") for s, _ in counts]
        width = pd.Timedelta(self.width, unit="us")
        return pd.DataFrame({"window_start": first, "window_end": [f + width for f in first], "count": [c for _, c in counts]})

    def _upto(self, end: int) -> Iterator[pd.DataFrame]:
        """Zeros from the next slice to the one before ``end``."""
        at = self._next()
        for low in range(at, end, 10_000):
            yield self._rows([(s, 0) for s in range(low, min(end, low + 10_000))])

    def _go_on(self, following: int) -> None:
        self.following.update((following,))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(-(-(self.start + (following + 1) * self.width) // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        counted = pd.concat(list(rows)).sort_values("slice")
        for number, n in zip(counted["slice"], counted["n"], strict=True):
            if number >= 0:
                yield from self._upto(int(number))
                yield self._rows([(int(number), int(n))])
                self.following.update((int(number) + 1,))
        self._go_on(self._next())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = (timerValues.getCurrentWatermarkInMs() * 1000 - self.start) // self.width
        yield from self._upto(end)
        self._go_on(max(end, self._next()))

    def close(self) -> None:
        pass


def live_dense_histogram(stream: DataFrame, width: str, start: datetime, watermark: str) -> DataFrame:
    """Counts of every slice of ``width`` from ``start`` on, zeros included, as the watermark passes its end.

    Each slice comes once and in order. Events before ``start`` are left out; events later than the watermark are
    dropped, and their number stands in the progress of the query (:func:`late_rows`). Two operators in a row: counts
    per slice, and one small state that knows the next slice and has a timer at its end.
    """
    low, span = micros(start), int(since(width).total_seconds() * 1_000_000)
    counts = live_aggregate(
        stream.filter(F.unix_micros("event_time") >= low), f"{span} microseconds", f"{span} microseconds",
        watermark=watermark, offset=f"{low % span} microseconds",
    )
    number = F.expr(f"(unix_micros(window_start) - {low}) div {span}")
    slices = counts.select(F.lit(0).alias("all"), number.alias("slice"), F.col("count").alias("n"))
    return slices.groupBy("all").transformWithStateInPandas(
        _Dense(low, span), "window_start timestamp, window_end timestamp, count bigint", "Append", "EventTime"
    )


class _Top(StatefulProcessor):
    """The first groups of a window, all of whose groups come in one batch; nothing stays in the state."""

    def __init__(self, n: int, by: str, columns: list[str]):
        self.n, self.by, self.columns = n, by, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for part in rows:
            both = part if best is None else pd.concat([best, part])
            best = both.sort_values([self.by, "group"], ascending=[False, True]).head(self.n)
        yield best[self.columns]

    def close(self) -> None:
        pass


def live_top_groups(
    stream: DataFrame,
    window: str,
    interval: str,
    keys: list[str],
    watermark: str,
    aggs: dict[str, Column] | None = None,
    n: int = 50,
    parts: int = 16,
) -> DataFrame:
    """The ``n`` largest groups (by the first aggregate, then by name) of every trailing window, when it is over.

    ``window_start, window_end, group`` and the aggregates. A window is ranked once, as the watermark passes its end:
    first among ``parts`` shares of its groups, then among their winners, so no task holds all groups of a window.
    State holds open windows only; events later than the watermark are dropped and counted (:func:`late_rows`).
    """
    named = aggs or {"count": count()}
    first = next(iter(named))
    closed = live_aggregate(stream, window, interval, keys, named, watermark)
    label = F.concat_ws(", ", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys]) if keys else F.lit("total")
    rows = closed.select("window_start", "window_end", label.alias("group"), *named)
    columns, schema = rows.columns, rows.schema
    shared = rows.withColumn("part", F.pmod(F.xxhash64("group"), F.lit(parts)).cast("int"))
    ranked = shared.groupBy("window_start", "part").transformWithStateInPandas(_Top(n, first, columns), schema, "Append", "None")
    return ranked.groupBy("window_start").transformWithStateInPandas(_Top(n, first, columns), schema, "Append", "None")


def late_rows(query: StreamingQuery) -> int:
    """Rows later than the watermark that reached a state, as far back as the query remembers its progress.

    An aggregate puts rows of a group and window together before that, within each task.
    """
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def upsert_files(stream: DataFrame, path: str) -> DataStreamWriter:
    """Write the changed rows of each micro-batch under ``epoch=N`` (a re-run replaces its own)."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return stream.writeStream.outputMode("update").foreachBatch(write)


def latest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest version of every row written by :func:`upsert_files`."""
    versions = spark.read.parquet(path)
    rest = [c for c in versions.columns if c not in (*keys, "epoch")]
    newest = versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("_v"))
    return newest.select(*keys, "_v.*")
