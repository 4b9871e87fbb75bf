"""Live tail: de-duplication, filters, per-batch order and catch-up runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from logloom.functions.predicates import field_rules, line_rules
from logloom.functions.text import severity_class
from logloom.operators.events import chronological

# Default poll interval and trailing window.
INTERVAL = "3 seconds"
WINDOW = "30 seconds"
# Fixed value: keys remembered by the bounded de-duplication.
CAPACITY = 20_000


def dedup_key(df: DataFrame) -> Column:
    """The sequence number, else time and raw line."""
    fallback = F.concat_ws("|", F.col("event_time").cast("string"), F.coalesce("raw", F.lit("")))
    if "sequence" not in df.columns:
        return fallback
    return F.coalesce(F.col("sequence").cast("string"), fallback)


def dedup(stream: DataFrame, ttl: str = WINDOW) -> DataFrame:
    """Drop repeats of an event seen within ``ttl``; keys older than that leave the state.

    Events later than ``ttl`` are dropped, as a trailing window would miss them.
    """
    keyed = stream.withColumn("_key", dedup_key(stream)).withWatermark("event_time", ttl)
    return keyed.dropDuplicatesWithinWatermark(["_key"]).drop("_key")


class _Remembered(StatefulProcessor):
    """The keys of one bucket in the order they came, the oldest half forgotten when there is no room."""

    def __init__(self, capacity: int, columns: list[str]):
        self.capacity, self.columns = capacity, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("keys", "keys array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        order = list(self.held.get()[0]) if self.held.exists() else []
        seen = set(order)
        for part in rows:
            fresh = []
            for own in part["dedup_key"]:
                fresh.append(own not in seen)
                if not fresh[-1]:
                    continue
                if len(order) >= self.capacity:
                    half = len(order) // 2
                    seen.difference_update(order[:half])
                    order = order[half:]
                seen.add(own)
                order.append(own)
            yield part.loc[fresh, self.columns]
        self.held.update((order,))

    def close(self) -> None:
        pass


def dedup_bounded(stream: DataFrame, capacity: int = CAPACITY, buckets: int = 16) -> DataFrame:
    """Drop repeats of the last events seen, however late they are: about ``capacity`` keys are remembered.

    Keys are dealt to ``buckets`` by a hash. A bucket remembers ``capacity / buckets`` of them, and when it is full
    forgets the older half, so memory is bounded whatever the stream does, and an event may come again after at
    least ``capacity / buckets / 2`` other new ones of its bucket. Events of a micro-batch count in the order they
    come. Needs the RocksDB state store.
    """
    room = capacity // buckets
    if room < 2:
        raise ValueError("a bucket remembers at least two keys")
    keyed = stream.withColumn("dedup_key", dedup_key(stream))
    bucket = F.pmod(F.xxhash64("dedup_key"), F.lit(buckets)).cast("int")
    columns = stream.columns
    return keyed.withColumn("bucket", bucket).groupBy("bucket").transformWithStateInPandas(
        _Remembered(room, columns), stream.schema, "Append", "None"
    )


def live_filter(
    stream: DataFrame,
    include: list[str] = (),
    exclude: list[str] = (),
    include_fields: list[tuple[str, str]] = (),
    exclude_fields: list[tuple[str, str]] = (),
) -> DataFrame:
    """Line and field rules, plus ``severity`` of the status; no state."""
    kept = stream.filter(line_rules(include, exclude))
    if include_fields or exclude_fields:
        kept = kept.filter(field_rules(include_fields, exclude_fields))
    if "status" in stream.columns:
        kept = kept.withColumn("severity", severity_class("status"))
    return kept


def tail(stream: DataFrame, window: str = WINDOW, **rules) -> DataFrame:
    """De-duplicated, filtered live events."""
    return live_filter(dedup(stream, window), **rules)


def ordered_batches(
    stream: DataFrame, sink: Callable[[DataFrame, int], None]
) -> DataStreamWriter:
    """Hand every micro-batch to ``sink`` in time order; batches are not reordered among themselves."""
    return stream.writeStream.foreachBatch(lambda batch, epoch: sink(chronological(batch), epoch))


def follow(writer: DataStreamWriter, checkpoint: str, interval: str = INTERVAL) -> StreamingQuery:
    """Start a continuous run."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def catch_up(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process everything available, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
