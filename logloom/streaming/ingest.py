"""Streaming line ingest: text files in, normalised NDJSON out, exactly once."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from logloom.sources.ingest import MAX_BYTES, MAX_EVENTS, normalize_ingest
from logloom.sources.lines import trimmed


def read_line_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New text files under ``path`` as a stream of lines."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path, lineSep="\n")


def stream_ingest(
    lines: DataFrame,
    dst: str,
    as_of: datetime,
    dataset: str,
    collection: str = "default",
    max_events: int | None = None,
) -> DataStreamWriter:
    """Normalise lines and append them as gzip NDJSON.

    The checkpoint makes the sink exactly-once; the trigger takes the place of
    the count, byte and time flushes of a single sender. ``max_events`` cuts the
    files of a batch; leave it out for files worth reading at scale.
    """
    kept = lines.filter(trimmed(F.col("value")) != "")
    events = normalize_ingest(kept, as_of).select(
        F.col("event").alias("value"),
        F.lit(collection).alias("collection"),
        F.lit(dataset).alias("dataset"),
    )
    writer = (
        events.writeStream.format("text")
        .outputMode("append")
        .partitionBy("collection", "dataset")
        .option("compression", "gzip")
        .option("path", dst)
    )
    return writer.option("maxRecordsPerFile", max_events) if max_events else writer


# Fixed value: a partial batch waits this long at most.
FLUSH_MS = 1_000


class _Sender(StatefulProcessor):
    """Holds the open batch of one sender and hands it on when it is full, has waited too long, or the input ends."""

    def __init__(self, max_events: int, max_bytes: int, flush_ms: int | None):
        self.max_events, self.max_bytes, self.flush_ms = max_events, max_bytes, flush_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "event string")
        self.count = handle.getValueState("count", "batches bigint, bytes bigint")

    def _load(self) -> tuple[list[str], int, int]:
        number, size = self.count.get() if self.count.exists() else (0, 0)
        return [r[0] for r in self.waiting.get()] if self.waiting.exists() else [], number, size

    def _store(self, events: list[str], number: int, size: int) -> None:
        if events:
            self.waiting.put([(e,) for e in events])
        else:
            self.waiting.clear()
        self.count.update((number, size))

    def _batch(self, key, number: int, cause: str, events: list[str]) -> pd.DataFrame:
        return pd.DataFrame({"sender": [key[0]], "batch": [number], "cause": [cause], "events": [events]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events, number, size = self._load()
        waited, ended = bool(events), False
        for part in rows:
            for event, ends in zip(part["event"], part["ends"], strict=True):
                if ends:
                    ended = True
                    continue
                events.append(event)
                size += len(event.encode()) + 1
                if len(events) >= self.max_events or size >= self.max_bytes:
                    yield self._batch(key, number, "events" if len(events) >= self.max_events else "bytes", events)
                    events, number, size, waited = [], number + 1, 0, False
        if ended and events:
            yield self._batch(key, number, "end", events)
            events, number, size = [], number + 1, 0
        if self.flush_ms is not None and not (waited and events):  # the clock runs from the first event of the open batch
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            if events:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.flush_ms)
        self._store(events, number, size)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        events, number, _ = self._load()
        if events:
            self._store([], number + 1, 0)
            yield self._batch(key, number, "time", events)

    def close(self) -> None:
        pass


def stream_batches(
    events: DataFrame,
    event: str = "event",
    ends: Column | None = None,
    senders: int = 8,
    max_events: int = MAX_EVENTS,
    max_bytes: int = MAX_BYTES,
    flush_ms: int | None = FLUSH_MS,
) -> DataFrame:
    """Batches of a stream of events: ``sender, batch, cause, events``.

    Each of ``senders`` takes a hash share of the events and closes its batch with the event that makes it
    ``max_events`` long (cause ``events``) or brings it to ``max_bytes`` (``bytes``), ``flush_ms`` after its first
    event by the clock (``time``), or when a row for which ``ends`` holds says that the input is over (``end``); such
    a row reaches every sender and is no event. Batches of a sender are numbered from 0; with the checkpoint each is
    made once. State is one open batch per sender, and a row's events fit in memory by the limits. With a time limit
    the query is followed (``tail.follow``); a catch-up run takes ``flush_ms=None``, and leaves an open batch for
    the next run unless an end row closes it. Needs the RocksDB state store.
    """
    over = F.lit(False) if ends is None else F.coalesce(ends, F.lit(False))
    everyone = F.sequence(F.lit(0), F.lit(senders - 1))
    own = F.array(F.pmod(F.xxhash64(event), F.lit(senders)).cast("int"))
    rows = events.select(F.explode(F.when(over, everyone).otherwise(own)).alias("sender"), F.col(event).alias("event"), over.alias("ends"))
    return rows.groupBy("sender").transformWithStateInPandas(
        _Sender(max_events, max_bytes, flush_ms),
        "sender int, batch bigint, cause string, events array<string>",
        "Append",
        "None" if flush_ms is None else "ProcessingTime",
    )
