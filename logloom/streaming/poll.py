"""A polling tail: a stream that reads the trailing window of an event table again at every poll.

A table that others append to, with events that come late, is followed by reading ``[end - window, end)`` over and
over; what comes twice is for :mod:`logloom.streaming.tail` to drop. Offsets are event times, so a restarted query
goes on where its checkpoint stands. The row limit of a poll slows the tail down and loses nothing: a poll ends
early, and the next one starts there.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from logloom.sources.scan import since

# Default poll interval, its minimum, trailing window and rows of a poll.
INTERVAL = "3s"
LEAST_INTERVAL = 1_000_000
WINDOW = "30s"
LIMIT = 500

POLL = "poll_end"


def micros(value: datetime) -> int:
    aware = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    return int(aware.timestamp()) * 1_000_000 + aware.microsecond


def _stamp(value: int, kind: pa.DataType) -> pa.Scalar:
    return pa.scalar(value, pa.timestamp("us", tz=kind.tz)).cast(kind)


@dataclass
class _Part(InputPartition):
    file: str
    schema: bytes
    low: int
    high: int


def _in_micros(column: pa.Array) -> pa.Array:
    kind = column.type
    return column.cast(pa.timestamp("us", tz=kind.tz)) if pa.types.is_timestamp(kind) and kind.unit != "us" else column


def _micro_schema(schema: pa.Schema) -> pa.Schema:
    fields = [f.with_type(_in_micros(pa.array([], f.type)).type) for f in schema]
    return pa.schema([*fields, pa.field(POLL, pa.timestamp("us", tz="UTC"))])


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.column = options["path"], options["column"]
        self.interval, self.window = int(options["interval"]), int(options["window"])
        self.limit, self.start = int(options["limit"]), int(options["start"])
        self.until = int(options["until"]) if options.get("until") else None
        self.positions = options["positions"]
        self.at: int | None = None

    def _table(self) -> ds.Dataset:
        return ds.dataset(self.path, format="parquet", partitioning="hive")

    def _within(self, table: ds.Dataset, low: int, high: int) -> ds.Expression:
        kind, time_column = table.schema.field(self.column).type, ds.field(self.column)
        return (time_column >= _stamp(low, kind)) & (time_column < _stamp(high, kind))

    def initialOffset(self) -> dict:
        return {"upto": self.start}

    def latestOffset(self) -> dict:
        """One interval on, not past the clock, and not past the rows of one poll."""
        at = self.at if self.at is not None else self._remembered()
        clock = self.until if self.until is not None else time.time_ns() // 1000
        if self.until is not None:  # a replay goes on by intervals
            end = min(at + self.interval, clock)
        else:
            end = max(at, clock - clock % self.interval)
        return {"upto": self._limited(at, end)}

    def _limited(self, at: int, end: int) -> int:
        """The largest end so that no more than the limit of new rows lie before it, but one instant at least."""
        if end <= at:
            return at
        table = self._table()
        first: list[int] = []
        for batch in table.to_batches(columns=[self.column], filter=self._within(table, at, end)):
            first += _in_micros(batch.column(0)).cast(pa.int64()).to_pylist()
            if len(first) > 8 * (self.limit + 1):
                first = sorted(first)[: self.limit + 1]
        first.sort()
        if len(first) <= self.limit:
            return end
        # the instant that would be cut in two goes to the next poll, unless it is all of this one
        return first[self.limit] if first[self.limit] > first[0] else first[0] + 1

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = end["upto"]
        self._remember()
        if start["upto"] >= end["upto"]:
            return []
        low = min(start["upto"], end["upto"] - self.window)
        table = self._table()
        inside = self._within(table, low, end["upto"])
        schema = table.schema.serialize().to_pybytes()
        return [_Part(f.path, schema, low, end["upto"]) for f in table.get_fragments(filter=inside)]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        schema = pa.ipc.read_schema(pa.py_buffer(partition.schema))
        where = fs.FileSystem.from_uri(self.path)[0]
        table = ds.dataset(partition.file, schema=schema, format="parquet", filesystem=where, partitioning="hive")
        for batch in table.to_batches(filter=self._within(table, partition.low, partition.high)):
            if batch.num_rows:
                end = pa.array([partition.high] * batch.num_rows, pa.timestamp("us", tz="UTC"))
                yield pa.RecordBatch.from_arrays([*map(_in_micros, batch.columns), end], schema=_micro_schema(schema))

    # The planned position is kept beside the checkpoint: a restarted query asks for its end before it tells its start.
    def _remembered(self) -> int:
        where, folder = fs.FileSystem.from_uri(self.positions)
        if where.get_file_info(f"{folder}/upto").type != fs.FileType.File:
            return self.start
        with where.open_input_stream(f"{folder}/upto") as file:
            return int(file.read())

    def _remember(self) -> None:
        where, folder = fs.FileSystem.from_uri(self.positions)
        where.create_dir(folder, recursive=True)
        with where.open_output_stream(f"{folder}/upto.new") as file:
            file.write(str(self.at).encode())
        where.move(f"{folder}/upto.new", f"{folder}/upto")


class TailSource(DataSource):
    """Format ``tail``; see :func:`poll`."""

    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> StructType:
        table = ds.dataset(self.options["path"], format="parquet", partitioning="hive")
        return from_arrow_schema(_micro_schema(table.schema))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Reader(dict(self.options))


def poll(
    spark: SparkSession,
    path: str,
    start: datetime,
    positions: str,
    until: datetime | None = None,
    column: str = "event_time",
    interval: str = INTERVAL,
    window: str = WINDOW,
    limit: int = LIMIT,
) -> DataFrame:
    """The table's rows, and ``poll_end``, as polls from ``start`` on see them.

    ``path`` is a parquet folder (hive partitions are columns) that the driver and every executor can reach. Each
    poll reads what lies in ``[end - window, end)`` by ``column``, or back to the end of the poll before where that
    is earlier. Ends follow the clock in steps of ``interval``, which is a second at least; up to ``until``, if
    given, the past is replayed interval by interval. A poll takes up to ``limit`` rows that are new by their time
    (more only if one instant has more). ``positions`` is a folder of the query's own, kept with its checkpoint.
    """
    step, width = int(since(interval).total_seconds() * 1e6), int(since(window).total_seconds() * 1e6)
    if step < LEAST_INTERVAL:
        raise ValueError("the interval is a second at least")
    if limit < 1:
        raise ValueError("a poll takes at least one row")
    spark.dataSource.register(TailSource)
    options = {
        "path": path, "column": column, "positions": positions, "start": str(micros(start)),
        "interval": str(step), "window": str(width), "limit": str(limit),
    }
    if until is not None:
        options["until"] = str(micros(until))
    return spark.readStream.format("tail").options(**options).load()
