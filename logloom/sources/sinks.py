"""Sinks: validated NDJSON, export, JSON lines, CSV and raw text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions.predicates import field
from logloom.operators.columns import as_row_json

_TAG = re.compile(r"[^=]+=.*", re.S)


def split_valid(df: DataFrame, message: str = "message") -> tuple[DataFrame, DataFrame]:
    """Events with a non-empty message, and the rejects."""
    ok = F.coalesce(F.col(message) != "", F.lit(False))
    return df.filter(ok), df.filter(~ok)


def write_events(
    df: DataFrame,
    path: str,
    dataset: str,
    collection: str = "",
    tags: dict[str, str] | list[str] | None = None,
    max_events: int | None = None,
    event: str = "event",
) -> None:
    """Append events as gzip NDJSON under ``collection=/dataset=[/tags=]``.

    Fails before writing if any event lacks a message, as a rejected batch
    would; use :func:`split_valid` first to keep the rejects.
    """
    pairs = tags.items() if isinstance(tags, dict) else []
    listed = [f"{k}={v}" for k, v in pairs] if isinstance(tags, dict) else list(tags or [])
    for tag in listed:
        if not _TAG.fullmatch(tag):
            raise ValueError(f"tag {tag!r} is not key=value")
    checked = df.withColumn(
        "value",
        F.when(F.coalesce(F.col("message") != "", F.lit(False)), F.col(event)).otherwise(
            F.raise_error(F.lit('every event needs a non-empty "message" field'))
        ),
    )
    out = checked.select(
        "value",
        F.lit(collection or "default").alias("collection"),
        F.lit(dataset).alias("dataset"),
        *([F.lit(",".join(listed)).alias("tags")] if listed else []),
    )
    writer = out.write.mode("append").option("compression", "gzip")
    if max_events:
        writer = writer.option("maxRecordsPerFile", max_events)
    writer.partitionBy(*[c for c in out.columns if c != "value"]).text(path)


def write_table(df: DataFrame, path: str, promote: list[str] = ()) -> None:
    """Append parsed events as the parquet table that scans prune.

    Partitioned by ``collection``, ``dataset`` and ``day``, in time order inside
    a file. ``promote`` turns often-filtered fields into columns of their own
    (use them in predicates as ``F.col("`http.status`")``): unlike map entries
    they are read and skipped column by column. The rebalance splits a large
    dataset over many writers and merges small ones.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    wide = df.select(
        *columns, *[field(n).alias(n) for n in promote], F.to_date("event_time").alias("day")
    )
    parts = ["collection", "dataset", "day"]
    balanced = wide.hint("rebalance", *[F.col(c) for c in parts])
    balanced.sortWithinPartitions(*parts, "event_time").write.mode("append").partitionBy(*parts).parquet(path)


def export(df: DataFrame, path: str, where: Column | None = None, compression: str = "gzip") -> None:
    """Matching events as a compressed JSON-lines file set."""
    kept = df if where is None else df.filter(where)
    to_jsonl(kept, path, compression=compression)


def to_jsonl(
    df: DataFrame, path: str, fields: list[str] | None = None, compression: str = "none"
) -> None:
    """One JSON object per row; absent keys are left out, not written as null."""
    df.select(as_row_json(df, fields).alias("value")).write.mode("overwrite").option(
        "compression", compression
    ).text(path)


def csv_cell(column: Column, dtype: T.DataType) -> Column:
    """Text of a cell: absent -> empty, integral doubles without exponent, nested -> JSON."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        whole = (column == F.floor(column)) & (F.abs(column) < 1e15)
        text = F.when(whole, column.cast("bigint").cast("string")).otherwise(column.cast("string"))
    elif isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        text = F.to_json(column)
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(""))


def csv_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The chosen columns as CSV cell text; names that are no column read ``attrs``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = []
    for name in columns:
        if name in types:
            cell = csv_cell(F.col(f"`{name}`"), types[name])
        else:
            cell = F.coalesce(field(name), F.lit(""))
        cells.append(cell.alias(name))
    return df.select(*cells)


def to_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    csv_rows(df, columns).write.mode("overwrite").options(
        header="true", emptyValue="", nullValue="", escape='"'
    ).csv(path)


def raw_lines(df: DataFrame) -> DataFrame:
    """``raw`` of an event, else the whole row as JSON."""
    whole = as_row_json(df)
    line = F.coalesce(F.col("raw"), whole) if "raw" in df.columns else whole
    return df.select(line.alias("value"))


def to_raw(df: DataFrame, path: str) -> None:
    raw_lines(df).write.mode("overwrite").text(path)
