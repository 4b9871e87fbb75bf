"""Ingest: lines -> events with ``message`` and ``timestamp``, checked and written as NDJSON."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.batching import greedy_batches
from logloom.sources.lines import STRICT, last_wins, trimmed, with_once

# Default batch caps.
MAX_EVENTS = 500
MAX_BYTES = 1 << 20

def _whole_object(line: Column) -> Column:
    """The line as VARIANT when it is one JSON object and nothing else, else NULL.

    The parsers stop after the first value, so the line is read as the first of
    two array elements: text after the object would displace the second, its hash.
    """
    seal = F.xxhash64(line).cast("string")
    pair = F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), line, F.lit(","), seal, F.lit("]"))), "$", "array<variant>"
    )
    alone = (F.size(pair) == 2) & (F.try_element_at(pair, F.lit(2)).try_cast("string") == seal)
    # a repeated key has no variant form: the last value counts
    maps = F.from_json(
        F.concat(F.lit("["), line, F.lit(',{"seal":'), seal, F.lit("}]")), "array<map<string,variant>>", STRICT
    )
    sealed = F.try_element_at(F.try_element_at(maps, F.lit(2)), F.lit("seal")).try_cast("string")
    repeats = F.to_variant_object(last_wins(F.map_entries(F.try_element_at(maps, F.lit(1)))))
    return F.when(
        line.rlike(r"^[ \t]*\{"),
        F.when(alone, F.try_element_at(pair, F.lit(1))).when(
            pair.isNull() & (F.size(maps) == 2) & (sealed == seal), repeats
        ),
    )


def normalize_ingest(df: DataFrame, as_of: datetime, line: str = "value") -> DataFrame:
    """One event per line: ``message``, ``timestamp`` and ``event`` (the JSON to send).

    An object keeps its fields; ``timestamp`` is added when the key is absent
    and ``message`` is the raw line when absent, empty or not a string. Any
    other line becomes ``{message, timestamp}``.
    """
    stamp = as_of.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    raw = F.col(f"`{line}`")
    staged = with_once(df, "_object", _whole_object(raw))
    obj = F.col("_object")
    own_message = F.try_variant_get(obj, "$.message", "variant")
    own_stamp = F.try_variant_get(obj, "$.timestamp", "variant")
    text = F.when(F.schema_of_variant(own_message) == "STRING", own_message.cast("string"))
    message = F.when(text != "", text).otherwise(raw)
    timestamp = F.when(own_stamp.isNull(), F.lit(stamp)).otherwise(own_stamp.cast("string"))
    fields = F.try_variant_get(obj, "$", "map<string,variant>")
    others = F.map_filter(fields, lambda k, _: ~k.isin("message", "timestamp"))
    # rebuild as one flat map of variants so that the kept fields stay typed
    as_variant = lambda c: F.try_variant_get(F.to_variant_object(F.struct(c.alias("v"))), "$.v", "variant")
    added = F.create_map(
        F.lit("message"), as_variant(message),
        F.lit("timestamp"), F.coalesce(own_stamp, as_variant(F.lit(stamp))),
    )
    event = F.to_json(
        F.map_concat(F.coalesce(others, F.create_map().cast("map<string,variant>")), added)
    )
    return staged.select(
        *[F.col(f"`{c}`") for c in df.columns],
        message.alias("message"),
        timestamp.alias("timestamp"),
        event.alias("event"),
    )


def ingest_plan(df: DataFrame, line: str = "value") -> DataFrame:
    """Number of events and bytes an ingest of ``df`` would send."""
    text = trimmed(F.col(f"`{line}`"))
    kept = df.select(text.alias("t")).filter("t <> ''")
    return kept.agg(
        F.count(F.lit(1)).alias("events"),
        F.coalesce(F.sum(F.octet_length("t").cast("bigint")), F.lit(0).cast("bigint")).alias("bytes"),
    )


def ingest_batches(
    df: DataFrame,
    order: list[str],
    event: str = "event",
    max_events: int = MAX_EVENTS,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """Add ``batch``: the number of the batch a single sender would put the event in.

    Batches follow ``order``; one closes with the event that makes it ``max_events`` long or brings
    its bytes (a newline per event) to ``max_bytes``, and both counts then start anew. ``order``
    must be a total order for a repeatable result. Null events count as empty.
    """
    size = F.coalesce(F.octet_length(F.col(f"`{event}`")), F.lit(0)) + 1
    return greedy_batches(df, order, size, max_events, max_bytes)
