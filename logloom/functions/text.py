"""Scalar text functions: labels, short forms, secret masking, time parsing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from logloom.functions.coerce import as_column, to_number

# Spellings of "no value" in grouped results.
MISSING = ("", "null", "None")
MISSING_LABEL = "<missing>"

# Severity spellings.
SEVERITIES = {
    "error": ("error", "fatal", "critical", "err"),
    "warn": ("warn", "warning"),
    "debug": ("debug", "trace"),
}


def _duration_label(ns: int) -> str:
    if ns <= 0:
        return "—"
    ms = ns / 1e6
    if ms < 1:
        return "%.1fµs" % (ns / 1e3)
    if ms < 1000:
        return "%.2fms" % ms
    return "%.2fs" % (ms / 1000)


@F.pandas_udf(StringType())
def format_duration_ns(ns: pd.Series) -> pd.Series:
    """Human label of a nanosecond count.

    A display helper: Spark's own ``format_string`` rounds the decimal text
    half-up, labels round the binary value. Compare the ns column, not this.
    """
    return ns.map(lambda v: None if pd.isna(v) else _duration_label(int(v)))


def severity_class(value: Column | str) -> Column:
    word = F.lower(as_column(value))
    out = F.lit("other")
    for name, spellings in reversed(list(SEVERITIES.items())):
        out = F.when(word.isin(*spellings), F.lit(name)).otherwise(out)
    return out


def kind_short(value: Column | str) -> Column:
    return F.regexp_replace(as_column(value), "^SPAN_KIND_", "")


def status_short(value: Column | str) -> Column:
    return F.regexp_replace(as_column(value), "^STATUS_CODE_", "")


def is_error(value: Column | str) -> Column:
    """Status ends in ERROR, in any case (the loose of the two error tests)."""
    return F.coalesce(F.endswith(F.upper(as_column(value)), F.lit("ERROR")), F.lit(False))


def mask_secret(value: Column | str) -> Column:
    """First 8 characters and an ellipsis; shorter than 12 shows the ellipsis only."""
    text = as_column(value)
    return (
        F.when(text == "", text)
        .when(F.char_length(text) < 12, F.lit("…"))
        .when(text.isNotNull(), F.concat(F.substring(text, 1, 8), F.lit("…")))
    )


def is_missing(value: Column | str) -> Column:
    text = as_column(value)
    return text.isNull() | text.isin(*MISSING)


def label_missing(value: Column | str) -> Column:
    text = as_column(value)
    return F.when(is_missing(text), F.lit(MISSING_LABEL)).otherwise(text)


def bucket_time(value: Column | str) -> Column:
    """``Fri Jul 10 18:53:00 UTC 2026`` -> ``2026-07-10 18:53``; anything else passes through.

    The weekday and the zone name are read but carry no information.
    """
    text = as_column(value)
    shape = r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun) ([A-Z][a-z]{2}) +(\d{1,2} \d{2}:\d{2}:\d{2}) [A-Z]{3,4} (\d{4})$"
    compact = F.regexp_replace(text, shape, "$1 $2 $3")
    parsed = F.try_to_timestamp(compact, F.lit("MMM d HH:mm:ss yyyy"))
    label = F.date_format(parsed, "yyyy-MM-dd HH:mm")
    return F.when(text.rlike(shape), F.coalesce(label, text)).otherwise(text)


def event_time_ms(value: Column | str) -> Column:
    """Epoch milliseconds of a number, ``yyyy-MM-dd HH:mm:ss.SSS UTC`` or RFC 3339 text."""
    text = as_column(value).cast("string")
    spaced = F.try_to_timestamp(
        F.regexp_extract(text, r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{3}) UTC$", 1),
        F.lit("yyyy-MM-dd HH:mm:ss.SSS"),
    )
    rfc = F.when(
        text.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d([.]\d+)?(Z|[+-]\d\d:\d\d)$"),
        text.try_cast("timestamp"),
    )
    # the spaced form carries no zone of its own for the parser: read it as UTC
    utc = F.to_utc_timestamp(spaced, F.current_timezone())
    return F.coalesce(
        to_number(text).try_cast("bigint"), F.unix_millis(utc), F.unix_millis(rfc)
    )
