"""Event tables whose fields are columns of the file without being named in advance.

The fields of an event are written as one VARIANT, which Spark shreds: keys that many events of a file share get
typed columns of their own, found from the data. A filter or projection on :func:`field` then asks the scan for that
key alone, typed, and no object is put together for a row; comparisons with text or a whole number reach the scan.

The reader of Spark 4.1 still fetches the bytes of all shredded columns of a VARIANT (measured: equal for one key and
for all). Where bytes matter, ``sinks.write_table`` with promoted keys reads less.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = "fields"
# Whole numbers whose text is the same after they were numbers.
_WHOLE = r"^(0|-?[1-9][0-9]{0,17})$"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of one write."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def as_variant(attrs: Column) -> Column:
    """The entries of a text map as a VARIANT object; whole numbers become numbers, so that they are stored as such."""

    def text(value: Column) -> Column:
        quoted = F.to_json(F.array(value))
        return F.substring(quoted, F.lit(2), F.length(quoted) - 2)

    def member(entry: Column) -> Column:
        value = entry["value"]
        shown = F.when(value.isNull(), "null").when(value.rlike(_WHOLE), value).otherwise(text(value))
        return F.concat(text(entry["key"]), F.lit(":"), shown)

    return F.parse_json(F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(attrs), member), ","), F.lit("}")))


def write_shredded(df: DataFrame, path: str) -> None:
    """Append parsed events as a parquet table by ``collection``, ``dataset`` and ``day``, fields shredded.

    Takes the place of ``attrs``; every other column stays. Within a file events are in time order. A null field
    is the same as an absent one.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c != "attrs"]
    wide = df.select(*rest, as_variant(F.col("attrs")).alias(FIELDS), F.to_date("event_time").alias("day"))
    parts = ["collection", "dataset", "day"]
    balanced = wide.hint("rebalance", *[F.col(c) for c in parts]).sortWithinPartitions(*parts, "event_time")
    shredding = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true"}
    with _settings(df.sparkSession, shredding):
        balanced.write.mode("append").partitionBy(*parts).parquet(path)


def field(name: str, kind: str = "string") -> Column:
    """A field as ``kind``, NULL if it is absent or cannot be that; text is what the event had.

    Use it in predicates, as in ``p.ge(field("http.status"), 500)``. Whole numbers can also be compared as
    ``bigint``, which the scan understands.
    """
    quote = '"' if '"' not in name else "'"
    if quote in name or "\\" in name:
        raise ValueError(f"no path names {name!r}")
    return F.try_variant_get(FIELDS, f"$[{quote}{name}{quote}]", kind)


def attrs() -> Column:
    """All fields as the text map that parsing gives."""
    return F.map_filter(F.try_variant_get(FIELDS, "$", "map<string,string>"), lambda _, v: v.isNotNull())
