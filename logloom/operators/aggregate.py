"""Grouped, global and ranked aggregates over events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions.coerce import to_number
from logloom.functions.predicates import field
from logloom.functions.text import is_missing, label_missing


def count() -> Column:
    return F.count(F.lit(1))


def _numeric(df: DataFrame, name: str) -> Column:
    if name in df.columns and isinstance(df.schema[name].dataType, T.NumericType):
        return F.col(f"`{name}`")
    return to_number(F.col(f"`{name}`") if name in df.columns else field(name))


def avg(df: DataFrame, name: str) -> Column:
    return F.avg(_numeric(df, name))


def maximum(df: DataFrame, name: str) -> Column:
    return F.max(_numeric(df, name))


def minimum(df: DataFrame, name: str) -> Column:
    return F.min(_numeric(df, name))


def total(df: DataFrame, name: str) -> Column:
    return F.sum(_numeric(df, name))


def key_columns(df: DataFrame, keys: list[str]) -> list[Column]:
    return [(F.col(f"`{k}`") if k in df.columns else field(k)).alias(k) for k in keys]


def group(df: DataFrame, keys: list[str], aggs: dict[str, Column] | None = None) -> DataFrame:
    """All aggregates of one grouping in a single pass (partial sums before the shuffle)."""
    named = aggs or {"count": count()}
    columns = [c.alias(n) for n, c in named.items()]
    if not keys:
        return df.agg(*columns)
    return df.groupBy(*key_columns(df, keys)).agg(*columns)


def totals(df: DataFrame, aggs: dict[str, Column] | None = None) -> DataFrame:
    return group(df, [], aggs)


def top_groups(grouped: DataFrame, keys: list[str], k: int, by: str = "count") -> DataFrame:
    """Largest groups first, keys ascending on ties."""
    return grouped.orderBy(F.desc(by), *[F.asc(f"`{key}`") for key in keys]).limit(k)


def merged_aggs(df: DataFrame, keys: list[str], value: str, errors: Column | None = None) -> DataFrame:
    """``spans, avg_ns, max_ns`` (and ``errors``) of a BIGINT column per key.

    One conditional aggregation instead of three or four results joined on
    their keys; the mean is an exact integer division.
    """
    amount = F.col(value).cast("decimal(38,0)")
    grouped = df.groupBy(*key_columns(df, keys)).agg(
        F.count(F.lit(1)).alias("spans"),
        *([F.count_if(errors).alias("errors")] if errors is not None else []),
        F.sum(amount).alias("_sum"),
        F.count(F.col(value)).alias("_n"),
        F.coalesce(F.max(value), F.lit(0).cast("bigint")).alias("max_ns"),
    )
    mean = F.when(F.col("_n") > 0, F.expr("cast(_sum div _n as bigint)")).otherwise(F.lit(0))
    return grouped.select(
        *[F.col(f"`{k}`") for k in keys],
        "spans",
        *(["errors"] if errors is not None else []),
        mean.cast("bigint").alias("avg_ns"),
        "max_ns",
    )


def any_missing(keys: list[str]) -> Column:
    test = F.lit(False)
    for key in keys:
        test = test | is_missing(F.col(f"`{key}`"))
    return test


def missing(df: DataFrame, keys: list[str], include: bool = False) -> DataFrame:
    """Label missing group values when ``include``, else drop their rows."""
    if not include:
        df = df.filter(~any_missing(keys))
    for key in keys:
        df = df.withColumn(key, label_missing(F.col(f"`{key}`")))
    return df


def dropped_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many groups :func:`missing` drops."""
    return df.agg(F.count_if(any_missing(keys)).alias("dropped"))


def snapshot(
    df: DataFrame, aggs: dict[str, Column] | None = None, keys: list[str] = (), n: int = 50
) -> DataFrame:
    """One tick of a live aggregate: ``group`` (``total`` without keys) and the aggregates."""
    named = aggs or {"count": count()}
    grouped = group(df, list(keys), named)
    label = (
        F.concat_ws(", ", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys])
        if keys
        else F.lit("total")
    )
    first = next(iter(named))
    return (
        grouped.select(label.alias("group"), *named)
        .orderBy(F.desc(first), F.asc("group"))
        .limit(n)
    )
