"""Field discovery: profiles, value samples, name resolution and coverage checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.functions.coerce import to_number
from logloom.functions.predicates import name_contains
from logloom.operators.columns import field_entries
from logloom.operators.names import candidates, nearest

# Fixed value: how many values a profile shows of one field.
SAMPLE = 20


def normal_name(name: Column | str) -> Column:
    """Lower case without the leading ``$``."""
    text = F.col(name) if isinstance(name, str) else name
    return F.lower(F.regexp_replace(text, r"^\$", ""))


def _value_counts(df: DataFrame) -> DataFrame:
    pairs = field_entries(df).filter("value is not null")
    return pairs.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))


def _smallest_values(counts: DataFrame, cap: int) -> DataFrame:
    """``key`` and its ``cap`` smallest values as a sorted array."""
    place = F.row_number().over(Window.partitionBy("key").orderBy("value"))
    # the filter on the row number also cuts each partition before the shuffle
    few = counts.withColumn("_place", place).filter(F.col("_place") <= cap)
    # all columns stay in use, so that a profile reads one shuffled table of counts
    rows = F.array_sort(F.collect_list(F.struct("value", *[c for c in counts.columns if c not in ("key", "value")])))
    return few.groupBy("key").agg(F.transform(rows, lambda r: r["value"]).alias("values"))


def value_sample(df: DataFrame, cap: int = SAMPLE) -> DataFrame:
    """Sorted sample of the distinct values of every field: the ``cap`` smallest."""
    return _smallest_values(field_entries(df).filter("value is not null").distinct(), cap)


def field_profile(
    df: DataFrame, name: str | None = None, n: int = 0, cap: int = SAMPLE
) -> DataFrame:
    """``key, count, type, source, values`` per field, most frequent first.

    ``type`` is what every value of the field coerces to (number, boolean, else
    string); ``source`` tells ``$`` attributes from fields parsed out of the
    message. ``name`` keeps fields containing it, ``n`` keeps the first few.
    """
    if name is not None:
        wanted = F.map_filter("attrs", lambda k, _: name_contains(k, name))
        df = df.withColumn("attrs", wanted)
    counts = _value_counts(df)
    value = F.col("value")
    summary = counts.groupBy("key").agg(
        F.sum("n").alias("count"),
        F.bool_and(to_number(value).isNotNull()).alias("_number"),
        F.bool_and(value.isin("true", "false")).alias("_boolean"),
    )
    kind = F.when(F.col("_number"), "number").when(F.col("_boolean"), "boolean").otherwise("string")
    source = F.when(F.startswith("key", F.lit("$")), "attribute").otherwise("message")
    profile = summary.join(_smallest_values(counts, cap), "key").select(
        "key", "count", kind.alias("type"), source.alias("source"), "values"
    )
    ordered = profile.orderBy(F.desc("count"), F.asc("key"))
    return ordered.limit(n) if n > 0 else ordered


def merge_profiles(df: DataFrame, cap: int | None = None) -> DataFrame:
    """Per-log profiles (``key, rank, type, source, values``) -> one row per key.

    Ranks add up, values are united; of several types or sources the smallest
    non-empty spelling is kept. With ``cap`` only the smallest values of a field stay.
    """
    kind = F.lower(F.when(F.col("type") != "", F.col("type")))
    source = F.lower(F.regexp_replace(F.when(F.col("source") != "", F.col("source")), "_KVP$", ""))
    ranks = df.groupBy("key").agg(
        F.coalesce(F.sum(F.col("rank").cast("double")), F.lit(0.0)).alias("count"),
        F.min(kind).alias("type"),
        F.min(source).alias("source"),
    )
    single = df.select("key", F.explode("values").alias("value")).distinct()
    if cap is None:
        values = single.groupBy("key").agg(F.array_sort(F.collect_list("value")).alias("values"))
    else:
        values = _smallest_values(single, cap)
    return ranks.join(values, "key", "left").orderBy(F.desc("count"), F.asc("key"))


def field_values(df: DataFrame, name: str, cap: int = SAMPLE) -> DataFrame:
    """Sorted sample of the values of one field; case and a leading ``$`` don't matter."""
    target = name.removeprefix("$").lower()
    wanted = F.map_filter("attrs", lambda k, v: (normal_name(k) == target) & (v != ""))
    values = df.select(F.explode(F.map_values(wanted)).alias("value")).distinct()
    return values.orderBy("value").limit(cap)


def resolve_field(profile: DataFrame, names: DataFrame) -> DataFrame:
    """Friendly ``name`` -> exact ``field`` with ``status`` ok, unknown or ambiguous.

    An exact spelling wins, else the only key equal without case and ``$``.
    """
    keys = profile.select("key", normal_name("key").alias("_norm"))
    asked = names.select("name", normal_name("name").alias("_norm")).distinct()
    joined = asked.join(keys, "_norm", "left").groupBy("name").agg(
        F.max(F.when(F.col("key") == F.col("name"), F.col("key"))).alias("_exact"),
        F.count("key").alias("matches"),
        F.min("key").alias("_first"),
    )
    status = (
        F.when(F.col("_exact").isNotNull() | (F.col("matches") == 1), "ok")
        .when(F.col("matches") == 0, "unknown")
        .otherwise("ambiguous")
    )
    found = F.when(status == "ok", F.coalesce("_exact", "_first"))
    return joined.select("name", status.alias("status"), found.alias("field"), "matches")


def unknown_fields(refs: DataFrame, profile: DataFrame) -> DataFrame:
    """Referenced ``field`` values no event carries; ``@`` and ``$`` names always exist."""
    checked = refs.filter(~F.col("field").rlike(r"^[@$]"))
    return checked.join(profile.select(F.col("key").alias("field")), "field", "left_anti")


def check_fields(refs: DataFrame, profile: DataFrame, strict: bool = False) -> DataFrame:
    """``field, status, suggestion`` of every referenced field.

    With ``strict`` an unknown field is an ``error`` instead of a ``warning``.
    """
    distinct = refs.select("field").distinct()
    unknown = unknown_fields(distinct, profile)
    best = nearest(unknown.withColumnRenamed("field", "name"), profile)
    flagged = unknown.join(
        best.select(F.col("name").alias("field"), F.col("nearest").alias("suggestion")),
        "field",
        "left",
    ).withColumn("status", F.lit("error" if strict else "warning"))
    return distinct.join(flagged, "field", "left").select(
        "field", F.coalesce("status", F.lit("known")).alias("status"), "suggestion"
    )


def field_candidates(names: DataFrame, profile: DataFrame) -> DataFrame:
    """Close known fields for names that did not resolve (see :func:`candidates`)."""
    return candidates(names, profile, normal_name)
