"""Projections of dynamic events: selecting, listing, ranking and unpivoting fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.functions.coerce import to_number0
from logloom.functions.predicates import CORE_FIELDS, field
from logloom.functions.text import bucket_time
from logloom.operators.ranking import running

# Columns that lead a listing, and how many others push @raw out.
LEADING = ("@time", "@status")
RAW_DROP_THRESHOLD = 3

CORE_FIELDS_BY_COLUMN = {column: key for key, column in CORE_FIELDS.items()}


def select(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns or fields as columns; an absent field reads as null."""
    return df.select(
        *[(F.col(f"`{n}`") if n in df.columns else field(n)).alias(n) for n in names]
    )


def keep_fields(df: DataFrame, names: list[str]) -> DataFrame:
    """Narrow ``attrs`` to the named fields; absent ones stay absent."""
    wanted = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    kept = F.map_filter(F.col("attrs"), lambda k, _: F.array_contains(wanted, k))
    return df.withColumn("attrs", kept)


def as_row_json(df: DataFrame, names: list[str] | None = None) -> Column:
    """A row as one JSON object; absent and null keys are left out.

    Core keys come first, then the fields by name; ``names`` picks keys, in its order.
    """
    by_key = {CORE_FIELDS_BY_COLUMN.get(c, c): c for c in df.columns if c != "attrs"}
    with_attrs = "attrs" in df.columns
    if names is not None:
        picked = []
        for name in names:
            if name in by_key or name in df.columns:
                picked.append(F.col(f"`{by_key.get(name, name)}`").alias(name))
            elif with_attrs:
                picked.append(F.col("attrs")[name].alias(name))
        return F.to_json(F.struct(*picked)) if picked else F.lit("{}")
    typed = [F.col(f"`{c}`").alias(k) for k, c in by_key.items()]
    plain = F.to_json(F.struct(*typed)) if typed else F.lit("{}")
    if not with_attrs:
        return plain
    taken = F.array(*[F.lit(k) for k in by_key]).cast("array<string>")
    present = F.filter(F.map_entries("attrs"), lambda e: e["value"].isNotNull() & ~F.array_contains(taken, e["key"]))
    attrs = F.to_json(F.map_from_entries(F.array_sort(present)))
    # two JSON objects side by side, without their inner braces
    head = F.substr(plain, F.lit(2), F.length(plain) - 2)
    tail = F.substr(attrs, F.lit(2), F.length(attrs) - 2)
    parts = F.filter(F.array(head, tail), lambda p: p != "")
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))


def field_entries(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """One ``key``, ``value`` row per field of every event."""
    return df.select(*keep, F.explode("attrs").alias("key", "value"))


def field_union(df: DataFrame) -> DataFrame:
    """Sorted names of all fields of a result."""
    names = df.select(F.explode(F.map_keys("attrs")).alias("key")).distinct()
    return names.orderBy("key")


def is_plumbing(key: Column) -> Column:
    """Bulky bookkeeping fields that listings never promote."""
    return (key == "links") | F.startswith(key, F.lit("metadata."))


def column_stats(df: DataFrame) -> DataFrame:
    """``key``, ``present`` and ``variety`` (distinct values) of every column worth listing.

    The core columns of ``df`` count like any field. Null, empty and ``"null"`` values are not presence.
    """
    covered = {key: column for key, column in CORE_FIELDS.items() if column in df.columns}
    core = [
        F.struct(F.lit(key).alias("key"), F.col(f"`{column}`").cast("string").alias("value"))
        for key, column in covered.items()
    ]
    own = F.map_filter(F.col("attrs"), lambda k, _: ~k.isin(*covered))
    pairs = df.select(F.inline(F.concat(F.array(*core), F.map_entries(own))) if core else F.explode(own).alias("key", "value"))
    pairs = pairs.filter(F.col("value").isNotNull() & ~F.col("value").isin("", "null"))
    last = F.regexp_extract("key", r"([^.]*)$", 1)
    skipped = is_plumbing(F.col("key")) | last.isin("timestamp", "@timestamp")
    return (
        pairs.filter(~skipped)
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("present"), F.count_distinct("value").alias("variety"))
    )


def rank_columns(df: DataFrame, cap: int = 8) -> DataFrame:
    """The ``cap`` most informative columns as ``position``, ``key``, ``present``, ``variety``.

    ``@time`` and ``@status`` lead; then fields by presence, variety and name;
    ``@raw`` is last and gives way once three other fields fit. ``cap`` 0 is no cap.
    """
    key = F.col("key")
    kind = F.when(key.isin(*LEADING), 0).when(key == "@raw", 2).otherwise(1)
    ranking = [F.when(kind == 1, 1).otherwise(0), F.desc("present"), F.desc("variety"), F.asc("key")]
    # one row per field, and with a cap at most cap + 3 of them, so the windows below are small
    top = column_stats(df).withColumn("kind", kind)
    if cap > 0:
        top = top.orderBy(*ranking).limit(cap + 3)
    everything = Window.partitionBy()
    n_lead = F.count_if(F.col("kind") == 0).over(everything)
    has_raw = F.count_if(F.col("kind") == 2).over(everything) > 0
    n_other = F.count_if(F.col("kind") == 1).over(everything)
    room = F.greatest(F.lit(cap) - n_lead, F.lit(0)) if cap > 0 else n_other + 1
    beside_raw = F.greatest(room - 1, F.lit(0))
    keep_raw = has_raw & (F.least(n_other, beside_raw) < RAW_DROP_THRESHOLD)
    place = F.row_number().over(
        Window.partitionBy("kind").orderBy(
            F.when(F.col("kind") == 0, F.when(key == LEADING[0], 0).otherwise(1)).otherwise(0),
            F.desc("present"),
            F.desc("variety"),
            F.asc("key"),
        )
    )
    staged = top.select(
        "*",
        place.alias("place"),
        keep_raw.alias("keep_raw"),
        F.when(keep_raw, beside_raw).otherwise(room).alias("room"),
    )
    kept = staged.filter(
        (F.col("kind") == 0)
        | ((F.col("kind") == 1) & (F.col("place") <= F.col("room")))
        | ((F.col("kind") == 2) & F.col("keep_raw"))
    )
    position = F.row_number().over(Window.orderBy("kind", "place"))
    return kept.select(
        position.cast("bigint").alias("position"), "key", "present", "variety"
    ).orderBy("position")


def listed_columns(df: DataFrame, order: list[str], cap: int = 0) -> DataFrame:
    """Every field as ``position``, ``key`` in the order rows show it, alphabetical inside a row.

    ``@time``, ``@status`` and ``@raw`` lead. With ``cap`` only the first few.
    """
    lead = [*LEADING, "@raw"]
    core = F.array(*[
        F.when(F.col(CORE_FIELDS[key]).isNotNull(), F.lit(key))
        for key in lead
        if CORE_FIELDS[key] in df.columns
    ]).cast("array<string>")
    names = F.concat(F.filter(core, lambda k: k.isNotNull()), F.map_keys("attrs"))
    keys = df.select(F.explode(F.array_distinct(names)).alias("key"), F.struct(*order).alias("_seen"))
    first = keys.groupBy("key").agg(F.min("_seen").alias("_seen"))
    place = F.array_position(F.array(*[F.lit(k) for k in lead]), F.col("key"))
    ranked = first.withColumn("_place", F.when(place == 0, len(lead) + 1).otherwise(place))
    ranked = ranked.withColumn("_seen", F.when(place == 0, F.col("_seen")))
    if cap > 0:
        ranked = ranked.orderBy("_place", "_seen", "key").limit(cap)
    return running(ranked, [], ["_place", "_seen", "key"], rank="position").select("position", "key")


def expand_rows(df: DataFrame, priority: list[str], keep: list[str] = ()) -> DataFrame:
    """One row per (event, field): priority fields first, the rest alphabetically."""
    order = F.array(*[F.lit(p) for p in priority]).cast("array<string>")
    entries = F.transform(
        F.map_entries("attrs"),
        lambda e: F.struct(
            F.when(
                F.array_contains(order, e["key"]), F.array_position(order, e["key"])
            ).otherwise(F.lit(len(priority) + 1).cast("bigint")).alias("rank"),
            e["key"].alias("key"),
            e["value"].alias("value"),
        ),
    )
    exploded = df.select(*keep, F.posexplode(F.array_sort(entries)).alias("_pos", "_e"))
    return exploded.select(
        *keep,
        (F.col("_pos") + 1).cast("bigint").alias("position"),
        F.col("_e.key").alias("key"),
        F.col("_e.value").alias("value"),
    )


def series_rows(df: DataFrame, multi: bool | None = None) -> DataFrame:
    """Nested usage series -> ``time, events, volume`` rows.

    ``df`` holds one query per row: ``name`` and ``series``, an array of
    ``{time, count, value}`` texts. ``metric`` names the query and is only
    there for more than one of them.
    """
    if multi is None:
        multi = df.limit(2).count() > 1
    points = df.select("name", F.explode("series").alias("p"))
    return points.select(
        *([F.col("name").alias("metric")] if multi else []),
        bucket_time(F.col("p.time")).alias("time"),
        to_number0(F.col("p.count")).alias("events"),
        to_number0(F.col("p.value")).alias("volume"),
    )


def parse_group(value: Column | str) -> Column:
    """A dumped group key -> list of texts.

    Accepts a JSON list, a JSON object (values by sorted key), ``[a, b]`` text
    or a scalar; null elements read as empty.
    """
    text = F.col(value) if isinstance(value, str) else value
    parsed = F.try_parse_json(text)
    kind = F.schema_of_variant(parsed)
    items = F.transform(
        F.try_variant_get(parsed, "$", "array<variant>"),
        lambda v: F.coalesce(v.cast("string"), F.lit("")),
    )
    fields = F.array_sort(
        F.map_entries(
            F.transform_values(
                F.try_variant_get(parsed, "$", "map<string,variant>"),
                lambda _, v: F.coalesce(v.cast("string"), F.lit("")),
            )
        )
    )
    plain = F.trim(F.when(kind == "STRING", parsed.cast("string")).otherwise(text))
    inner = F.regexp_extract(plain, r"^\[([\s\S]*)\]$", 1)
    listed = F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, ", ", -1)
    )
    return (
        F.when(F.startswith(kind, F.lit("ARRAY")), items)
        .when(F.startswith(kind, F.lit("OBJECT")), F.transform(fields, lambda e: e["value"]))
        .when(text.isNull() | (kind == "VOID"), F.array().cast("array<string>"))
        .when(plain.rlike(r"^\[[\s\S]*\]$"), listed)
        .otherwise(F.array(plain))
    )


def group_rows(df: DataFrame, column: str = "group", names: list[str] = ()) -> DataFrame:
    """Turn a dumped group key into columns ``names``."""
    parts = parse_group(column)
    rest = [c for c in df.columns if c != column]
    return df.select(
        *[
            F.coalesce(F.try_element_at(parts, F.lit(i + 1)), F.lit("")).alias(n)
            for i, n in enumerate(names)
        ],
        *rest,
    )
