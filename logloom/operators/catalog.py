"""Catalog tables: dataset references, rollups, name qualification and secret masking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import mask_secret
from logloom.sources.lines import with_once

# Fixed value: the shape of an id that needs no lookup.
UUID_TEXT = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def resolve_refs(refs: DataFrame, catalog: DataFrame) -> DataFrame:
    """``ref, status, id, matches`` for dataset references.

    ``catalog``: ``collection, name, id``. A UUID passes through,
    ``collection/name`` must exist, a bare name must be unique; status is
    ``ok``, ``not_found`` or ``ambiguous``.
    """
    asked = refs.select("ref").distinct()
    qualified = F.contains("ref", F.lit("/"))
    named = catalog.groupBy("name").agg(
        F.count(F.lit(1)).alias("matches"), F.min("id").alias("id")
    )
    # a reference is cut at its first slash
    plain = catalog.filter(~F.contains("collection", F.lit("/")))
    placed = plain.groupBy(F.concat_ws("/", "collection", "name").alias("ref")).agg(
        F.lit(1).cast("bigint").alias("matches"), F.min("id").alias("id")
    )
    known = placed.unionByName(
        named.select(F.col("name").alias("ref"), "matches", "id").filter(~F.contains("ref", F.lit("/")))
    )
    is_id = F.col("ref").rlike(UUID_TEXT)
    looked_up = asked.filter(~is_id).join(known, "ref", "left")
    matches = F.coalesce("matches", F.lit(0).cast("bigint"))
    status = F.when(matches == 0, "not_found").when(matches > 1, "ambiguous").otherwise("ok")
    resolved = looked_up.select(
        "ref", status.alias("status"), F.when(matches == 1, F.col("id")).alias("id"), matches.alias("matches")
    )
    passed = asked.filter(is_id).select(
        "ref", F.lit("ok").alias("status"), F.col("ref").alias("id"), F.lit(1).cast("bigint").alias("matches")
    )
    return resolved.unionByName(passed)


def qualify_names(catalog: DataFrame) -> DataFrame:
    """Add ``label``: the name, or ``collection/name`` when the name repeats."""
    repeated = catalog.filter("name <> ''").groupBy("name").agg(F.count(F.lit(1)).alias("_n"))
    joined = catalog.filter("name <> ''").join(repeated, "name")
    label = F.when(F.col("_n") > 1, F.concat_ws("/", "collection", "name")).otherwise(F.col("name"))
    return joined.select(*catalog.columns, label.alias("label"))


def collections_rollup(catalog: DataFrame) -> DataFrame:
    """Datasets per collection: number, and sorted non-empty names joined by ``, ``.

    The list is one cell by definition; ``catalog`` is a table of definitions,
    not of events.
    """
    names = F.array_sort(F.collect_list(F.when(F.col("name") != "", F.col("name"))))
    return catalog.groupBy("collection").agg(
        F.count(F.lit(1)).alias("datasets"), F.array_join(names, ", ").alias("names")
    )


def catalog_stats(df: DataFrame, column: str = "definition") -> DataFrame:
    """Derived columns of catalog objects held as JSON text.

    ``last_login`` is the latest of a method -> epoch seconds map,
    ``last_activity`` the heartbeat in the nested metadata (epoch ms); widget
    and component lists are counted.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    df = with_once(df, "_body", F.try_parse_json(F.col(f"`{column}`")))
    body = F.col("_body")

    def size_of(path: str):
        return F.size(F.try_variant_get(body, path, "array<variant>"))

    logins = F.transform(
        F.map_values(F.try_variant_get(body, "$.last_logins", "map<string,variant>")),
        lambda v: F.when(F.schema_of_variant(v).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(v, "$", "double")).otherwise(0.0),
    )
    latest = F.array_max(logins)
    heartbeat = F.try_variant_get(body, "$.metadata.last_heartbeat_at", "double")
    return df.select(
        *rest,
        F.when(latest > 0, F.timestamp_millis((latest * 1000).cast("bigint"))).alias("last_login"),
        F.when(heartbeat > 0, F.timestamp_millis(heartbeat.cast("bigint"))).alias("last_activity"),
        size_of("$.widget_ids").alias("widgets"),
        size_of("$.components").alias("components"),
        F.try_variant_get(body, "$.this_template_tags.log_type", "string").alias("log_type"),
    )


def mask_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mask secrets in the named columns."""
    return df.withColumns({c: mask_secret(F.col(f"`{c}`")) for c in columns})
