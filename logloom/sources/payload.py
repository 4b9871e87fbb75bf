"""JSON payloads -> rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.sources.lines import with_once


def payload_rows(df: DataFrame, column: str, keys: list[str] = ()) -> DataFrame:
    """One output row per element of the array inside a JSON payload.

    The array is the first of ``keys`` that holds one, else the payload itself,
    else its only array field; otherwise the payload is the single row.
    ``row`` is the element as VARIANT; scalars are wrapped as ``{"value": x}``.
    Other columns of ``df`` are repeated.
    """
    payload = F.try_parse_json(F.col(f"`{column}`"))
    fields = F.try_variant_get(F.col("_p"), "$", "map<string,variant>")

    def is_array(v):
        return F.startswith(F.schema_of_variant(v), F.lit("ARRAY"))

    arrays = F.filter(F.map_values(fields), is_array)
    choices = []
    for key in keys:
        named = F.try_element_at(fields, F.lit(key))
        choices.append(F.when(is_array(named), named))
    choices.append(F.when(is_array(F.col("_p")), F.col("_p")))
    choices.append(F.when(F.size(arrays) == 1, F.try_element_at(arrays, F.lit(1))))
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    staged = with_once(df, "_p", payload).filter("_p is not null")
    elements = F.coalesce(
        F.try_variant_get(F.coalesce(*choices), "$", "array<variant>"), F.array("_p")
    )
    exploded = staged.select(*rest, F.explode(elements).alias("_e"))
    is_object = F.startswith(F.schema_of_variant(F.col("_e")), F.lit("OBJECT"))
    wrapped = F.to_variant_object(F.struct(F.col("_e").alias("value")))
    return exploded.select(*rest, F.when(is_object, F.col("_e")).otherwise(wrapped).alias("row"))


def extract_path(df: DataFrame, column: str, path: str, out: str = "value") -> DataFrame:
    """0..N values of a JSON path per row (``[*]`` fans out); rows it does not fit are skipped.

    Integers are exact at any size.
    """
    steps = path.split("[*]")
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    current = with_once(df, "_v", F.try_parse_json(F.col(f"`{column}`")))
    for i, step in enumerate(steps):
        at = "$" + (step[1:] if step.startswith("$") else step)
        value = F.col("_v") if at == "$" else F.try_variant_get(F.col("_v"), at, "variant")
        current = current.select(*rest, value.alias("_v"))
        if i < len(steps) - 1:
            items = F.try_variant_get(F.col("_v"), "$", "array<variant>")
            current = current.select(*rest, F.explode(items).alias("_v"))
    return current.filter("_v is not null").select(*rest, F.col("_v").cast("string").alias(out))
