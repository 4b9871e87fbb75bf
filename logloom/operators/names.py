"""Nearest-name joins without comparing every pair.

Two names within edit distance 2 share a string reachable from both by at most
two deletions, so an equi-join on those strings finds every pair exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Accepted edit distance, and candidates shown per name.
MAX_DISTANCE = 2
MAX_CANDIDATES = 3


def _deletions(text: Column) -> Column:
    """Every string one deletion away."""
    positions = F.sequence(F.lit(1), F.greatest(F.char_length(text), F.lit(1)))
    return F.transform(
        positions,
        lambda i: F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1)),
    )


def deletion_keys(text: Column, distance: int = MAX_DISTANCE) -> Column:
    """The string and everything reachable from it by up to ``distance`` deletions."""
    reach, level = [F.array(text)], F.array(text)
    for _ in range(distance):
        level = F.array_distinct(F.flatten(F.transform(level, _deletions)))
        reach.append(level)
    return F.array_distinct(F.concat(*reach))


def nearest(
    names: DataFrame,
    known: DataFrame,
    max_distance: int = MAX_DISTANCE,
    normal: Callable[[str], Column] = F.lower,
) -> DataFrame:
    """``name, nearest, distance``: the closest ``key`` of ``known`` within ``max_distance``.

    Case is ignored. On ties the most frequent key (``count`` descending) wins,
    then the smallest. Distances count characters.
    """
    left = names.select("name").distinct().withColumn("_a", normal("name"))
    right = known.select("key", "count").withColumn("_b", normal("key"))
    left = left.withColumn("_k", F.explode(deletion_keys(F.col("_a"), max_distance)))
    right = right.withColumn("_k", F.explode(deletion_keys(F.col("_b"), max_distance)))
    distance = F.levenshtein("_a", "_b", max_distance)
    pairs = left.join(right, "_k").select("name", "key", "count", distance.alias("distance"))
    best = (
        pairs.filter("distance >= 0")
        .groupBy("name")
        .agg(F.min(F.struct("distance", (-F.col("count")).alias("_rank"), "key")).alias("_best"))
    )
    return best.select(
        "name", F.col("_best.key").alias("nearest"), F.col("_best.distance").alias("distance")
    )


def _substrings(text: Column) -> Column:
    n = F.char_length(text)
    starts = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    return F.array_distinct(
        F.flatten(
            F.transform(
                starts,
                lambda i: F.transform(
                    F.sequence(F.lit(1), F.greatest(n - i + 1, F.lit(1))),
                    lambda length: F.substr(text, i, length),
                ),
            )
        )
    )


def candidates(
    names: DataFrame, known: DataFrame, normal: Callable[[str], Column] = F.lower
) -> DataFrame:
    """Up to three close keys per name as ``name, position, candidate``.

    Keys containing the name come first; only a name without any gets its
    nearest key.
    """
    asked = names.select("name").distinct().withColumn("_needle", normal("name"))
    keys = known.select("key", normal("key").alias("_text"))
    parts = keys.select("key", F.explode(_substrings(F.col("_text"))).alias("_needle"))
    # only the first keys around a text can be shown, so the rest never meets the names
    place = F.row_number().over(Window.partitionBy("_needle").orderBy("key"))
    few = parts.withColumn("position", place).filter(F.col("position") <= MAX_CANDIDATES)
    top = asked.join(few, "_needle")
    lonely = asked.join(parts.select("_needle"), "_needle", "left_anti")
    fallback = nearest(lonely, known, normal=normal).select(
        "name", F.lit(1).alias("position"), F.col("nearest").alias("candidate")
    )
    return top.select("name", "position", F.col("key").alias("candidate")).unionByName(fallback)
