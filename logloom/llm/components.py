"""Connected components of an edge table, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; ``root`` is the smallest node reachable.

    Every round replaces the edges by those between the nodes' smallest neighbours
    (large star) and then hangs smaller neighbours on the smallest (small star), so a
    chain of n edges takes about log n rounds. Both steps only aggregate minima and
    join on a node; a star's centre is never gathered. Each round is a stored table.
    Loops and repeated edges do no harm; edges with a null end are left out; no edges
    give no rows.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u <> v")
    pairs = materialize(_ordered(pairs).distinct())
    while True:
        linked = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = linked.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: every larger neighbour of a node goes to the node's minimum.
        large = linked.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(_ordered(large.filter("u <> v")).distinct())
        # Small star: a node's smaller neighbours, and itself, go to the smallest of them.
        low = large.groupBy(F.col("v").alias("u")).agg(F.min("u").alias("m"))
        small = large.join(low.withColumnRenamed("u", "v"), "v").select(F.col("u").alias("x"), "v", "m")
        after = small.selectExpr("x as u", "m as v").unionByName(small.selectExpr("v as u", "m as v"))
        after = materialize(_ordered(after.filter("u <> v")).distinct())
        if _fingerprint(after) == _fingerprint(pairs):
            return after.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
                after.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
            )
        pairs = after


def _ordered(pairs: DataFrame) -> DataFrame:
    """``u`` the smaller end."""
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def _fingerprint(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
