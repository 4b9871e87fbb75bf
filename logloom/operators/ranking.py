"""Row numbers and running sums over groups of any size.

A plain ``row_number()`` window sorts each group in one task. Here the rows are
range-partitioned by ``group + order`` (a large group spans many partitions),
numbered inside their partition, and shifted by what the partitions before it
hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.session import materialize


def _sort_column(name: str) -> Column:
    if name.startswith("-"):
        return F.col(name[1:]).desc()
    return F.col(name).asc()


def running(
    df: DataFrame,
    group: list[str],
    order: list[str],
    sums: dict[str, str] | None = None,
    rank: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``rank`` (1-based position in the group) and running ``sums``.

    ``sums`` maps a new column to the BIGINT column it accumulates (inclusive);
    an ``order`` name with a leading ``-`` sorts descending. ``order`` must be
    unique within a group for a repeatable result.
    """
    sums = sums or {}
    keys = [F.col(g) for g in group] + [_sort_column(o) for o in order]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    # the partition number becomes data, so it must not change on a re-run
    staged = materialize(ranged.withColumn("_slice", F.spark_partition_id()))

    per_slice = staged.groupBy("_slice", *group).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(source).alias(f"_t{i}") for i, source in enumerate(sums.values())],
    )
    # one row per (slice, group): at most slices + groups rows in total
    before = (
        Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = ["_n"] + [f"_t{i}" for i in range(len(sums))]
    offsets = per_slice.select(
        "_slice",
        *group,
        *[F.coalesce(F.sum(t).over(before), F.lit(0).cast("bigint")).alias(f"_o{t}") for t in totals],
    )

    local = Window.partitionBy("_slice", *group).orderBy(*[_sort_column(o) for o in order])
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = staged.select(
        "*",
        F.row_number().over(local).alias("_l_n"),
        *[F.sum(source).over(upto).alias(f"_l_t{i}") for i, source in enumerate(sums.values())],
    )
    left, right = numbered.alias("l"), offsets.alias("r")
    same = F.col("l._slice") == F.col("r._slice")
    for g in group:
        same = same & F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}"))
    joined = left.join(right, same)
    return joined.select(
        *[F.col(f"l.`{c}`") for c in df.columns],
        (F.col("_l_n") + F.col("_o_n")).alias(rank),
        *[
            (F.col(f"_l_t{i}") + F.col(f"_o_t{i}")).alias(name)
            for i, name in enumerate(sums)
        ],
    )
