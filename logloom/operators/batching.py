"""Batches of an ordered stream, cut as one sender would cut them, without one task seeing the stream.

A batch closes with the event that brings it to a number of events or bytes, and both counts start
anew with the next one, so where a batch starts depends on every batch before it. But where a batch
that starts at some event ends is known from the few events after it: a pointer per event. Chunks of
the stream follow their pointers on their own and keep, for each of the first few events, the event at
which a batch that starts there leaves the chunk. These short tables are composed by pointer doubling
from the first event on, which tells every chunk where its first batch starts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.ranking import running
from logloom.session import materialize

CHUNK = 65_536


def _following(rows: pd.DataFrame, max_events: int, max_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in order, and of each the rank after the batch that starts there (as far as the rows tell)."""
    rows = rows.sort_values("rank")
    rank, upto = rows["rank"].to_numpy(), rows["bytes"].to_numpy()
    before = upto - rows["size"].to_numpy()
    by_bytes = np.searchsorted(upto, before + max_bytes, side="left") + 1
    return rank, rank[0] + np.minimum(np.arange(len(rank)) + max_events, by_bytes)


def _exits(max_events: int, max_bytes: int, chunk: int):
    """Of the first events of a chunk: where the first batch of a later chunk starts if one starts here."""

    def work(key, rows: pd.DataFrame) -> pd.DataFrame:
        number = int(key[0])
        rank, following = _following(rows, max_events, max_bytes)
        end = (number + 1) * chunk + 1
        own = rank < end
        rank, out = rank[own], following[own]
        while True:  # pointers double until all have left
            inside = out < rank[0] + len(rank)
            if not inside.any():
                break
            out[inside] = out[out[inside] - rank[0]]
        return pd.DataFrame({"rank": rank[:max_events], "leaves": out[:max_events]})

    return work


def _starts(max_events: int, max_bytes: int, chunk: int):
    """The batches that start in a chunk, from its first one on."""

    def work(key, rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(entries) and len(rows):  # the last batch may leave the stream
            rank, following = _following(rows, max_events, max_bytes)
            at, end = int(entries["rank"].iloc[0]), (int(key[0]) + 1) * chunk + 1
            while at < end and at <= rank[-1]:
                found.append((int(key[0]), at, int(following[at - rank[0]]) - 1))
                at = found[-1][2] + 1
        return pd.DataFrame(found, columns=["chunk", "first", "last"])

    return work


def _entries(tables: DataFrame, chunks: int) -> DataFrame:
    """Ranks reached from the first event: one per chunk."""
    reached = tables.filter("rank = 1").select("rank")
    pointers = tables
    stride = 1
    while stride < chunks:
        ahead = pointers.join(reached, "rank").select(F.col("leaves").alias("rank"))
        reached = materialize(reached.unionByName(ahead))
        stride *= 2
        if stride < chunks:
            onward = pointers.select(F.col("rank").alias("leaves"), F.col("leaves").alias("_then"))
            pointers = materialize(pointers.join(onward, "leaves").select("rank", F.col("_then").alias("leaves")))
    return reached


def greedy_batches(
    df: DataFrame, order: list[str], size: Column, max_events: int, max_bytes: int, chunk: int = CHUNK
) -> DataFrame:
    """``df`` with ``batch``, 0-based in ``order``, as if events were added one by one.

    A batch closes with the event that makes it ``max_events`` long or brings its ``size`` sum to ``max_bytes``;
    sizes are positive. ``order`` must be total for a repeatable result; nulls of it come first.
    """
    if max_events < 1 or max_bytes < 1:
        raise ValueError("a batch holds at least one event and one byte")
    chunk = max(chunk, max_events)
    sized = df.withColumn("_size", size.cast("bigint"))
    ranked = materialize(running(sized, [], order, {"_bytes": "_size"}, rank="_rank"))
    number = F.expr(f"(_rank - 1) div {chunk}")
    narrow = ranked.select(number.alias("chunk"), F.col("_rank").alias("rank"), F.col("_size").alias("size"), F.col("_bytes").alias("bytes"))
    # the first events of a chunk also end batches of the chunk before it
    halo = narrow.filter((F.col("chunk") > 0) & ((F.col("rank") - 1) % chunk < max_events)).withColumn("chunk", F.col("chunk") - 1)
    stretches = narrow.unionByName(halo).groupBy("chunk")
    tables = materialize(stretches.applyInPandas(_exits(max_events, max_bytes, chunk), "rank bigint, leaves bigint"))
    chunks = (ranked.agg(F.max("_rank")).first()[0] or 0) // chunk + 1
    entries = _entries(tables, chunks).withColumn("chunk", F.expr(f"(rank - 1) div {chunk}"))
    found = stretches.cogroup(entries.groupBy("chunk")).applyInPandas(
        _starts(max_events, max_bytes, chunk), "chunk bigint, first bigint, last bigint"
    )
    batches = running(materialize(found), [], ["first"], rank="_n").withColumn("batch", F.col("_n") - 1)
    # no batch is longer than a block, so it lies in two of them at most
    block = lambda rank: F.expr(f"({rank} - 1) div {max_events}")
    held = batches.select("first", "batch", F.explode(F.array_distinct(F.array(block("first"), block("last")))).alias("_block"))
    held = held.groupBy("_block").agg(F.sort_array(F.collect_list(F.struct("first", "batch"))).alias("_held"))
    placed = ranked.withColumn("_block", block("_rank")).join(held, "_block")
    own = F.element_at(F.filter("_held", lambda b: b["first"] <= F.col("_rank")), -1)["batch"]
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], own.alias("batch"))
