"""Consistent sharding by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in an order of its own
(``offset + i * skip``). The shards take turns; each claims the first slot of its order
that is still free, until the table is full. Shards get equal numbers of slots (to one),
and adding or removing a shard moves few others. A row's slot is a hash of its key
modulo the table size, its shard one broadcast lookup in that fixed-size table.

The table depends on the shard names alone and is filled on the driver; rows are placed
with DataFrame functions only.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.batches import free_name

SLOTS = 65_537


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Shard number of every slot. ``slots`` must be prime and at least the number of shards."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be named, each once")
    if slots < max(2, len(shards)) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime, no smaller than the number of shards")
    offset = [_number(f"offset {s}") % slots for s in shards]
    skip = [_number(f"skip {s}") % (slots - 1) + 1 for s in shards]
    table, turn, filled = [-1] * slots, [0] * len(shards), 0
    while True:
        for shard in range(len(shards)):
            while table[slot := (offset[shard] + turn[shard] * skip[shard]) % slots] >= 0:
                turn[shard] += 1
            table[slot] = shard
            filled += 1
            if filled == slots:
                return table


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard) with one row per slot: fixed size, whatever the data."""
    names = {str(i): s for i, s in enumerate(shards)}
    text = ",".join(map(str, fill_table(shards, slots)))
    table = spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("slot", "n"))
    named = F.array(*[F.lit(s) for s in names.values()])
    return table.select("slot", F.element_at(named, F.col("n").cast("int") + 1).alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 60 bits of its MD5 modulo ``slots``."""
    digits = F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")
    return F.pmod(digits, F.lit(slots)).cast("int")


def place(
    docs: DataFrame,
    key: str,
    shards: list[str],
    spread: str | None = None,
    slots: int = SLOTS,
    slot: str = "slot",
    shard: str = "shard",
) -> DataFrame:
    """``docs`` with ``slot`` and ``shard``; equal keys go to one shard.

    With ``spread``, keys that hold more than one shard's even part of all rows are cut
    up: their rows are placed by key and ``spread`` together. There are fewer such keys
    than shards, so the list of them is broadcast. A null key is a key of its own, a null
    ``spread`` too; repeated rows go to the same shard; an empty table stays empty. Other
    columns pass through; columns called like the new ones are replaced.
    """
    spark = docs.sparkSession
    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null"))
    kept = [c for c in docs.columns if c.lower() not in (slot.lower(), shard.lower())]
    own, many = free_name(docs, "own_key"), free_name(docs, "many")
    placed = docs.withColumn(own, name)
    if spread:
        rows = docs.count()
        hot = placed.groupBy(own).agg(F.count("*").alias(many)).filter(F.col(many) * len(shards) > rows)
        part = F.coalesce(F.concat(F.lit("="), F.col(spread).cast("string")), F.lit("null"))
        placed = placed.join(F.broadcast(hot), own, "left").withColumn(
            own, F.when(F.col(many).isNotNull(), F.concat(own, F.lit("\t"), part)).otherwise(F.col(own))
        )
    placed = placed.select(*[F.col(f"`{c}`") for c in kept], slot_of(F.col(own), slots).alias(slot))
    table = lookup(spark, shards, slots).withColumnsRenamed({"slot": slot, "shard": shard})
    return placed.join(F.broadcast(table), slot, "left").select(*[F.col(f"`{c}`") for c in kept], slot, shard)


def shard_documents(docs: DataFrame, n: int = 64) -> DataFrame:
    """Every document's shard by its source; sources too large for one shard are spread by document."""
    shards = [f"shard-{i:03d}" for i in range(n)]
    return place(docs.select("doc_id", "source"), "source", shards, spread="doc_id")
