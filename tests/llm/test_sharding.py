from collections import Counter

import pytest
from pyspark.sql import functions as F

from logloom.llm import sharding

SHARDS = [f"s{i}" for i in range(7)]


def brute_table(shards, slots):
    """Whole preference orders, and turns over them."""
    orders = []
    for s in shards:
        offset, skip = sharding._number(f"offset {s}") % slots, sharding._number(f"skip {s}") % (slots - 1) + 1
        orders.append([(offset + i * skip) % slots for i in range(slots)])
    table = {}
    while len(table) < slots:
        for n, order in enumerate(orders):
            if len(table) < slots:
                table[next(x for x in order if x not in table)] = n
    return [table[i] for i in range(slots)]


@pytest.mark.parametrize("slots", [7, 101, 211])
def test_table_against_whole_orders(slots):
    table = sharding.fill_table(SHARDS, slots)
    assert table == brute_table(SHARDS, slots)
    counts = Counter(table).values()
    assert max(counts) - min(counts) <= 1


def test_losing_a_shard_moves_few_others():
    before, after = sharding.fill_table(SHARDS, 65_537), sharding.fill_table(SHARDS[:-1], 65_537)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 6)
    assert moved < 0.1 * len(before)


def test_refused_tables():
    for shards, slots in (([], 7), (["a", "a"], 7), (["a"], 9), (SHARDS, 5)):
        with pytest.raises(ValueError):
            sharding.fill_table(shards, slots)


def test_rows_against_the_table(documents):
    rows = sharding.shard_documents(documents).collect()
    names = [f"shard-{i:03d}" for i in range(64)]
    table = sharding.fill_table(names)
    counts = Counter(r.source for r in rows)
    for r in rows:
        key = f"={r.source}" + (f"\t={r.doc_id}" if counts[r.source] * 64 > len(rows) else "")
        assert r.slot == sharding._number(key) % sharding.SLOTS and r.shard == names[table[r.slot]]
    assert len(rows) == documents.count()


def test_keys_stay_together_unless_spread(odd_docs, no_docs):
    docs = odd_docs.withColumn("slot", F.lit("x")).withColumn("source", F.lit("hot"))
    whole = sharding.place(docs, "source", SHARDS, slots=101)
    assert whole.select("shard").distinct().count() == 1 and whole.count() == docs.count()
    spread = sharding.place(docs, "source", SHARDS, spread="doc_id", slots=101)
    assert spread.columns == [*odd_docs.columns, "slot", "shard"] and spread.count() == docs.count()
    assert spread.select("shard").distinct().count() > 1
    assert sharding.place(docs.withColumn("source", F.lit(None).cast("string")), "source", SHARDS).filter("shard is null").count() == 0
    assert sharding.shard_documents(no_docs).count() == 0
