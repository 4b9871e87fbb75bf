"""SimHash near-duplicates by tiled exact comparison.

Documents become 64-bit fingerprints of word shingles. Equal fingerprints are one
class. Distinct fingerprints are cut into tiles by the population counts of their
four 16-bit quarters: two fingerprints that differ in at most ``radius`` bits have
quarter counts that differ by at most ``radius`` in total, so only tiles that near
meet, through an equi-join on the quarter counts, and all other tile pairs are
skipped. A pair of tiles is compared exactly with numpy (exclusive-or, bit count)
and yields a spanning forest of its links rather than the links themselves.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.llm.batches import free_name, small_batches
from logloom.llm.components import components
from logloom.session import materialize

BITS, QUARTERS = 64, 4
SEED = 42  # of the shingles' XXH64


def shingles_of(text: str | None, size: int, step: int = 1 << 14) -> Iterator[list[bytes]]:
    """Word shingles of the text in lists of up to ``step``, A-Z lower-cased, repeats included.

    A text with fewer words than ``size`` is one shingle.
    """
    words = text.encode().lower().split() if text else []
    if 0 < len(words) < size:
        yield [b" ".join(words)]
    for start in range(0, len(words) - size + 1, step):
        part = words[start : start + step + size - 1]
        yield list(map(b" ".join, zip(*(part[i:] for i in range(size)), strict=False)))


def fingerprint_of(text: str | None, size: int) -> int:
    """Bits set in over half of the shingles' hashes, as a signed 64-bit number."""
    import xxhash

    total, ones = 0, np.zeros(BITS, dtype=np.int64)
    for shingles in shingles_of(text, size):
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(shingles)
    packed = np.packbits(2 * ones > total, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint(text: Column, size: int) -> Column:
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t, size) for t in texts], dtype="int64")

    return run(text)


def _counts() -> list[Column]:
    return [
        F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF).cast("long"))).cast("int")
        for i in range(QUARTERS)
    ]


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts within the radius, one of each pair of opposites."""
    span = range(-radius, radius + 1)
    return [d for d in itertools.product(span, repeat=QUARTERS) if sum(map(abs, d)) <= radius and d >= (0,) * QUARTERS]


def _least_labels(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest node of each node's component among ``n`` nodes."""
    label = np.arange(n)
    while True:
        before = label.copy()
        for a, b in pairs:
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
        while not np.array_equal(jump := label[label], label):
            label = jump
        if np.array_equal(label, before):
            return label


def links_between(host: np.ndarray, guest: np.ndarray, same: bool, radius: int) -> Iterator[tuple[int, int]]:
    """Spanning forest of the links between two tiles, or inside one (``same``)."""
    host_bits, guest_bits = host.view(np.uint64), guest.view(np.uint64)
    nodes = host if same else np.concatenate([host, guest])
    shift = 0 if same else len(host)
    forest = np.arange(len(nodes))
    for start in range(0, len(host), 256):
        block = host_bits[start : start + 256]
        near = np.bitwise_count(block[:, None] ^ guest_bits[None, :]) <= radius
        a, b = np.nonzero(near)
        a, b = a + start, b + shift
        if same:
            a, b = a[a < b], b[a < b]
        if len(a):
            rest = np.flatnonzero(forest != np.arange(len(nodes)))
            forest = _least_labels(len(nodes), [(a, b), (rest, forest[rest])])
    rest = np.flatnonzero(forest != np.arange(len(nodes)))
    return zip(nodes[forest[rest]].tolist(), nodes[rest].tolist(), strict=True)


def _compare(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for host, guest, same in zip(batch["host"], batch["guest"], batch["same"], strict=True):
                links = list(links_between(np.asarray(host, np.int64), np.asarray(guest, np.int64), same, radius))
                if links:
                    yield pd.DataFrame(links, columns=["a", "b"])

    return run


def tile_links(prints: DataFrame, radius: int = 3, tile: int = 4096) -> DataFrame:
    """Links (a, b) that connect the fingerprints ``fp`` (distinct) within ``radius`` differing bits.

    Not all pairs: what is connected stays connected. A tile holds about ``tile``
    fingerprints with equal quarter counts; fuller cells are cut by a hash.
    """
    cells = prints.select("fp", F.array(*_counts()).alias("cell"))
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n"))
    chunks = cells.join(sizes, "cell").withColumn(
        "chunk", F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / tile)).cast("int")
    )
    tiles = materialize(chunks.groupBy("cell", "chunk").agg(F.collect_list("fp").alias("fps")))
    deltas = F.array(*[F.array(*map(F.lit, d)) for d in _offsets(radius)])
    guests = (
        tiles.select("cell", F.col("chunk").alias("guest_chunk"), F.col("fps").alias("guest"), F.explode(deltas).alias("d"))
        .select(
            F.zip_with("cell", "d", lambda c, d: c + d).alias("cell"),
            "guest_chunk",
            "guest",
            (F.col("d") == F.array(*[F.lit(0)] * QUARTERS)).alias("own"),
        )
    )
    met = tiles.join(guests, "cell").filter(~F.col("own") | (F.col("chunk") <= F.col("guest_chunk")))
    pairs = met.select(
        F.col("fps").alias("host"), "guest", (F.col("own") & (F.col("chunk") == F.col("guest_chunk"))).alias("same")
    )
    small_batches(prints.sparkSession)
    return pairs.mapInPandas(_compare(radius), "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, radius: int = 3) -> DataFrame:
    """(id, fingerprint as a number, component: smallest id whose document is linked, also through others).

    Words are what stands between ASCII white space, A-Z lower-cased; shingles take
    ``size`` words, shorter texts are one shingle. Null, empty and blank texts have the
    fingerprint zero, linked like any other. Rows with repeated ids all stay; a null id
    stays with its component, and alone it has the component null. An empty table gives
    no rows.
    """
    small_batches(docs.sparkSession)
    prints = materialize(docs.select(F.col(doc_id).alias("id"), fingerprint(F.col(text), size).alias("fp")))
    classes = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")))
    linked = materialize(components(tile_links(classes, radius)))
    # Nodes of components are fingerprints; the name of one is the smallest id in it.
    rooted = classes.join(linked.withColumnRenamed("node", "fp"), "fp")
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    others = rooted.select("fp", "root").join(named, "root").select("fp", "component")
    alone = classes.join(linked, classes.fp == linked.node, "left_anti").select("fp", F.col("least").alias("component"))
    return prints.join(others.unionByName(alone), "fp").select("id", "fp", "component")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, radius: int = 3) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id.

    Two texts are near-duplicates if their fingerprints of ``size``-word shingles differ in at
    most ``radius`` bits; groups are what is linked, also through others. Columns stay as they
    are. Of several texts under one id each is judged by itself, so an id stays once for every
    group it leads; of rows that share an id and a fingerprint one stays. Rows without an id
    stay only if nothing else is in their group, and then all of them do. Null, empty and blank
    texts are one group. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    prints = materialize(docs.select(F.col(doc_id).alias("id"), fingerprint(F.col(text), size).alias("fp")))
    linked = materialize(components(tile_links(prints.select("fp").distinct(), radius)))
    found = prints.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = found.groupBy("root").agg(F.min(F.when(F.col("id").isNotNull(), F.struct("id", "fp"))).alias("first"))
    # A fingerprint has one root, so (id, fingerprint) tells which group a row leads.
    led = found.join(named, "root").filter(F.struct("id", "fp").eqNullSafe(F.col("first")) | F.col("first").isNull())
    key, own = free_name(docs, "kept_id"), free_name(docs, "fingerprint")
    first = led.select(F.col("id").alias(key), F.col("fp").alias("of")).distinct()
    marked = docs.withColumn(own, fingerprint(F.col(text), size))
    kept = marked.join(first, F.col(doc_id).eqNullSafe(F.col(key)) & (F.col(own) == F.col("of")), "left_semi")
    repeated = prints.filter(F.col("id").isNotNull()).groupBy("id", "fp").agg(F.count("*").alias("n")).filter("n > 1")
    if not repeated.limit(1).count():
        return kept.drop(own)
    rank = free_name(docs, "rank")
    order = Window.partitionBy(doc_id, own).orderBy(F.xxhash64(F.to_json(F.struct(*docs.columns))))
    ranked = kept.withColumn(rank, F.row_number().over(order))
    return ranked.filter((F.col(rank) == 1) | F.col(doc_id).isNull()).drop(rank, own)


def simhash_components(docs: DataFrame) -> DataFrame:
    """Fingerprints of three-word shingles and their components within three bits."""
    found = near_duplicates(docs, size=3, radius=3)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
