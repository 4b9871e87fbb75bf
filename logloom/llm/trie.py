"""Prefix trie of conversations by truncation peeling.

The deepest turns are peeled first. Conversations that end in the stretch of depths at
hand join the nodes that survive from below it; the stretch is walked to its top, equal
prefixes fall together there, and what is known of each subtree goes up as one row. A
stretch reaches from one power of two to the next, so a conversation of n turns takes
about log2 n rounds, and every turn of every distinct conversation is read once.

A prefix is named by a digest that adds up over its turns (each hashed with its place), so
prefixes come from running sums and not from arrays of turns: a conversation may hold a
third of all rows. Equal conversations are one row from the start.

Within a stretch no level waits for the next. The smallest member of a node is also the
smallest of the node below it on its own path, so every node belongs to one path, its
owner's, and the sum over a subtree is the sum of what its members' paths own below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.operators.ranking import running
from logloom.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
PARTS = [f"h{i}" for i in range(4)]
# A stretch of at most so many depths is summed by a window; a longer one by range-partitioned running sums.
WINDOW_DEPTHS = 1024


def ordered_turns(table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, place, digest, words`` of every turn: its place from 1, the digest of role and text, the words of its text.

    Turns follow their number, null first; equal numbers follow role, the first 40 characters of the text and the
    digest. Null roles and texts are empty. Rows without a conversation are left out.
    """
    role, text = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    turns = table.filter(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        role.alias("role"),
        F.substring(text, 1, 40).alias("head"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    placed = running(turns, ["conv"], ["turn", "role", "head", "digest"], rank="place")
    return placed.select("conv", "place", "digest", "words")


def _key(depth: Column, parts: list[Column]) -> Column:
    """Name of a prefix: its depth and the sums over its turns."""
    return F.unhex(F.substring(F.sha2(F.concat_ws(",", depth, *parts), 256), 1, 32))


def prefix_paths(turns: DataFrame) -> DataFrame:
    """``conv, depth, key, parent, words``: the prefixes of every conversation but the empty one."""
    hashed = F.sha2(F.concat(F.col("place").cast("string"), F.lit(":"), F.hex("digest")), 256)
    rows = turns.withColumn("_h", hashed).select(
        "conv", "place", "words", *[F.conv(F.substring("_h", 8 * i + 1, 8), 16, 10).cast("long").alias(f"p{i}") for i in range(4)]
    )
    summed = running(rows, ["conv"], ["place"], {h: f"p{i}" for i, h in enumerate(PARTS)}, rank="depth")
    return summed.select(
        "conv",
        "depth",
        _key(F.col("depth"), [F.col(h) for h in PARTS]).alias("key"),
        _key(F.col("depth") - 1, [F.col(h) - F.col(f"p{i}") for i, h in enumerate(PARTS)]).alias("parent"),
        "words",
    )


def _join_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stretches of a key's sorted ids as one text each, so that no later task sees single ids."""
    for batch in batches:
        held = batch.groupby("key", sort=False)["conv"]
        yield pd.DataFrame(
            {"key": held.first().index, "first": held.first().to_numpy(), "ids": held.agg(lambda c: ",".join(map(str, c))).to_numpy()}
        )


def _hash_stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of a key's stretches in order; only the hash in progress is held."""
    key, state = None, None
    for batch in batches:
        done = []
        for own, ids in zip(batch["key"], batch["ids"], strict=True):
            if own != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pd.DataFrame(done, columns=["key", "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "ends_sha256"])


def _end_digests(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of the conversations that end at each key."""
    sorted_ids = ends.select("key", "conv").repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
    stretches = sorted_ids.mapInPandas(_join_ids, f"key binary, first {ends.schema['conv'].dataType.simpleString()}, ids string")
    by_key = stretches.repartition("key").sortWithinPartitions("key", "first")
    return by_key.mapInPandas(_hash_stretches, "key binary, ends_sha256 string")


def _owned(rows: DataFrame, long: bool) -> DataFrame:
    """Rows with ``below``: what their item owns from their depth on."""
    if long:
        return running(rows, ["item"], ["-depth"], {"below": "own"}, rank="_rank").drop("_rank")
    deeper = Window.partitionBy("item").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("below", F.sum("own").over(deeper))


def _peel(items: DataFrame, paths: DataFrame, low: int, high: int) -> DataFrame:
    """Nodes of the depths over ``low`` up to ``high``.

    ``items`` (item, end, whole, n, leaves, saved): conversations that end there and subtrees that hang
    below ``high``, each with the path of its smallest member.
    """
    steps = paths.join(items, F.col("conv") == F.col("item")).filter("depth <= end").drop("conv")
    steps = materialize(steps)
    # what all members agree on, and the path that owns the node
    found = steps.groupBy("depth", "key").agg(F.min("item").alias("owner"), F.sum("n").alias("n_convs"), F.count(F.lit(1)).alias("_items"))
    marked = steps.join(found, ["depth", "key"])
    # a conversation that meets nothing at its own end is a leaf
    leaf = F.col("whole") & (F.col("depth") == F.col("end")) & (F.col("_items") == 1)
    cost = F.when(F.col("item") == F.col("owner"), (F.col("n_convs") - 1) * F.col("words")).otherwise(F.lit(0).cast("long"))
    own = marked.select(
        "depth", "key", "parent", "words", "item", "owner", "n_convs", "saved", "leaves", "whole",
        cost.alias("own"), leaf.cast("long").alias("_leaf"),
    )
    summed = _owned(own, high - low > WINDOW_DEPTHS)
    # the leaf mark of an item's end holds for its whole path: of a whole item, leaves is 0 so far
    marks = own.filter("_leaf = 1").select(F.col("item").alias("_at"), F.lit(1).cast("long").alias("_is"))
    told = summed.join(marks, F.col("item") == F.col("_at"), "left")
    return told.groupBy("depth", "key").agg(
        F.first("parent").alias("parent"),
        F.first("owner").alias("conv_id"),
        F.first("n_convs").alias("n_convs"),
        F.sum(F.col("leaves") + F.coalesce("_is", F.lit(0).cast("long"))).alias("n_leaves"),
        F.sum(F.col("saved") + F.col("below")).alias("saved_tokens"),
    )


def prefix_trie(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """All nodes of the trie: distinct sequences of first turns, from the empty one on.

    ``conversations`` has one row per conversation (``conv``, ``length``), also those without turns; ``turns``
    (``conv``, ``place``, ``digest``, ``words``) numbers their turns without gaps from 1. Per node: ``conv_id`` its smallest
    member, ``depth``, ``parent_conv_id`` (root: null), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes
    of its subtree, itself included), ``saved_tokens`` (sum over its subtree of (n_convs - 1) times the words of the
    node's last turn) and ``ends_sha256`` (SHA-256 of the ascending, comma-joined ids that end here). Repeated
    conversations count each; without conversations there is no node.
    """
    paths = materialize(prefix_paths(turns))
    root = _key(F.lit(0), [F.lit(0)] * 4)
    last = paths.select(F.col("conv").alias("_conv"), F.col("depth").alias("_depth"), "key")
    ends = conversations.select("conv", "length").join(
        last, (F.col("conv") == F.col("_conv")) & (F.col("length") == F.col("_depth")), "left"
    )
    ends = materialize(ends.select("conv", "length", F.coalesce("key", root).alias("key")))
    classes = materialize(
        ends.groupBy("key", "length").agg(F.min("conv").alias("item"), F.count(F.lit(1)).alias("n"))
        .select("item", F.col("length").alias("end"), F.lit(True).alias("whole"), "n",
                F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    )
    deepest = classes.agg(F.max("end")).first()[0] or 0
    # only the paths of the smallest of equal conversations are walked, each depth in its own stretch
    kept = paths.join(classes.select("item"), F.col("conv") == F.col("item"), "left_semi")
    stretches = max(0, (deepest - 1).bit_length()) if deepest else -1
    survivors, peeled = None, []
    for i in range(stretches, -1, -1):
        low, high = (1 << i) // 2 if i else 0, 1 << i
        items = classes.filter(f"end > {low} and end <= {high}")
        if survivors is not None:
            items = items.unionByName(survivors.withColumn("end", F.lit(high).cast("long")))
        nodes = materialize(_peel(items, kept.filter((F.col("depth") > low) & (F.col("depth") <= high)), low, high))
        peeled.append(nodes)
        survivors = _merged(nodes.filter(f"depth = {low + 1}"))
    return _described(peeled, classes.filter("end = 0"), survivors, root, ends)


def _merged(nodes: DataFrame) -> DataFrame:
    """The last turn stripped and equal prefixes put together: one item per parent."""
    return nodes.groupBy("parent").agg(
        F.min("conv_id").alias("item"),
        F.sum("n_convs").alias("n"),
        F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"),
    ).select("item", F.lit(False).alias("whole"), "n", "leaves", "saved")


def _described(peeled: list[DataFrame], turnless: DataFrame, top: DataFrame | None, root: Column, ends: DataFrame) -> DataFrame:
    """The root beside the peeled nodes, and what a node needs from its parent, children and ends."""
    tops = turnless.drop("end") if top is None else turnless.drop("end").unionByName(top)
    leaf = (F.count(F.lit(1)) == 1) & F.max("whole")
    first = tops.agg(
        F.min("item").alias("conv_id"),
        F.sum("n").alias("n_convs"),
        F.when(leaf, F.lit(1).cast("long")).otherwise(F.sum("leaves")).alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
    ).filter("conv_id is not null")
    nodes = first.select(F.lit(0).cast("long").alias("depth"), root.alias("key"), F.lit(None).cast("binary").alias("parent"), *first.columns)
    for part in peeled:
        nodes = nodes.unionByName(part)
    nodes = materialize(nodes)
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    full = nodes.join(children, "key", "left").join(_end_digests(ends), "key", "left").join(above, "parent", "left")
    return full.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def rebuilt(table: DataFrame, group: int = 20, shares: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations and turns after each conversation c took over the beginning of c - c % ``group``.

    The first h = crc32(c) % ``shares`` turns of that conversation (all if it has fewer, none if it is absent) stand
    before c's own turns after its first h. A beginning goes to fewer than 2 * ``group`` conversations, so nothing fans out.
    """
    turns = materialize(ordered_turns(table))
    share = F.crc32(F.col("conv").cast("string").cast("binary")) % shares
    own = turns.groupBy("conv").agg(F.max("place").alias("n"))
    sized = own.select("conv", "n", share.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"))
    bases = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    heads = materialize(
        sized.join(bases, "base", "left").select(
            "conv", "n", "h", "base", F.least("h", F.coalesce("base_n", F.lit(0).cast("long"))).alias("taken")
        )
    )
    conversations = heads.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("length"))
    first = turns.filter(F.col("place") < shares).select(F.col("conv").alias("base"), "place", "digest", "words")
    borrowed = heads.select("conv", "base", "taken").join(first, "base").filter("place <= taken").select("conv", "place", "digest", "words")
    kept = turns.join(heads.select("conv", "h", "taken"), "conv").filter("place > h")
    moved = kept.select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "digest", "words")
    return conversations, borrowed.unionByName(moved)


def conversation_trie(table: DataFrame) -> DataFrame:
    """Nodes of the trie of the rebuilt conversations."""
    return prefix_trie(*rebuilt(table))
