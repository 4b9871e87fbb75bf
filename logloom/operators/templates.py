"""Log templates: masked-line counts, and greedy clustering of the masked lines.

Clustering compares a line with the clusters found so far and is therefore
ordered by nature. Two facts make it a distributed job with the exact result:

* Once a line was seen, some cluster covers its masked form completely, so only
  the *first* line of every distinct masked form can create or widen a cluster.
  Everything else is counting.
* A cluster only ever widens. A form that a cluster covers now is covered for
  good, so all such forms can be dropped from the ordered part at once.

What is left is a sequence, taken in blocks per token count. An inverted index of the
clusters, a table of (place, token), tells for every form of a block which cluster fits it
best as the block begins, by an equi-join and a count. Clusters only gain hits, so during
the block that one can only be beaten by clusters the block itself has changed. The ordered
step therefore holds a block and the clusters its forms point at, never all clusters.

Which forms a cluster covers is a join too, on the cluster's rarest token. Counting is the
usual partial aggregation.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.functions.mask import has_words, mask_tokens
from logloom.functions.predicates import field
from logloom.operators.ranking import running
from logloom.session import materialize, small_enough
from logloom.sources.lines import trimmed

# Share of equal positions that joins a cluster, and the wildcard.
SIMILARITY = 0.5
WILDCARD = "<*>"

# Forms of one token count that an ordered step looks at: first, and at most.
FIRST_BLOCK = 1_000
LARGEST_BLOCK = 8_000


def log_line(df: DataFrame) -> Column:
    """``raw``, else the ``message`` field."""
    raw = F.col("raw") if "raw" in df.columns else F.lit(None).cast("string")
    message = field("message") if "attrs" in df.columns else F.lit(None).cast("string")
    return F.coalesce(F.when(raw != "", raw), message)


def template_counts(df: DataFrame, line: str, order: list[str]) -> DataFrame:
    """``template, count, example`` per masked line; the example is the first in ``order``."""
    return _forms(df, line, order).select(
        F.array_join("tokens", " ").alias("template"), "count", "example"
    )


def _forms(df: DataFrame, line: str, order: list[str]) -> DataFrame:
    # blank lines go before the masking, which a test on its result would run twice
    masked = df.filter(has_words(line)).select(
        mask_tokens(line).alias("tokens"), F.struct(*order).alias("seen"), trimmed(F.col(line)).alias("line")
    )
    return (
        masked.groupBy("tokens")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.min("seen").alias("first"),
            F.min_by("line", "seen").alias("example"),
        )
    )


class _Changed:
    """The clusters of one token count that a block has changed so far, as rows of token codes; 0 is the wildcard."""

    def __init__(self, arity: int):
        self.codes = {WILDCARD: 0}
        self.names = [WILDCARD]
        self.matrix = np.empty((16, arity), dtype=np.int64)
        self.ids = np.empty(16, dtype=np.int64)
        self.at: dict[int, int] = {}

    def encode(self, tokens) -> np.ndarray:
        row = np.empty(self.matrix.shape[1], dtype=np.int64)
        for i, token in enumerate(tokens):
            code = self.codes.get(token)
            if code is None:
                code = self.codes[token] = len(self.names)
                self.names.append(token)
            row[i] = code
        return row

    def add(self, cluster: int, row: np.ndarray) -> None:
        n = len(self.at)
        if n == len(self.matrix):
            self.matrix = np.concatenate([self.matrix, np.empty_like(self.matrix)])
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.matrix[n], self.ids[n], self.at[cluster] = row, cluster, n

    def best(self, row: np.ndarray) -> tuple[int, int]:
        """Hits of the cluster that fits best, and the oldest such cluster."""
        n = len(self.at)
        if not n:
            return -1, -1
        hits = ((self.matrix[:n] == row) | (self.matrix[:n] == 0)).sum(axis=1)
        most = int(hits.max())
        return most, int(self.ids[:n][hits == most].min())

    def widen(self, cluster: int, row: np.ndarray) -> None:
        held = self.matrix[self.at[cluster]]
        held[held != row] = 0

    def tokens(self, cluster: int) -> list[str]:
        return [self.names[code] for code in self.matrix[self.at[cluster]]]


def _advance(similarity: float):
    """Feed a block of forms, in order, to the clusters of one token count; emit what changed.

    ``block`` has position, tokens, the cluster that fitted best before the block with its hits (null below
    the similarity), and the number of clusters until then; ``fitting`` the tokens of those clusters.
    """

    def step(key, block: pd.DataFrame, fitting: pd.DataFrame) -> pd.DataFrame:
        arity = int(key[0])
        changed, out = _Changed(arity), []
        older = dict(zip(fitting["cluster"], fitting["tokens"], strict=True))
        block = block.sort_values("position")
        following = int(block["held"].iloc[0]) if len(block) else 0
        for tokens, position, own, own_hits in zip(block["tokens"], block["position"], block["cluster"], block["hits"], strict=True):
            row = changed.encode(tokens)
            hits, cluster = changed.best(row)
            if not pd.isna(own) and int(own) not in changed.at and (-int(own_hits), int(own)) < (-hits, cluster):
                hits, cluster = int(own_hits), int(own)
            if cluster < 0 or hits < similarity * arity:
                cluster, following = following, following + 1
                changed.add(cluster, row)
            elif hits < arity:
                if cluster not in changed.at:
                    changed.add(cluster, changed.encode(older[cluster]))
                changed.widen(cluster, row)
            else:
                continue
            out.append((arity, cluster, changed.tokens(cluster), int(position)))
        return pd.DataFrame(out, columns=["arity", "cluster", "tokens", "since"])

    return step


def _places(df: DataFrame, *keep: str) -> DataFrame:
    """One row per token, with its place."""
    return df.select(*keep, F.posexplode("tokens").alias("place", "token"))


def _fixed(clusters: DataFrame, *keep: str) -> DataFrame:
    return _places(clusters, *keep).filter(F.col("token") != WILDCARD)


def _best_fitting(turn: DataFrame, state: DataFrame, similarity: float) -> DataFrame:
    """``arity, position, cluster, hits``: the oldest cluster with the most hits, if they reach the similarity.

    Hits are equal tokens, counted by a join on (place, token), and the cluster's wildcards. Of the
    clusters that share no token with a form only the one with the most wildcards can be its best.
    """
    wild = F.size(F.filter("tokens", lambda t: t == WILDCARD)).alias("wild")
    sized = state.select("arity", "cluster", wild, "tokens")
    index = _fixed(sized, "arity", "cluster", "wild")
    met = _places(turn, "arity", "position").join(index, ["arity", "place", "token"])
    shared = met.groupBy("arity", "position", "cluster").agg((F.count(F.lit(1)) + F.first("wild")).alias("hits"))
    widest = sized.groupBy("arity").agg(F.min(F.struct((-F.col("wild")).alias("w"), "cluster")).alias("c"))
    apart = turn.select("arity", "position").join(widest, "arity").select(
        "arity", "position", F.col("c.cluster").alias("cluster"), (-F.col("c.w")).cast("bigint").alias("hits")
    )
    either = shared.unionByName(apart).filter(F.col("hits") >= similarity * F.col("arity"))
    best = either.groupBy("arity", "position").agg(F.min(F.struct((-F.col("hits")).alias("h"), "cluster")).alias("b"))
    return best.select("arity", "position", F.col("b.cluster").alias("cluster"), (-F.col("b.h")).alias("hits"))


def _covered(forms: DataFrame, clusters: DataFrame, often: DataFrame) -> DataFrame:
    """``arity, position, cluster, since`` of all forms and cluster versions where every place is equal or a wildcard.

    They meet on the version's rarest token (``often`` counts the forms by place and token).
    """
    keys = ["arity", "cluster", "since"]
    rarest = _fixed(clusters, *keys).join(often, ["arity", "place", "token"]).groupBy(*keys).agg(
        F.min(F.struct("n", "place", "token")).alias("a")
    )
    anchored = clusters.join(rarest, keys).select(*keys, F.col("tokens").alias("held"), "a.place", "a.token")
    met = _places(forms, "arity", "position", "tokens").join(anchored, ["arity", "place", "token"])
    equal = F.forall(F.arrays_zip("held", "tokens"), lambda t: (t["held"] == WILDCARD) | (t["held"] == t["tokens"]))
    # a version of wildcards only, of which a token count has one at most, covers all its forms
    all_wild = clusters.filter(F.forall("tokens", lambda t: t == WILDCARD)).select(*keys)
    anything = forms.select("arity", "position").join(all_wild, "arity")
    columns = ["arity", "position", "cluster", "since"]
    return met.filter(equal).select(*columns).unionByName(anything.select(*columns))


def _cluster_versions(forms: DataFrame, often: DataFrame, similarity: float) -> DataFrame:
    """Every state a cluster goes through, with the position of the form that caused it."""
    schema = "arity int, cluster bigint, tokens array<string>, since bigint"
    versions = forms.sparkSession.createDataFrame([], schema)
    pending = forms.select("arity", "position", "tokens")
    block = FIRST_BLOCK
    while True:
        start = pending.groupBy("arity").agg(F.min("position").alias("_start"))
        placed = pending.join(F.broadcast(start), "arity") if small_enough(start) else pending.join(start, "arity")
        inside = F.col("position") < F.col("_start") + block
        turn = materialize(placed.filter(inside).select("arity", "position", "tokens"))
        # the newest version of a cluster is its state
        state = versions.groupBy("arity", "cluster").agg(F.max_by("tokens", "since").alias("tokens"))
        best = materialize(_best_fitting(turn, state, similarity))
        held = state.groupBy("arity").agg(F.count(F.lit(1)).alias("held"))
        told = turn.join(best, ["arity", "position"], "left").join(held, "arity", "left").withColumn("held", F.coalesce("held", F.lit(0)))
        fitting = state.join(best.select("arity", "cluster").distinct(), ["arity", "cluster"])
        changed = materialize(
            told.groupBy("arity").cogroup(fitting.groupBy("arity")).applyInPandas(_advance(similarity), schema)
        )
        versions = versions.unionByName(changed)
        rest = placed.filter(~inside).select("arity", "position", "tokens")
        if rest.isEmpty():
            return materialize(versions)
        newest = changed.groupBy("arity", "cluster").agg(F.max_by("tokens", "since").alias("tokens"), F.max("since").alias("since"))
        gone = _covered(rest, newest, often).select("arity", "position").distinct()
        pending = materialize(rest.join(gone, ["arity", "position"], "left_anti"))
        if pending.isEmpty():
            return materialize(versions)
        block = min(block * 2, LARGEST_BLOCK)


def _memberships(forms: DataFrame, versions: DataFrame, often: DataFrame) -> DataFrame:
    """``arity, position, since, cluster``: where the lines of a form go, first (``since`` NULL) and after a takeover.

    A line goes to the oldest of the clusters that cover its form by then.
    """
    covers = _covered(forms, versions, often).groupBy("arity", "position", "cluster").agg(F.min("since").alias("since"))
    late = F.when(F.col("since") > F.col("position"), F.col("since"))
    before = Window.partitionBy("arity", "position").orderBy("since", "cluster").rowsBetween(Window.unboundedPreceding, -1)
    ranked = covers.select("arity", "position", "cluster", late.alias("since"), F.min("cluster").over(before).alias("_older"))
    first = ranked.filter("since is null").groupBy("arity", "position").agg(F.min("cluster").alias("cluster"))
    taken = ranked.filter("since is not null and cluster < _older")
    return first.select("arity", "position", F.lit(None).cast("bigint").alias("since"), "cluster").unionByName(
        taken.select("arity", "position", "since", "cluster")
    )


def template_clusters(
    df: DataFrame, line: str, order: list[str], similarity: float = SIMILARITY
) -> DataFrame:
    """``template, count, example`` of greedy clusters, as if lines came one by one in ``order``.

    A line joins the cluster of the same token count with the most equal or
    wildcard positions (the older one on ties) if that is at least
    ``similarity`` of them, and differing positions become wildcards; else it
    starts a cluster. ``order`` must be unique per line.
    """
    grouped = materialize(_forms(df, line, order).withColumn("arity", F.size("tokens")))
    # one token can only equal or differ: its clusters are the forms themselves
    literal_wildcard = (F.col("arity") == 1) & (F.col("tokens")[0] == WILDCARD)
    simple = None
    if similarity > 0 and grouped.filter(literal_wildcard).isEmpty():
        single, grouped = grouped.filter("arity = 1"), grouped.filter("arity > 1")
        simple = single.select(F.col("tokens")[0].alias("template"), "count", "example")
    forms = materialize(running(grouped, ["arity"], ["first"], rank="position"))
    keyed = forms.select("arity", "position", "tokens")
    often = materialize(_places(keyed, "arity").groupBy("arity", "place", "token").agg(F.count(F.lit(1)).alias("n")))
    versions = _cluster_versions(keyed, often, similarity)
    steps = materialize(_memberships(keyed, versions, often))
    taken = steps.filter("since is not null")
    moved = taken.select("arity", "position").distinct()
    settled = (
        steps.join(moved, ["arity", "position"], "left_anti")
        .join(forms, ["arity", "position"])
        .groupBy("arity", "cluster")
        .agg(F.sum("count").alias("count"))
    )
    if not taken.isEmpty():
        settled = settled.unionByName(_moved_counts(df, line, order, forms, steps, moved))
    counts = settled.groupBy("arity", "cluster").agg(F.sum("count").alias("count"))
    shown = versions.groupBy("arity", "cluster").agg(
        F.max_by("tokens", "since").alias("tokens"), F.min("since").alias("position")
    )
    clusters = (
        shown.join(counts, ["arity", "cluster"])
        .join(forms.select("arity", "position", "example"), ["arity", "position"])
        .select(F.array_join("tokens", " ").alias("template"), "count", "example")
    )
    return clusters if simple is None else clusters.unionByName(simple)


def _moved_counts(
    df: DataFrame, line: str, order: list[str], forms: DataFrame, steps: DataFrame, moved: DataFrame
) -> DataFrame:
    """Lines per cluster for the forms that change cluster over time, by the time of each line."""
    times = forms.select("arity", F.col("position").alias("since"), F.col("first").alias("_at"))
    timed = (
        steps.join(moved, ["arity", "position"], "left_semi")
        .join(times, ["arity", "since"], "left")
        .groupBy("arity", "position")
        .agg(F.array_sort(F.collect_list(F.struct("_at", "cluster"))).alias("_steps"))
        .join(forms.select("arity", "position", "tokens"), ["arity", "position"])
        .select("arity", "tokens", "_steps")
    )
    rows = df.filter(has_words(line)).select(
        mask_tokens(line).alias("tokens"), F.struct(*order).alias("_seen")
    )
    hit = rows.join(timed, "tokens")
    reached = F.filter("_steps", lambda s: s["_at"].isNull() | (s["_at"] < F.col("_seen")))
    # nulls sort first, so the last step reached is the one in force
    cluster = F.element_at(reached, -1)["cluster"]
    return hit.groupBy("arity", cluster.alias("cluster")).agg(F.count(F.lit(1)).alias("count"))
