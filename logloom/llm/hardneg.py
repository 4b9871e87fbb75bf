"""Hard negatives by anchor-clustered shared lists.

Anchors with like directions form a cluster. A cluster's candidates are sorted once by an
upper bound of what any member can score with them: the candidate's length times the cosine
of its angle to the cluster's centre less the cluster's widest angle. Every member walks that
list and leaves it when the bound, times its own length, is under the worst of the rows it
holds: nothing after that can be among its first. What a walk returns is therefore exact.

Candidates lie in shards and anchors in waves of bounded size; each shard has its own lists,
and a shard's first rows of an anchor go on to a ranking across shards. The first walk finds
the positives, whose scores bound the window that the second walk looks for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.llm.batches import small_batches
from logloom.session import materialize

# Products of whole numbers below this are exact as doubles, whatever the order of the sum.
EXACT = float(1 << 53)
STRIDE = 1024


def whole_numbers(vectors: pd.Series, scale: float) -> np.ndarray:
    """floor(scale * x) of every component, as doubles that hold whole numbers."""
    return np.floor(np.stack([np.asarray(v, dtype=np.float64) for v in vectors]) * scale)


def inner(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; a product over 64 bits raises an error."""
    width = anchors.shape[1]
    bound = np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0) * width
    if bound < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    if bound >= float(1 << 63):
        raise ValueError("scores of these vectors can exceed 64 bits")
    return anchors.astype(np.int64) @ rows.astype(np.int64).T


def cluster(vectors: np.ndarray, wanted: int, rounds: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(number of its cluster per vector, centres of length one): k-means on directions, repeatable."""
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    units = vectors / np.where(length > 0, length, 1)
    distinct = np.unique(units, axis=0)
    centres = distinct[np.linspace(0, len(distinct) - 1, min(wanted, len(distinct))).astype(int)]
    for _ in range(rounds):
        own = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, units)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-12, sums / np.where(size > 1e-12, size, 1), centres)
    return (units @ centres.T).argmax(axis=1), centres


def shared_list(centre: np.ndarray, members: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds in that order): no member scores more with a row than its own length times the bound."""

    def angles(vectors: np.ndarray, length: np.ndarray) -> np.ndarray:
        cosine = np.where(length > 0, vectors @ centre / np.where(length > 0, length, 1), 1.0)
        return np.arccos(np.clip(cosine, -1, 1))

    length = np.linalg.norm(rows, axis=1)
    widest = angles(members, np.linalg.norm(members, axis=1)).max()
    # the small term covers the rounding of the angles
    bounds = length * np.cos(np.maximum(0, angles(rows, length) - widest - 1e-6))
    order = np.argsort(-bounds, kind="stable")
    return order, bounds[order]


class Best:
    """The first ``keep`` (score descending, id ascending) rows of each of ``n`` seekers."""

    def __init__(self, n: int, keep: int):
        self.keep = keep
        self.seeker = np.array([], dtype=np.int64)
        self.score, self.id = self.seeker, self.seeker
        self.worst = np.full(n, np.iinfo(np.int64).min)

    def add(self, seeker: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        held = score >= self.worst[seeker]
        seeker = np.concatenate([self.seeker, seeker[held]])
        score = np.concatenate([self.score, score[held]])
        ids = np.concatenate([self.id, ids[held]])
        order = np.lexsort((ids, -score, seeker))
        seeker, score, ids = seeker[order], score[order], ids[order]
        starts = np.searchsorted(seeker, seeker, side="left")
        first = np.arange(len(seeker)) - starts < self.keep
        self.seeker, self.score, self.id = seeker[first], score[first], ids[first]
        counts = np.bincount(self.seeker, minlength=len(self.worst))
        full = counts >= self.keep
        ends = np.searchsorted(self.seeker, np.flatnonzero(full), side="right") - 1
        self.worst[full] = self.score[ends]


def walk(anchors: np.ndarray, rows: np.ndarray, clusters: int, visit) -> int:
    """Every anchor walks its cluster's list. ``visit(members, rows, scores)`` takes a stride of it and returns
    the score under which each member has no use for a row. Returns the number of scores worked out."""
    done = 0
    own, centres = cluster(anchors, clusters)
    length = np.linalg.norm(anchors, axis=1)
    for number in np.unique(own):
        active = np.flatnonzero(own == number)
        order, bounds = shared_list(centres[number], anchors[active], rows)
        useful = np.full(len(active), -np.inf)
        for start in range(0, len(order), STRIDE):
            reach = length[active] * bounds[start]
            stay = reach + 1e-6 * (1 + np.abs(reach)) >= useful
            active, useful = active[stay], useful[stay]
            if not len(active):
                break
            part = order[start : start + STRIDE]
            useful = visit(active, part, inner(anchors[active], rows[part])).astype(np.float64)
            done += len(active) * len(part)
    return done


def _positives(scale: float, keep: int, clusters: int):
    def run(key, rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        columns = ["anchor", "positive_id", "positive_score"]
        if not len(rows) or not len(anchors):
            return pd.DataFrame(columns=columns)
        a, r = whole_numbers(anchors["vector"], scale), whole_numbers(rows["vector"], scale)
        row_ids, row_labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        ids, labels = anchors["id"].to_numpy(), anchors["label"].to_numpy()
        best = Best(len(anchors), keep)

        def visit(members: np.ndarray, part: np.ndarray, scores: np.ndarray) -> np.ndarray:
            fits = (labels[members][:, None] == row_labels[part]) & (ids[members][:, None] != row_ids[part])
            m, p = np.nonzero(fits)
            best.add(members[m], scores[m, p], row_ids[part[p]])
            return best.worst[members]

        walk(a, r, clusters, visit)
        return pd.DataFrame(dict(zip(columns, (anchors["anchor"].to_numpy()[best.seeker], best.id, best.score), strict=True)))

    return run


def _negatives(scale: float, keep: int, clusters: int, low: int, high: int):
    def run(key, rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        columns = ["anchor", "positive", "negative_id", "negative_score"]
        if not len(rows) or not len(anchors):
            return pd.DataFrame(columns=columns)
        a, r = whole_numbers(anchors["vector"], scale), whole_numbers(rows["vector"], scale)
        row_ids, row_labels, labels = rows["id"].to_numpy(), rows["label"].to_numpy(), anchors["label"].to_numpy()
        width = max(len(p) for p in anchors["positives"])
        goal = np.zeros((len(anchors), width), dtype=np.int64)
        sought = np.zeros((len(anchors), width), dtype=bool)
        for i, scores in enumerate(anchors["positives"]):
            goal[i, : len(scores)], sought[i, : len(scores)] = scores, True
        # the windows as whole scores: least and greatest that fit
        least, most = -((-low * goal) // 100), high * goal // 100
        best = Best(len(anchors) * width, keep)

        def visit(members: np.ndarray, part: np.ndarray, scores: np.ndarray) -> np.ndarray:
            other = labels[members][:, None] != row_labels[part]
            useful = np.full(len(members), np.inf)
            for i in range(width):
                fits = other & (scores >= least[members, i, None]) & (scores <= most[members, i, None]) & sought[members, i, None]
                m, p = np.nonzero(fits)
                best.add(members[m] * width + i, scores[m, p], row_ids[part[p]])
                still = np.maximum(least[members, i], best.worst[members * width + i])
                useful = np.minimum(useful, np.where(sought[members, i] & (least[members, i] <= most[members, i]), still, np.inf))
            return useful

        walk(a, r, clusters, visit)
        seeker = best.seeker
        found = (anchors["anchor"].to_numpy()[seeker // width], seeker % width, best.id, best.score)
        return pd.DataFrame(dict(zip(columns, found, strict=True)))

    return run


def _met(rows: DataFrame, anchors: DataFrame, work, schema: str, shards: int, waves: int) -> DataFrame:
    """Every shard of rows with every wave of anchors, vectors of one length at a time."""
    left = rows.select("width", "shard", F.explode(F.sequence(F.lit(0), F.lit(waves - 1))).alias("wave"), "id", "label", "vector")
    right = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    keys = ["width", "shard", "wave"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(work, schema)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: str,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    shard_rows: int = 2048,
    wave_rows: int = 8192,
    clusters: int = 32,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for every anchor and positive.

    Scores are inner products of floor(``scale`` * x); higher ones come first, ties by smaller id. An anchor (the SQL
    condition ``is_anchor``) has as positives its first ``positives`` rows of its own label, and for each of them as
    negatives the first ``negatives`` rows of other labels that score between ``low`` and ``high`` per cent of it. A
    positive without any has no row. Rows without id or label, null vectors and vectors with null or non-finite
    components take no part; empty and zero vectors score zero; only vectors of one length meet. Rows with the id of
    the anchor are not its positives; otherwise repeated rows count each. Other columns are not looked at.

    ``shard_rows`` and ``wave_rows`` bound what a task holds, ``clusters`` are per wave; they do not change results.
    """
    small_batches(vectors.sparkSession)
    sound = (
        f"`{vec_id}` is not null and `{label}` is not null and `{vector}` is not null and forall(`{vector}`, "
        "x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    )
    # shards and waves come from drawn numbers, so they are drawn once and stored
    drawn = materialize(
        vectors.filter(sound).select(
            F.col(vec_id).cast("long").alias("id"),
            F.col(label).cast("long").alias("label"),
            F.col(vector).alias("vector"),
            F.size(vector).alias("width"),
            F.expr(is_anchor).alias("asks"),
            F.monotonically_increasing_id().alias("anchor"),
            F.rand(17).alias("draw"),
        )
    )
    n, asking = drawn.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    shards, waves = max(1, -(-n // shard_rows)), max(1, -(-asking // wave_rows))
    rows = drawn.withColumn("shard", F.floor(F.col("draw") * shards).cast("int"))
    wave = F.pmod(F.xxhash64("anchor"), F.lit(waves)).cast("int").alias("wave")
    asked = materialize(drawn.filter("asks").select("width", wave, "anchor", "id", "label", "vector"))

    first = _met(rows, asked, _positives(scale, positives, clusters), "anchor long, positive_id long, positive_score long", shards, waves)
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    ranked = first.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    pairs = materialize(ranked.withColumn("positive", F.col("place") - 1).drop("place"))

    goals = pairs.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("positive", "positive_score"))).alias("_p"))
    bound = materialize(asked.join(goals, "anchor").withColumn("positives", F.col("_p.positive_score")).drop("_p"))
    found = _met(
        rows, bound, _negatives(scale, negatives, clusters, low, high),
        "anchor long, positive int, negative_id long, negative_score long", shards, waves,
    )
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("negative_score"), "negative_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    named = best.join(pairs, ["anchor", "positive"]).join(asked.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined_negatives(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh label is shifted first."""
    vec, label = F.col("vec_id"), F.col("label")
    shifted = embeddings.select("vec_id", "embedding", F.when(vec % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return hard_negatives(shifted, "vec_id % 100 = 0")
