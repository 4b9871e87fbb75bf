"""Approximate nearest neighbours with a forest of random-projection trees.

Trees are fitted on a bounded sample of vectors: a node splits its points at the median
of their projection on the line between two of them. Every vector is then sent down all
trees. A query searches the whole forest through one priority queue: of all branches
seen so far in any tree, that with the best margin is followed next, until a share of
all leaves is reached. The vectors of those leaves are ranked by their exact distance.

Equal vectors are one class: only its smallest ids can be among the nearest, and they
travel once. Leaves meet their queries in a shuffle by (leaf, chunk), where a chunk is a
hash part of a leaf that keeps a task's share bounded.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.llm.batches import small_batches
from logloom.session import materialize

Tree = tuple[np.ndarray, np.ndarray, np.ndarray]  # normals, thresholds, children (negative: leaf -1 - n)


def grow_tree(points: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    """Split until no node has more than ``leaf`` points, or its points cannot be split."""
    normals, limits, children = [], [], []
    leaves = 0

    def grow(index: np.ndarray) -> int:
        nonlocal leaves
        if len(index) > leaf:
            for _ in range(5):
                a, b = points[rng.choice(index, 2, replace=False)]
                normal = (a - b) / (np.linalg.norm(a - b) or 1.0)
                at = points[index] @ normal
                limit = float(np.median(at))
                left = at < limit
                if 0 < left.sum() < len(index):
                    node = len(normals)
                    normals.append(normal)
                    limits.append(limit)
                    children.append([0, 0])
                    children[node] = [grow(index[left]), grow(index[~left])]
                    return node
        leaves += 1
        return -leaves

    root = grow(np.arange(len(points)))
    width = points.shape[1]
    if root < 0:  # a single leaf: a split with nothing on its left
        return np.zeros((1, width)), np.full(1, -1.0), np.array([[root, root]])
    return np.array(normals), np.array(limits), np.array(children)


def leaves_of(tree: Tree, points: np.ndarray) -> np.ndarray:
    """Leaf of every point."""
    normals, limits, children = tree
    at = np.zeros(len(points), dtype=np.int64)
    open_ = np.arange(len(points))
    while len(open_):
        node = at[open_]
        side = (np.einsum("ij,ij->i", points[open_], normals[node]) >= limits[node]).astype(np.int64)
        at[open_] = children[node, side]
        open_ = open_[at[open_] >= 0]
    return -1 - at


def search(forest: list[Tree], point: np.ndarray, visits: int) -> list[tuple[int, int]]:
    """(tree, leaf) of the ``visits`` best leaves of the whole forest."""
    queue = [(-np.inf, t, 0) for t in range(len(forest))]
    found: list[tuple[int, int]] = []
    seen = set()
    while queue and len(found) < visits:
        bound, t, node = heapq.heappop(queue)
        if node < 0:
            if (t, node) not in seen:
                seen.add((t, node))
                found.append((t, -1 - node))
            continue
        normals, limits, children = forest[t]
        margin = float(normals[node] @ point - limits[node])
        for side, distance in ((0, margin), (1, -margin)):
            heapq.heappush(queue, (max(bound, distance), t, int(children[node, side])))
    return found


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v) of the vectors with id and components, all of them finite and not all zero."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v")).filter("id is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(finite & F.exists("v", lambda x: x != 0))


def commonest_length(rows: DataFrame) -> int:
    """Length of most vectors, the smaller of equally common ones; 0 if there are none."""
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    return lengths[0]["n"] if lengths else 0


def _classes(rows: DataFrame, keep: int) -> DataFrame:
    """(id, v, c): the ``keep`` smallest ids of each vector, and the smallest of all as the class."""
    salt = F.pmod(F.xxhash64("id"), F.lit(16))
    for keys in ([F.col("v"), salt], [F.col("v")]):  # a hot vector is thinned out in parts first
        order = Window.partitionBy(*keys).orderBy("id")
        rows = rows.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= keep).drop("r")
    return rows.withColumn("c", F.min("id").over(Window.partitionBy("v")))


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack(values.to_numpy()).astype(np.float64)


def _send_down(forest):
    """(c, v) -> one row per tree."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                points = _matrix(batch["v"])
                for t, tree in enumerate(forest.value):
                    yield pd.DataFrame({"tree": t, "leaf": leaves_of(tree, points), "c": batch["c"], "v": batch["v"]})

    return run


def _visit(forest, visits: int):
    """(q, v) -> one row per leaf to look into."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (t, leaf, q, v)
                for q, v in zip(batch["q"], batch["v"], strict=True)
                for t, leaf in search(forest.value, np.asarray(v, dtype=np.float64), visits)
            ]
            if rows:
                yield pd.DataFrame(rows, columns=["tree", "leaf", "q", "v"])

    return run


def _rank(k: int):
    """Exact distances of a leaf's queries to its vectors; the nearest ``k`` classes of each query."""

    def run(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(members) and len(queries):
            members = members.sort_values("c")
            points, ids = _matrix(members["v"]), members["c"].to_numpy()
            for q, v in zip(queries["q"], queries["v"], strict=True):
                far = np.sqrt(((points - np.asarray(v, dtype=np.float64)) ** 2).sum(axis=1))
                near = np.argsort(far, kind="stable")[:k]
                out += zip([q] * len(near), ids[near].tolist(), far[near].tolist(), strict=True)
        return pd.DataFrame(out, columns=["q", "c", "score"])

    return run


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    trees: int = 3,
    leaf: int = 1_000,
    share: float = 0.4,
    sample_rows: int = 50_000,
    chunk: int = 20_000,
    seed: int = 11,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found to each query row, its own id left out.

    Euclidean distance in double precision on the original components; ties go to the
    smaller id. Vectors that are null, empty, zero, hold a null, a NaN or an infinity, or
    differ from the commonest length of ``vectors`` take no part, neither do rows without id. Repeated
    ids are rows of their own, but none of them is its own neighbour. Fewer than ``k``
    others: all of them. Empty tables give no rows. The forest is fitted on at most
    about ``sample_rows`` vectors; all are indexed. ``share`` of all leaves is searched:
    vectors without any structure need nearly half of them for a recall over 0.9.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = usable(vectors, vec_id, vector)
    fits = F.size("v") == commonest_length(rows)
    members = materialize(_classes(rows.filter(fits), k + 1))
    heads = members.filter("id = c").select("c", "v").dropDuplicates(["c"])
    total = heads.count()
    wanted = usable(queries, vec_id, vector).filter(fits)
    asked = materialize(wanted.select(F.col("id").alias("query_id"), F.min("id").over(Window.partitionBy("v")).alias("q"), "v"))
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    part = heads if total <= sample_rows else heads.sample(sample_rows / total, seed)
    sample = np.array([r["v"] for r in part.select("v").toLocalIterator()], dtype=np.float64)
    rng = np.random.default_rng(seed)
    size = max(2, round(leaf * len(sample) / total))
    grown = [grow_tree(sample, size, rng) for _ in range(trees)]
    forest = spark.sparkContext.broadcast(grown)
    visits = max(trees, round(share * sum(tree[2][tree[2] < 0].size for tree in grown)))
    chunks = max(1, -(-total * size // (max(1, len(sample)) * chunk)))

    shape = vectors.select(F.col(vector)).schema[0].dataType.simpleString()
    down = heads.mapInPandas(_send_down(forest), f"tree int, leaf long, c long, v {shape}")
    down = down.withColumn("part", F.pmod(F.xxhash64("c"), F.lit(chunks)).cast("int"))
    to_ask = asked.filter("query_id = q").dropDuplicates(["q"]).select("q", "v")
    visited = to_ask.mapInPandas(_visit(forest, visits), f"tree int, leaf long, q long, v {shape}")
    visited = visited.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    keys = ["tree", "leaf", "part"]
    ranked = down.groupBy(*keys).cogroup(visited.groupBy(*keys)).applyInPandas(_rank(k + 1), "q long, c long, score double")

    best = Window.partitionBy("q").orderBy("score", "c")
    found = ranked.groupBy("q", "c").agg(F.min("score").alias("score"))
    found = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).drop("r")
    pairs = asked.select("query_id", "q").distinct().join(found, "q").join(members.select("id", "c"), "c").filter("id <> query_id")
    order = Window.partitionBy("query_id").orderBy("score", "id")
    return (
        pairs.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )


def neighbours(embeddings: DataFrame) -> DataFrame:
    """The ten nearest of every hundredth vector."""
    return nearest(embeddings, embeddings.filter(F.col("vec_id") % 100 == 0))
