"""Hard negatives against a full scan per anchor."""

import math
import random

import numpy as np
import pytest

from logloom.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, width int, positive_id int"


def brute(rows, scale=256, keep=5, negatives=10):
    usable = []
    for n, (i, v, label, *_) in enumerate(rows):
        if v is not None and label is not None and i is not None and all(x is not None and math.isfinite(x) for x in v):
            label = (label + 1) % 10 if i % 7 == 0 else label
            usable.append((i, label, [math.floor(scale * float(np.float32(x))) for x in v]))
    out = []
    for i, label, v in usable:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in usable if len(w) == len(v) and j != i)
        for s, j, _ in [x for x in scored if x[2] == label][:keep]:
            fits = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k, _) in enumerate(fits, 1)]
    return sorted(out)


def found(df, **kwargs):
    shifted = df.selectExpr("vec_id", "embedding", "case when vec_id % 7 = 0 then (label + 1) % 10 else label end label", "anchor", "width")
    return sorted(map(tuple, hardneg.hard_negatives(shifted, "vec_id % 100 = 0", **kwargs).collect()))


def vectors(n, width, labels=4, spread=0.4, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(5, width))
    return [
        (i, (centres[i % 5] + spread * draw.normal(size=width)).astype(np.float32).tolist(), int(draw.integers(labels)), "a", 1, 2)
        for i in range(n)
    ]


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 100, "wave_rows": 3, "clusters": 2}])
def test_equals_a_full_scan(spark, sizes):
    rows = vectors(900, 6)
    assert found(spark.createDataFrame(rows, SCHEMA), **sizes) == brute(rows)


def test_odd_rows(spark):
    rows = vectors(300, 4)
    rows += [(1_000, None, 1, "a", 1, 2), (1_100, [0.1, None, 0.2, 0.3], 1, "a", 1, 2), (1_200, [math.nan] * 4, 1, "a", 1, 2)]
    rows += [(1_300, [math.inf] * 4, 1, "a", 1, 2), (1_400, [0.5] * 4, None, "a", 1, 2), (1_500, [0.0] * 4, 1, "a", 1, 2)]
    rows += [(1_600, [], 1, "a", 1, 2), (1_601, [], 1, "a", 1, 2), (1_602, [], 2, "a", 1, 2)]
    rows += [(1_700 + i, [0.4, 0.3], i % 3, "a", 1, 2) for i in range(40)]  # another length, all tied
    rows += [(None, [0.5] * 4, 1, "a", 1, 2)]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_repeated_rows_count_each(spark):
    rows = vectors(200, 4)
    rows += rows[1:60]
    assert found(spark.createDataFrame(rows, SCHEMA), shard_rows=50) == brute(rows)


def test_a_third_of_all_rows_is_one_vector(spark):
    rows = vectors(400, 4)
    rows += [(2_000 + i, rows[3][1], 2, "a", 1, 2) for i in range(250)]
    assert found(spark.createDataFrame(rows, SCHEMA), shard_rows=64) == brute(rows)


def test_nothing_to_do(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, [0.1], 1, "a", 1, 2)], SCHEMA)) == []


def test_lists_end_early():
    """On clustered vectors the walk leaves most rows alone, and still holds the first ones."""
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(40, 8)) * 300
    rows = np.floor(np.repeat(centres, 500, axis=0) + draw.normal(size=(20_000, 8)) * 3)
    anchors = np.floor(centres[:10] + draw.normal(size=(10, 8)) * 3)
    best = hardneg.Best(10, 5)

    def visit(members, part, scores):
        m, p = np.nonzero(np.ones_like(scores, dtype=bool))
        best.add(members[m], scores[m, p], part[p])
        return best.worst[members]

    done = hardneg.walk(anchors, rows, 10, visit)
    assert done < 0.3 * len(anchors) * len(rows)
    scores = hardneg.inner(anchors, rows)
    for i in range(10):
        order = np.lexsort((np.arange(len(rows)), -scores[i]))[:5]
        assert best.id[best.seeker == i].tolist() == order.tolist()


def test_large_products():
    a, b = np.full((1, 4), 2.0**30), np.full((1, 4), 2.0**29)
    assert hardneg.inner(a, b).tolist() == [[2**61]]
    with pytest.raises(ValueError):
        hardneg.inner(a * 4, b)
