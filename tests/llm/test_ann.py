import numpy as np

from logloom.llm import ann


def brute(rows, k):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for i, v in rows:
        far = np.sqrt(((points - np.asarray(v, dtype=np.float64)) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, far)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(far[j])) for j in order]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def test_all_leaves_give_exact_neighbours_with_ties_and_copies(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(400)]
    rows = [(i, v) for i, v in rows if any(v)] + [(1000 + i, [1.0, 1.0, 1.0]) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = brute(rows, 10)
    got = found(ann.nearest(frame, frame.filter("vec_id % 10 = 0"), leaf=20, share=1.0, chunk=5))
    assert got == {i: want[i] for i in got} and set(got) == {i for i, _ in rows if i % 10 == 0}


def test_recall(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    want = brute(rows, 10)
    got = found(ann.nearest(frame, frame.filter("vec_id % 5 = 0"), leaf=30))
    assert np.mean([len({v for v, _ in g} & {v for v, _ in want[i]}) for i, g in got.items()]) >= 9
    for i, g in got.items():
        assert all(s == dict(brute(rows, len(rows))[i])[v] for v, s in g[:1])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], "a"), (2, [0.0, 1.0], "b"), (3, None, "c"), (4, [], "c"), (5, [0.0, 0.0], "c"), (6, [nan, 1.0], "c"),
            (7, [1.0, inf], "c"), (8, [None, 1.0], "c"), (9, [1.0], "c"), (None, [1.0, 1.0], "c"), (1, [1.0, 0.0], "d")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = ann.nearest(frame, frame)
    assert {(r.query_id, r.rank, r.vec_id) for r in got.collect()} >= {(1, 1, 2), (2, 1, 1)}
    assert {r.query_id for r in got.collect()} == {1, 2}
    assert ann.nearest(frame.filter("false"), frame).count() == 0
    assert ann.nearest(frame, frame.filter("false")).count() == 0


def test_queries_of_another_length_take_no_part(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=2)]) for i in range(1, 200, 2)]
    rows += [(100 * i, [float(x) for x in rng.normal(size=2 if i % 4 == 0 else 3)]) for i in range(1, 40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute([(i, v) for i, v in rows if len(v) == 2], 10)
    got = found(ann.nearest(frame, frame.filter("vec_id % 100 = 0"), share=1.0))
    assert set(got) == {i for i, v in rows if i % 100 == 0 and len(v) == 2} and got == {i: want[i] for i in got}
