"""op13: the tree search against all distances, the clustering against plain Python, and the edge cases."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortkit.llm import centroids as C


def plain(rows, k, rounds, dim):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centers = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(centers))
    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for j in range(len(centers)):
            own = [v for (_, v), c in zip(kept, at) if c == j]
            if own:
                centers[j] = [sum(x) // len(own) for x in zip(*own)]
    return sorted(((i is not None, i or 0), *nearest(v)[::-1]) for i, v in kept), centers


def check(spark, rows, k=8, rounds=10, dim=4):
    df = spark.createDataFrame(
        [(*r, "mine", 1) for r in rows], "vec_id long, embedding array<float>, cluster string, vector int")
    found, centers = C.cluster(df.repartition(3), k=k, rounds=rounds, dim=dim)
    got = sorted(((r["vec_id"] is not None, r["vec_id"] or 0), r["cluster"], r["distance"]) for r in found.collect())
    want, plain_centers = plain([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], k, rounds, dim)
    assert got == want and centers.tolist() == plain_centers


def test_random_and_tied(spark):
    r = np.random.default_rng(5)
    check(spark, [(i, r.normal(0, 1, 4).tolist()) for i in range(300)])
    check(spark, [(i, [float(x) for x in r.integers(-1, 2, 4)]) for i in range(200)])  # many ties and copies


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(90, None), (91, []), (92, [1.0, 2.0, 3.0]), (93, [1.0, None, 1.0, 1.0]), (94, [nan, 1.0, 1.0, 1.0]), (95, [1.0, -inf, 0.0, 0.0])]
    few = [(1, [0.5, 0.0, 0.0, 0.0]), (1, [0.5, 0.0, 0.0, 0.0]), (None, [-0.0001, 0.0, 0.0, 0.0]), (2, [3.0, 4.0, 0.0, 1.0])]
    check(spark, few + bad)
    check(spark, bad)
    check(spark, [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(40)])  # all equal: clusters 1 ... 7 stay empty
    check(spark, [(i, [1e5 * (i % 3), 3e5, 0.0, 0.25]) for i in range(20)])  # differences over 2^28


def test_too_large_is_refused(spark):
    df = spark.createDataFrame([(1, [1e12]), (2, [-1e12])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64-bit"):
        C.cluster(df, k=2, dim=1)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 5), st.integers(0, 2**32 - 1), st.sampled_from([2, 9, 3000]))
def test_search_equals_all_distances(k, dim, seed, reach):
    r = np.random.default_rng(seed)
    points, vectors = r.integers(-reach, reach + 1, (k, dim)), r.integers(-reach, reach + 1, (50, dim))
    number, best, computed = C.nearest(C.build(points), vectors)
    every = ((vectors[:, None] - points[None]) ** 2).sum(2)
    assert best.tolist() == every.min(1).tolist() and number.tolist() == every.argmin(1).tolist()
    assert computed <= 50 * k


def test_search_prunes():
    r = np.random.default_rng(1)
    points = r.normal(0, 5000, (256, 3)).astype(np.int64)
    vectors = points[r.integers(0, 256, 2000)] + r.integers(-20, 21, (2000, 3))
    number, _, computed = C.nearest(C.build(points), vectors)
    assert number.tolist() == ((vectors[:, None] - points[None]) ** 2).sum(2).argmin(1).tolist()
    assert computed < 2000 * 256 / 4
