import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskloom.llm.mtree import CAPACITY, Searcher, _bodies, top_k

SCHEMA = "vec_id bigint, embedding array<float>, key string, cell int"


def floors(vec, scale):
    return [math.floor(scale * float(np.float32(x))) for x in vec]


def brute(rows, k, scale, every):
    kept = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            row = (i, tuple(floors(v, scale)))
            while row[1] and row[1][-1] == 0:
                row = (i, row[1][:-1])
            if row not in kept:
                kept.append(row)
    out = []
    for i, q in kept:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in kept if (j, v) != (i, q))
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def clustered(n, dims, seed, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    return (middle[rng.integers(centres, size=n)] + 0.05 * rng.normal(size=(n, dims))).astype(np.float32)


def check(spark, rows, k=3, scale=16, every=5, **shape):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(3)
    got = top_k(df, F.col("vec_id") % every == 0, k, scale, **shape)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, k, scale, every)


@pytest.mark.parametrize("shape", [{}, {"per_cell": 20}, {"per_cell": 40, "per_tree": 15}, {"per_cell": 30, "root_entries": 2, "per_tree": 90}])
def test_equal_to_a_full_scan(spark, shape):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(clustered(260, 4, 1))]
    check(spark, rows, **shape)


def test_one_vector_of_a_third_of_all_rows_and_many_ties(spark):
    rng = random.Random(3)
    rows = [(i, [0.5, 0.25] if i % 3 == 0 else [rng.choice([0.0, 0.25, 0.5, -0.5]) for _ in range(2)]) for i in range(120)]
    check(spark, rows, k=10, per_cell=8)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0]), (5, [1.0]), (10, None), (15, [None, 1.0]), (20, [nan, 1.0]), (25, [inf]), (None, [1.0]),
        (1, [1.0, 2.0]), (2, []), (3, [-1.0, -1.0, 4.0]), (3, [-1.0, -1.0, 4.0]), (0, [2.0, 2.0]), (30, [0.0, 0.0]),
    ]
    check(spark, rows, k=4)


def test_few_rows_and_none(spark):
    check(spark, [(0, [1.0])])
    check(spark, [(0, [1.0]), (1, [2.0])])
    check(spark, [(1, [1.0]), (2, [2.0])])
    check(spark, [])


def test_components_beyond_the_exact_range_are_refused(spark):
    df = spark.createDataFrame([(0, [3e38], "x", 1)], SCHEMA)
    with pytest.raises(ValueError):
        top_k(df, F.lit(True))


def test_stored_distances_spare_computations():
    points = np.floor(64 * clustered(1000, 6, 7, centres=20))
    points = np.unique(points, axis=0)
    top = int((points * points).sum(axis=1).max())
    keys = [i.to_bytes(16, "big") for i in range(len(points))]
    bodies = _bodies(points, keys, np.arange(len(points)), top)
    assert len(bodies) > len(points) // CAPACITY
    searcher = Searcher(bodies, 6, top)
    for q in range(0, len(points), 50):
        best = searcher.nearest(points[q], 5)
        want = sorted((-int(s), i) for i, s in enumerate(points @ points[q]))[:5]
        assert [(s, i) for s, i, _ in best] == want and [k for *_, k in best] == [keys[i] for _, i in want]
    assert searcher.computed < 10 * len(points) and searcher.spared > 0
    # a bound that is known beforehand only leaves out what lies below it
    floor = -searcher.nearest(points[0], 5)[4][0]
    assert searcher.nearest(points[0], 5, floor) == searcher.nearest(points[0], 5)
