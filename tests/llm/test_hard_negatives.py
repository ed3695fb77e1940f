import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskloom.llm.hard_negatives import Windows, hard_negatives, pack, stream_windows, unpack_key

SCHEMA = "vec_id bigint, label int, embedding array<float>, key string, share int"


def brute(rows, scale, every, spec):
    kept = set()
    for i, label, v in rows:
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v):
            kept.add((i, label, tuple(math.floor(scale * float(np.float32(x))) for x in v)))
    out = []
    for i, label, q in kept:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j, other) for j, other, v in kept if j != i)
        positives = [(j, -s) for s, j, other in scored if other == label][: spec.n_positives]
        for p, ps in positives:
            fits = [(j, -s) for s, j, other in scored if other != label and spec.low * ps <= 100 * -s <= spec.high * ps]
            out += [(i, p, n, j, ps, ns) for n, (j, ns) in enumerate(fits[: spec.n_negatives], 1)]
    return sorted(out)


def check(spark, rows, scale=8, every=5, spec=Windows(3, 4), **shape):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = hard_negatives(df, F.col("vec_id") % every == 0, scale, spec, **shape)
    assert sorted(map(tuple, got.collect())) == brute(rows, scale, every, spec)


@pytest.mark.parametrize("shape", [{}, {"per_block": 25, "per_anchors": 7}])
@pytest.mark.parametrize("dims", [2, 5])
def test_equal_to_a_full_scan(spark, dims, shape):
    rng = random.Random(dims)
    # a third of the rows share a label, components are coarse so that scores tie
    rows = [(i, 0 if i % 3 == 0 else rng.randrange(4), [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(dims)]) for i in range(150)]
    check(spark, rows, **shape)


def test_windows_of_positives_without_a_positive_score(spark):
    # a positive of score 0 takes negatives of score 0, also with smaller ids; below 0 nothing fits
    rows = [(0, 1, [1.0, 0.0]), (9, 1, [0.0, 1.0]), (1, 2, [0.0, 3.0]), (2, 2, [-1.0, 0.0]), (12, 2, [0.0, -1.0]), (5, 3, [-1.0, 0.0]), (6, 3, [1.0, 0.0])]
    check(spark, rows)


def test_odd_rows(spark):
    nan = float("nan")
    rows = [
        (0, 1, [1.0, 1.0]), (1, None, [1.0]), (None, 1, [1.0]), (2, 1, None), (3, 1, [nan]), (4, 1, [None]), (6, 1, [1.0]),
        (6, 1, [1.0]), (7, 2, [0.75, 0.0]), (8, 2, []), (0, 2, [0.5, 0.5]), (9, 2, [0.5]),
    ]
    check(spark, rows)
    check(spark, [(0, 1, [1.0])])
    check(spark, [])


def test_key_order_is_the_order_of_pairs():
    rng = random.Random(1)
    pairs = [(rng.randint(-3, 3), rng.randint(0, 1), rng.randint(-9, 9), rng.random() < 0.5, rng.randint(-3, 3)) for _ in range(300)]
    assert [unpack_key(k) for k in sorted(pack(*p) for p in pairs)] == sorted(pairs, key=lambda p: (p[0], p[1], -p[2], p[3], p[4]))


def test_the_stream_needs_no_combined_blocks():
    """All pairs, uncombined, give the same rows: the blocks only leave out what cannot matter."""
    rng = random.Random(5)
    spec = Windows(2, 3)
    pairs = [(a, rng.randint(0, 60), rng.random() < 0.7, b) for a in range(4) for b in range(80)]
    got = list(stream_windows(iter(sorted(pack(a, 0, *rest) for a, *rest in pairs)), spec))
    want = []
    for a in range(4):
        own = sorted((p for p in pairs if p[0] == a), key=lambda p: (-p[1], p[3]))
        for _, ps, _, b in [p for p in own if not p[2]][:2]:
            fits = [p for p in own if p[2] and 30 * ps <= 100 * p[1] <= 90 * ps][:3]
            want += [(a, b, n, p[3], ps, p[1]) for n, p in enumerate(fits, 1)]
    assert sorted(got) == sorted(want)
