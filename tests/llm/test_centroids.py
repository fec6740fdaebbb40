"""Centroid clustering against plain integers, one pair at a time."""

import hashlib
import math

import numpy as np
import pytest

from voxelweave.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, k=16, rounds=3, dim=64, scale=64):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cents = [v for _, v in named[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        to = [n for _, n in assign()]
        for n in range(len(cents)):
            own = [v for (_, v), m in zip(kept, to) if m == n]
            if own:
                cents[n] = [sum(c) // len(own) for c in zip(*own)]
    last = assign()
    per = [sum(d for d, m in last if m == n) for n in range(len(cents))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, n, d, per[n], sum(per), sha[n]) for (i, _), (d, n) in zip(kept, last)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def vectors(n, seed=0, dim=64, spread=1.0):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(5, dim)) * spread
    return [(i, [float(np.float32(x)) for x in centre[i % 5] + r.normal(size=dim) * 0.3]) for i in range(n)]


@pytest.mark.parametrize("n", [1, 7, 16, 17, 150])
def test_equals_brute_force(spark, n):
    rows = vectors(n)
    assert got(centroids.cluster(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_rows_that_take_no_part_and_repeats(spark):
    rows = vectors(60, 1)
    rows += [(100, None), (101, []), (102, [0.5] * 63), (103, [0.5] * 65), (104, [None] + [0.1] * 63), (105, [float("nan")] * 64), (106, [float("inf")] * 64)]
    rows += [rows[3]] * 40 + [(3, [0.25] * 64), (None, [0.1] * 64), (None, None)]
    assert got(centroids.cluster(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_ties_and_equal_rows(spark):
    rows = [(i, [float(i % 3)] * 64) for i in range(40)]
    assert got(centroids.cluster(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_clashing_and_too_large(spark):
    assert centroids.cluster(spark.createDataFrame([], SCHEMA)).count() == 0
    assert centroids.cluster(spark.createDataFrame([(1, [0.5])], SCHEMA)).count() == 0
    data = spark.createDataFrame([(1, [0.5] * 64, 3, 4, "x")], "vec_id bigint, embedding array<float>, cluster int, v int, VEC_ID string")
    assert got(centroids.cluster(data)) == brute([(1, [0.5] * 64)])
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], SCHEMA)).count()
    with pytest.raises(ValueError, match="no vector has an id"):
        centroids.cluster(spark.createDataFrame([(None, [0.5] * 64)], SCHEMA))


def test_other_parameters(spark):
    rows = [(i, v[:10]) for i, v in vectors(80, 3)]
    out = centroids.cluster(spark.createDataFrame(rows, SCHEMA), k=4, rounds=5, dim=10, scale=100)
    assert got(out) == brute(rows, 4, 5, 10, 100)


def test_partial_distances_are_exact_and_save_work(spark):
    r = np.random.default_rng(5)
    v, c = r.integers(-300, 300, (500, 64)), r.integers(-300, 300, (16, 64))
    c[7] = c[2]
    v[:, 40:] = v[:, 40:] // 50
    order = np.argsort(-v.var(0), kind="stable")
    full = ((v[:, None, :] - c) ** 2).sum(2)
    winner, best, terms = centroids.nearest(v, c, order)
    assert (winner == full.argmin(1)).all() and (best == full.min(1)).all() and terms < full.size * 64
    counter = spark.sparkContext.accumulator(0)
    rows = vectors(300, 4, spread=3.0)
    centroids.cluster(spark.createDataFrame(rows, SCHEMA), counter=counter).count()
    assert 0 < counter.value < 300 * 16 * 64 * 0.8
