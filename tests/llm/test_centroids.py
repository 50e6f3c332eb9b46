"""Centroid clustering against plain integers, its bounds, and vectors that are left out or out of the usual range."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, x string"


def brute(rows, size, k, rounds):
    kept = [(i, [math.floor(Fraction(v) * 1024) for v in x]) for i, x in rows
            if x is not None and len(x) == size and all(v is not None and math.isfinite(v) for v in x)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    now = [x for _, x in order[:k]]
    distance = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    near = lambda x: min((distance(x, c), i) for i, c in enumerate(now))
    for _ in range(rounds):
        groups = [[] for _ in now]
        for _, x in kept:
            groups[near(x)[1]].append(x)
        now = [[sum(col) // len(g) for col in zip(*g)] if g else c for g, c in zip(groups, now)]
    return sorted(((i, near(x)[1], near(x)[0] if near(x)[0] < 1 << 63 else None) for i, x in kept), key=str), now


def given(seed=1, n=300, size=6):
    r = random.Random(seed)
    at = [[r.uniform(-1, 1) for _ in range(size)] for _ in range(5)]
    rows = [(i, [v + r.gauss(0, .2) for v in r.choice(at)]) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # one very common vector
    rows += [rows[5], rows[5], (None, rows[7][1]), (2000, None), (2001, []), (2002, [0.0] * (size - 1)), (2003, [0.0] * (size + 1)),
             (2004, [None] + [0.0] * (size - 1)), (2005, [float("nan")] + [0.0] * (size - 1)), (2006, [float("-inf")] + [0.0] * (size - 1)),
             (2007, [-0.0] * size), (2008, [1e-9, -1e-9] + [0.5] * (size - 2))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, "c", "x") for x in rows], SCHEMA).repartition(4)


def answer(found):
    return sorted(((r.vec_id, r.cluster, r.distance) for r in found.collect()), key=str)


@pytest.mark.parametrize("far", [[], [(3000, [3e5, 1.0, 2.0, 3.0, 4.0, 5.0])], [(3001, [1e300] * 6), (3002, [-1.7e308] * 6), (3003, [1.7e308] * 6)]])
def test_clusters_equal_brute_force(spark, far):
    rows = given() + far
    found, final = centroids.cluster(frame(spark, rows), centroids=8, rounds=4, size=6)
    expected, now = brute(rows, 6, 8, 4)
    assert final == now
    assert answer(found) == expected


def test_few_equal_and_no_vectors(spark):
    for rows in ([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.5])], [(None, [1.0, 2.0])], [(i, [0.25, 0.5]) for i in range(20)]):
        found, final = centroids.cluster(frame(spark, rows), centroids=8, rounds=3, size=2)
        assert (answer(found), final) == brute(rows, 2, 8, 3)
    found, final = centroids.cluster(frame(spark, [(1, None)]))
    assert found.count() == 0 and final == []


def test_bounds_hold_and_skip():
    r = np.random.default_rng(5)
    x = r.integers(-3000, 3000, (12, 8))[r.integers(0, 12, 2000)] + r.integers(-40, 40, (2000, 8))
    pivots, asked = x[:5], x[100:108]
    held = centroids.roots(centroids.squared(x[:, None, :], pivots[None]))
    exact = centroids.squared(x[:, None, :], asked[None])
    bound = centroids.ptolemaic_bounds(held, centroids.roots(centroids.squared(asked[:, None], pivots[None])),
                                       centroids.roots(centroids.squared(pivots[:, None], pivots[None])))
    assert (bound ** 2 <= exact).all()
    cluster, best, measured = centroids.nearest(x, held, asked, pivots)
    assert (best == exact.min(axis=1)).all() and (cluster == exact.argmin(axis=1)).all()
    assert measured < 0.6 * exact.size


def test_query_columns(spark, tmp_path):
    rows = given(2, 200, 64)
    frame(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = centroids.op12_centroids(spark, str(tmp_path))
    expected, now = brute(rows, 64, 8, 10)
    assert answer(got) == expected
    by = got.groupBy("cluster").agg(F.sum("distance").alias("d"), F.max("cluster_inertia").alias("i"), F.max("centroid_sha256").alias("h"))
    for r in by.collect():
        assert r.d == r.i and r.h == hashlib.sha256(",".join(map(str, now[r.cluster])).encode()).hexdigest()
    assert [r.inertia for r in got.select("inertia").distinct().collect()] == [sum(e[2] for e in expected)]
