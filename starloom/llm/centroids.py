"""Centroid clustering of integer vectors (Lloyd's rounds) with Ptolemaic pivots.

For any points, Ptolemy's inequality gives |q,o| >= | |q,p| |o,s| - |q,s| |o,p| | / |p,s|. A few vectors are fixed as pivots; each vector's distances to
them are computed once and stored with it. In a round the bound of every (vector, centroid) over all pivot pairs comes from
these and the centroids' few pivot distances. The centroid of least bound is measured exactly; the others are
measured exactly (in integers) only where the bound, lowered by more than its rounding error can be, does not exceed the best distance so far.

A round is one pass over the vectors: a task sends one exact sum a component and centroid, added up by partial aggregation
(components x centroids numbers reach the driver, whatever the input). Nothing is shuffled by vector, so a vector that a third of all rows
share is no hot key.

Kept are vectors with exactly ``size`` components, none NULL, NaN or infinite; a component x counts as the integer floor(1024 x), exact for
any double (numbers that 64 bits cannot hold are handled as Python integers; a distance or inertia over a long's range is NULL).

Defined results: the starting centroids are ordered by hash, then by their components (rows equal in id may start several centroids; ties
go to the smaller number, and a centroid without vectors stays). Rows with NULL vec_id are clustered; they start a
centroid only if there are too few others. Fewer vectors than centroids give fewer centroids; an empty table an empty result. Repeated rows count
each time. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import read
from starloom.session import cut_lineage

SIZE, CENTROIDS, ROUNDS, PIVOTS, SEED = 64, 8, 10, 5, "3"
_SAFE = 1 << 26  # up to this, squared distances of some thousand components and their sums fit 64 bits
_LIMB = 40
_EPS = float(np.finfo(np.float64).eps)


def integers(x: np.ndarray) -> np.ndarray:
    """floor(1024 x): 64-bit where that is safe, else Python integers."""
    with np.errstate(over="ignore"):
        z = np.floor(x * 1024.0)
    if z.size == 0 or np.abs(z).max() <= _SAFE:
        return z.astype(np.int64)
    return np.array([math.floor(Fraction(v) * 1024) for v in x.ravel().tolist()], object).reshape(x.shape)


def _matched(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit numbers, or both as Python integers."""
    return (a, b) if a.dtype == b.dtype else (a.astype(object), b.astype(object))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``a`` to rows of ``b`` (or to one row)."""
    a, b = _matched(a, b)
    return ((a - b) ** 2).sum(axis=-1)


def roots(d: np.ndarray) -> np.ndarray:
    """Distances of squared ones (infinite where a double cannot hold them)."""
    if d.dtype != object:
        return np.sqrt(d.astype(np.float64))
    one = [math.sqrt(v) if v < 1 << 1000 else float(math.isqrt(v)) if v < 1 << 2000 else math.inf for v in d.ravel().tolist()]
    return np.array(one, np.float64).reshape(d.shape)


def ptolemaic_bounds(held: np.ndarray, asked: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Lower bounds (rows x centroids) of distances, under any rounding error.

    ``held``: rows x pivots, ``asked``: centroids x pivots, ``between``: pivots x pivots.
    """
    bound = np.zeros((len(held), len(asked)))
    with np.errstate(all="ignore"):
        for i in range(held.shape[1]):
            for j in range(i):
                if between[i, j] > 0:
                    a, b = held[:, i, None] * asked[None, :, j], held[:, j, None] * asked[None, :, i]
                    here = (np.abs(a - b) - 16 * _EPS * (a + b)) / between[i, j] * (1 - 16 * _EPS)
                    np.fmax(bound, np.where(np.isfinite(here), here, 0), out=bound)
    return bound


def nearest(x: np.ndarray, held: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster and exact squared distance of every row, and how many distances were measured."""
    asked = roots(squared(centroids[:, None, :], pivots[None, :, :]))
    bound = ptolemaic_bounds(held, asked, roots(squared(pivots[:, None, :], pivots[None, :, :])))
    cluster = bound.argmin(axis=1)
    best = squared(x, centroids[cluster])
    measured = len(x)
    first = cluster.copy()
    for c in range(len(centroids)):
        at = np.flatnonzero((first != c) & (bound[:, c] <= roots(best) * (1 + 4 * _EPS)))
        measured += len(at)
        d = squared(x[at], centroids[c])
        better = (d < best[at]) | ((d == best[at]) & (c < cluster[at]))
        at, d = at[better], d[better]
        if len(at):
            if d.dtype != best.dtype:
                best = best.astype(object)
            best[at], cluster[at] = d, c
    return cluster, best, measured


def _rows(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, size)


def vectors(table: DataFrame, size: int = SIZE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x (doubles) of the kept rows."""
    x = F.col(vector_col).cast("array<double>")
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return table.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).filter(F.size("x") == size).filter(sound)


def first_vectors(kept: DataFrame, n: int, seed: str = SEED) -> np.ndarray:
    """The ``n`` vectors of smallest sha256 of ``seed:vec_id`` (bounded: n rows reach the driver)."""
    order = F.sha2(F.concat(F.lit(seed + ":"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(order.asc_nulls_last(), F.transform("x", lambda v: F.floor(v * 1024)), "x").limit(n).collect()
    return integers(np.array([r.x for r in rows], np.float64)) if rows else np.zeros((0, 0), np.int64)


def _limbs(v: int) -> list[tuple[int, int]]:
    """``v`` as (place, number) with numbers that stay exact in sums of 64-bit numbers."""
    out, place = [], 0
    while not -(1 << 62) < v < 1 << 62:
        out.append((place, v & ((1 << _LIMB) - 1)))
        v, place = v >> _LIMB, place + 1
    return [*out, (place, v)]


def _sums(held: DataFrame, centroids: np.ndarray, pivots: np.ndarray, size: int) -> list[tuple[int, list[int]]]:
    """Count and component sums of every centroid's vectors."""
    k = len(centroids)

    def add(batches):
        total = [[0] * (size + 1) for _ in range(k)]
        for b in batches:
            x = integers(_rows(b.column("x"), size))
            cluster, _, _ = nearest(x, _rows(b.column("held"), len(pivots)), centroids, pivots)
            for c in np.unique(cluster).tolist():
                mine = x[cluster == c]
                for i, v in enumerate([len(mine), *mine.sum(axis=0).tolist()]):
                    total[c][i] += int(v)
        rows = [(c, i, place, v) for c in range(k) if total[c][0] for i in range(size + 1) for place, v in _limbs(total[c][i])]
        cols = list(zip(*rows)) if rows else [[]] * 4
        yield pa.record_batch([pa.array(col, pa.int64()) for col in cols], ["cluster", "part", "place", "v"])
    added = (held.select("x", "held").mapInArrow(add, "cluster long, part long, place long, v long")
             .groupBy("cluster", "part", "place").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")))
    out = [[0] * (size + 1) for _ in range(k)]
    for r in added.collect():  # centroids x components numbers
        out[r.cluster][r.part] += int(r.v) << (_LIMB * r.place)
    return [(row[0], row[1:]) for row in out]


def _as_array(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(v) <= _SAFE for row in rows for v in row)
    return np.array(rows, np.int64 if small else object)


def cluster(table: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, size: int = SIZE, pivots: int = PIVOTS,
            seed: str = SEED, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster, distance (squared), measured (distances that were computed) of every kept vector; the final centroids."""
    kept = vectors(table, size, id_col, vector_col)
    start = first_vectors(kept, centroids, seed)
    fixed = start[:pivots]

    def distances(batches):
        for b in batches:
            x = integers(_rows(b.column("x"), size))
            d = roots(squared(x[:, None, :], fixed[None, :, :]))
            flat = pa.ListArray.from_arrays(np.arange(0, d.size + 1, max(1, len(fixed)), np.int32)[:len(x) + 1], d.ravel())
            yield pa.record_batch([b.column("vec_id"), b.column("x"), flat], ["vec_id", "x", "held"])
    result = "vec_id long, cluster int, distance long, measured int"
    if not len(start):
        return table.sparkSession.createDataFrame([], result), []
    held = cut_lineage(kept.mapInArrow(distances, "vec_id long, x array<double>, held array<double>"), "pivot-distances")
    now = start
    for _ in range(rounds):
        moved = [[s // n for s in sums] if n else now[c].tolist() for c, (n, sums) in enumerate(_sums(held, now, fixed, size))]
        now = _as_array(moved)

    def assign(batches):
        for b in batches:
            x = integers(_rows(b.column("x"), size))
            c, d, measured = nearest(x, _rows(b.column("held"), len(fixed)), now, fixed)
            d = pa.array([v if v < 1 << 63 else None for v in d.tolist()], pa.int64())
            share = np.full(len(x), measured // max(1, len(x)), np.int32)
            share[:measured % max(1, len(x))] += 1
            yield pa.record_batch([b.column("vec_id"), pa.array(c.astype(np.int32)), d, pa.array(share)],
                                  ["vec_id", "cluster", "distance", "measured"])
    return held.mapInArrow(assign, result), now.tolist()


def op12_centroids(spark, sf_dir):
    found, final = cluster(read(spark, sf_dir, "embeddings"))
    found = cut_lineage(found.drop("measured"), "clusters")
    inertia = {r.cluster: r.d for r in found.groupBy("cluster").agg(
        F.when(F.count("*") == F.count("distance"), F.sum(F.col("distance").cast("decimal(38,0)"))).alias("d")).collect()}  # one row a centroid
    total = sum(inertia.values()) if None not in inertia.values() else None
    fits = lambda v: int(v) if v is not None and v < 1 << 63 else None
    rows = [(c, fits(inertia.get(c)), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(final)]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, centroid_sha256 string")
    return (found.join(F.broadcast(known), "cluster")  # one row a centroid
            .select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(fits(total)).cast("long").alias("inertia"), "centroid_sha256"))
