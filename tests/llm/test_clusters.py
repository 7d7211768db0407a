"""Centroid clustering: bounds, plain k-means in Python integers, hard tables."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import simplex_clusters as C
from rankloom.llm.queries import op13_centroid_clustering


@pytest.mark.parametrize("case", ["random", "line", "equal", "large"])
def test_bounds_hold(case):
    rng = np.random.default_rng(7)
    x = rng.integers(-900, 900, (400, 16))
    if case == "line":
        x = np.outer(rng.integers(-50, 50, 400), np.arange(16))
    if case == "equal":
        x = np.repeat(x[:3], 134, axis=0)[:400]
    if case == "large":
        x = x * (C.largest(16) // 900)
    projection = C.Projection(C.choose_pivots(x[:9], 6))
    apex = projection.apex(x)
    low, high = C.bounds(apex, apex[:9])
    for c in range(9):
        d = C.squared(x, x[c]).astype(float)
        room = C.SLACK * (1 + projection.reach + (apex**2).sum(axis=1) + (apex[c] ** 2).sum())
        assert (low[:, c] - room <= d).all() and (d <= high[:, c] + room).all()
    which, best, compared = C.nearest(x, apex, x[:9], apex[:9], projection.reach)
    every = np.stack([C.squared(x, x[c]) for c in range(9)], axis=1)
    assert (which == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert compared <= every.size


def test_the_filter_skips_centroids():
    rng = np.random.default_rng(3)
    middle = rng.integers(-3000, 3000, (8, 64))
    x = middle[rng.integers(0, 8, 2000)] + rng.integers(-200, 200, (2000, 64))
    projection = C.Projection(C.choose_pivots(middle, 6))
    *_, compared = C.nearest(x, projection.apex(x), middle, projection.apex(middle), projection.reach)
    assert compared < 2 * len(x)  # of 8 * len(x)


def brute(rows, k=8, rounds=10, dims=64, scale=1024):
    kept = [
        (i, [math.floor(scale * c) for c in e])
        for i, e in rows
        if e is not None and len(e) == dims and all(c is not None and math.isfinite(c) for c in e)
    ]
    name = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [list(v) for _, v in sorted(kept, key=name)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        at = [c for _, c in assign()]
        for n in range(len(centroids)):
            mine = [v for (_, v), c in zip(kept, at) if c == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine)]
    last = assign()
    inertia = [sum(d for d, c in last if c == n) for n in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia), names[c]) for (i, _), (d, c) in zip(kept, last)), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_over_the_whole_table(spark):
    got = op13_centroid_clustering(spark, "/root/testdata/sf0.001")
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert rows_of(got) == brute([(r.vec_id, r.embedding) for r in table.collect()])


def test_hard_tables(spark):
    rng = np.random.default_rng(11)
    good = [(i, rng.normal(0, 1, 4).tolist()) for i in range(60)]
    rows = good + [(1, good[0][1])] * 40 + [(None, [0.0, -0.0005, 1e-9, 2.0]), (70, [0.0] * 4), (71, [0.0] * 4)]
    rows += [(80, None), (81, []), (82, [1.0] * 3), (83, [1.0, None, 1.0, 1.0]), (84, [math.nan] + [1.0] * 3), (85, [math.inf] + [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    clash = df
    for c in ("v", "apex", "e", "cluster", "distance", "c", "total", "n"):
        clash = clash.withColumn(c, F.lit(c))
    assert rows_of(C.cluster(clash.repartition(5), k=8, rounds=10, dims=4)) == brute(rows, dims=4)
    few = [(1, [1.0, 2.0, 3.0, 4.0]), (2, [1.0, 2.0, 3.0, 4.0])]  # fewer than k, and equal
    assert rows_of(C.cluster(spark.createDataFrame(few, df.schema), dims=4)) == brute(few, dims=4)
    assert C.cluster(df.filter("false"), dims=4).collect() == []
    gone = spark.createDataFrame([(1, [1e300] * 4), (2, [1.0] * 4)], df.schema)
    assert [r.vec_id for r in C.cluster(gone, dims=4).collect()] == [2]


def test_large_components(spark):
    """Beyond 64-bit squares the arithmetic is the same; what a long cannot hold is null."""
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(0, 1, 4) * 10 ** rng.integers(0, 7, 4)).tolist()) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert rows_of(C.cluster(df, dims=4)) == brute(rows, dims=4)
    rows += [(100 + i, [(-1) ** i * 4e14, 1.0, 2.0, float(i)]) for i in range(20)]
    want = brute(rows, dims=4)
    fits = lambda v: v if v < 1 << 63 else None
    want = sorted(((i, c, fits(d), ci, n, h) for i, c, d, ci, n, h in want), key=str)
    got = rows_of(C.cluster(spark.createDataFrame(rows, df.schema), dims=4))
    assert [(r[:3], r[5]) for r in got] == [(r[:3], r[5]) for r in want]
    assert all(r[4] == (want[0][4] if want[0][4] < 1 << 63 and all(x[2] is not None for x in want) else None) for r in got)
