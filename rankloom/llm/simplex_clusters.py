"""Centroid clustering of integer vectors, with n-simplex projections as a filter.

Distances from every vector to a few *pivots* are computed once and kept, as the coordinates
of an apex: the pivots span a simplex in as many dimensions less one, and a vector's distances
to them place it above that simplex (its last coordinate is the height, not negative).  For
two apexes the Euclidean distance is a lower bound of the distance of the vectors, and the
distance with one height turned down an upper bound.  In each round a centroid's apex follows
from its own distances to the pivots; only centroids whose lower bound does not exceed the
least upper bound are compared exactly, in integers.

* The bounds are floats, so they are widened by a share of the largest norm that exceeds the
  rounding; the assignment itself is integer arithmetic: ties go to the smaller number.
* Pivots are vectors of the table far from each other (greedy, from the start centroids): any
  choice gives the same result, since the filter only skips centroids that cannot win.

Plan: one pass writes the kept vectors as integers with their apexes.  A round reads that
table, every task gives one row per cluster (sums per component and a count), Spark adds them
up as decimals, and the driver gets ``k`` sums and makes the next centroids: ``k * dims``
numbers, whatever the number of vectors.  A group of equal vectors is spread like any rows.
The last assignment is written, its inertias are ``k`` sums more.

Defined cases: vectors with another number of components, a null or a non-finite one are left
out (as are null vectors); a null ``vec_id`` is kept and named ``3:``; rows with the same id are
told apart by their components when the start centroids are picked, equal rows are each
clustered; fewer than ``k`` vectors make fewer centroids and an empty table gives no rows;
extra columns are ignored.  Where components are beyond ``largest(dims)`` (2**27 for 64) the same
arithmetic is done in unbounded integers; a squared distance or an inertia that a long cannot
hold is null.  Vectors with a component whose integer is beyond 2**62 are left out too.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm._work import Workspace, arrow_map

PIVOTS = 6
FLAT = 0.1  # a pivot that rises less than this share above the others adds no dimension
SLACK = 1e-8  # share of the squared norms that covers the rounding of a bound
BLOCK = 8192  # vectors at a time


def largest(dims: int) -> int:
    """Components up to this size have squared distances below 2**62."""
    return math.isqrt((1 << 62) // dims) // 2


# --- n-simplex projection ---------------------------------------------------------------
def distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Euclidean distances from rows of ``x`` to rows of ``p`` (integers), as floats."""
    return np.sqrt(np.stack([squared(x, q) for q in p], axis=1).astype(np.float64)) if len(p) else np.empty((len(x), 0))


def unbounded(*arrays: np.ndarray) -> bool:
    """Some component is too large for squared distances in 64 bits."""
    return any(a.size and int(np.abs(a).max()) > largest(a.shape[-1]) for a in arrays)


def squared(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``x`` to the vector ``q``."""
    if unbounded(x, q):
        d = x.astype(object) - q.astype(object)
        return (d * d).sum(axis=1)
    d = x - q
    return np.einsum("ij,ij->i", d, d)


def base_simplex(pivots: np.ndarray) -> np.ndarray:
    """Coordinates of the pivots as vertices of a simplex: vertex i in the first i dimensions,
    its last one not negative."""
    base = np.zeros((len(pivots), max(1, len(pivots))))
    for i in range(1, len(pivots)):
        base[i, :i] = apexes(distances(pivots[i : i + 1], pivots[:i]), base[:i, : max(1, i - 1)])[0]
        if base[i, i - 1] < FLAT * np.linalg.norm(base[i]):
            base[i, i - 1] = 0.0  # nearly in the span of the others, where a height says little
    return base[:, : max(1, len(pivots) - 1)]


def apexes(dist: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Apex of each row of distances to the vertices of ``base``: one coordinate more than the
    base has dimensions, the last one the height above it."""
    n = dist.shape[1]
    if n == 0:
        return np.empty((len(dist), 0))
    out = np.zeros((len(dist), n))
    left = dist[:, 0] ** 2  # squared distance to the first vertex, less what is placed
    for i in range(1, n):
        height = base[i, i - 1]
        if height > 0:
            # |a - v0|^2 - |a - vi|^2 = 2 a.vi - |vi|^2
            dot = (dist[:, 0] ** 2 - dist[:, i] ** 2 + (base[i] ** 2).sum()) / 2
            out[:, i - 1] = (dot - out[:, : i - 1] @ base[i, : i - 1]) / height
            left = left - out[:, i - 1] ** 2
    out[:, n - 1] = np.sqrt(np.maximum(left, 0.0))
    return out


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared lower and upper bounds of the distances between apexes: rows of ``a`` by rows
    of ``b``."""
    body = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(axis=2)
    return body + (a[:, None, -1] - b[None, :, -1]) ** 2, body + (a[:, None, -1] + b[None, :, -1]) ** 2


def choose_pivots(start: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` vectors of ``start`` that are far from each other: the first, then the one
    farthest from those chosen, as long as it differs from them."""
    chosen = list(start[:1])
    while chosen and len(chosen) < n:
        far = np.min([squared(start, c) for c in chosen], axis=0)
        if far.max() == 0:
            break
        chosen.append(start[int(far.argmax())])
    return np.array(chosen, np.int64).reshape(len(chosen), start.shape[1])


def nearest(x: np.ndarray, apex: np.ndarray, centroids: np.ndarray, c_apex: np.ndarray, reach: float):
    """(number of the nearest centroid, squared distance, exact comparisons made)."""
    low, high = bounds(apex, c_apex)
    # ``reach``: the largest squared distance between pivots
    room = SLACK * (1.0 + reach + (apex**2).sum(axis=1, keepdims=True) + (c_apex**2).sum(axis=1)[None, :])
    maybe = low - room <= (high + room).min(axis=1, keepdims=True)
    wide = unbounded(x, centroids)
    best = np.full(len(x), 1 << 140, object) if wide else np.full(len(x), np.iinfo(np.int64).max)
    which = np.zeros(len(x), np.int32)
    for c in range(len(centroids)):
        rows = np.flatnonzero(maybe[:, c])
        d = squared(x[rows], centroids[c])
        better = (d < best[rows]).astype(bool)
        best[rows[better]], which[rows[better]] = d[better], c
    return which, best, int(maybe.sum())


class Projection:
    """Pivots and their simplex; small, sent to the tasks with the function that uses it."""

    def __init__(self, pivots: np.ndarray):
        self.pivots, self.base = pivots, base_simplex(pivots)
        self.reach = max((float(squared(pivots, p).max()) for p in pivots), default=0.0)

    def apex(self, x: np.ndarray) -> np.ndarray:
        return apexes(distances(x, self.pivots), self.base)


# --- on Spark ---------------------------------------------------------------------------
def kept_vectors(table: DataFrame, dims: int, scale: float, vector: str = "embedding") -> DataFrame:
    """``(vec_id, v array<long>)``: whole vectors as integers ``floor(scale * x)``."""
    x = F.col("e")
    ok = (F.size("e") == dims) & F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) <= float(1 << 62)))
    return (
        table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("e"))
        .filter(F.coalesce(ok, F.lit(False)))
        .select("vec_id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))
    )


def matrix(column, dims: int) -> np.ndarray:
    """A list column of ``dims`` numbers a row as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def start_centroids(kept: DataFrame, k: int, seed: int = 3) -> np.ndarray:
    """The ``k`` vectors whose ``{seed}:{vec_id}`` has the smallest SHA-256, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = kept.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def project(kept: DataFrame, projection: Projection, dims: int) -> DataFrame:
    """``(vec_id, v, apex)``."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                some = batch.slice(lo, BLOCK)
                apex = projection.apex(matrix(some.column(1), dims))
                off = pa.array(np.arange(len(apex) + 1, dtype=np.int32) * apex.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.ListArray.from_arrays(off, pa.array(apex.ravel()))], names=["vec_id", "v", "apex"]
                )

    return arrow_map(kept, run, "vec_id long, v array<long>, apex array<double>")


def _assigned(batches, centroids: np.ndarray, projection: Projection):
    dims, c_apex = centroids.shape[1], projection.apex(centroids)
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK):
            some = batch.slice(lo, BLOCK)
            x = matrix(some.column(1), dims)
            apex = matrix(some.column(2), len(projection.pivots))
            yield some, x, *nearest(x, apex, centroids, c_apex, projection.reach)


def sums(vectors: DataFrame, centroids: np.ndarray, projection: Projection) -> list:
    """Per cluster that has vectors: (cluster, count, sum of each component)."""

    def run(batches):
        k, dims = centroids.shape
        total, count = np.zeros((k, dims), object), np.zeros(k, np.int64)
        for _, x, which, _, _ in _assigned(batches, centroids, projection):
            for c in np.unique(which):
                mine = which == c
                total[c] += x[mine].astype(object if unbounded(x) else np.int64).sum(axis=0).astype(object)  # below 2**63 in a block
                count[c] += int(mine.sum())
        rows = [(int(c), d, int(total[c, d]), int(count[c])) for c in np.flatnonzero(count) for d in range(dims)]
        cols = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array([str(v) for v in cols[2]], pa.string()), pa.array(cols[3], pa.int64())],
            names=["cluster", "dim", "total", "n"],
        )

    part = arrow_map(vectors, run, "cluster int, dim int, total string, n long")
    added = part.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    return added.collect()  # at most k * dims rows


def moved(centroids: np.ndarray, rows: list) -> np.ndarray:
    """Exact floor of the means; clusters without vectors stay."""
    out = centroids.copy()
    for r in rows:
        out[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
    return out


def cluster(table: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: float = 1024.0, pivots: int = PIVOTS, vector: str = "embedding") -> DataFrame:
    """One row per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256``."""
    work = Workspace(table.sparkSession, "clusters")
    kept = work.save(kept_vectors(table, dims, scale, vector), "kept")
    centroids = start_centroids(kept, k)
    schema = "vec_id long, cluster int, distance long"
    out = [*schema.split(", "), "cluster_inertia long", "inertia long", "centroid_sha256 string"]
    if not len(centroids):
        return table.sparkSession.createDataFrame([], ", ".join(out))
    projection = Projection(choose_pivots(centroids, pivots))
    vectors = work.save(project(kept, projection, dims), "vectors")
    for _ in range(rounds):
        after = moved(centroids, sums(vectors, centroids, projection))
        if np.array_equal(after, centroids):
            break  # every later round would give the same
        centroids = after

    def run(batches):
        for some, _, which, best, _ in _assigned(batches, centroids, projection):
            fits = pa.array([v if v < 1 << 63 else None for v in best.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(which), fits], names=["vec_id", "cluster", "distance"])

    last = work.save(arrow_map(vectors, run, schema), "assigned")
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")
    per = last.groupBy("cluster").agg(total, F.count("distance").alias("n"), F.count(F.lit(1)).alias("of")).collect()  # k rows
    inertia = {r["cluster"]: int(r["s"]) if r["n"] == r["of"] else None for r in per}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # what every vector of a cluster says of it; a total beyond a long is null
    fits = lambda v: v if v is not None and v < 1 << 63 else None
    every = None if None in inertia.values() else sum(inertia.values())
    about = table.sparkSession.createDataFrame(
        [(c, fits(s), fits(every), digest[c]) for c, s in sorted(inertia.items())],
        "c int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return last.join(F.broadcast(about), F.col("cluster") == F.col("c")).select([c.split()[0] for c in out])
