"""Centroid clustering of integer vectors with n-simplex projection.

The pivots are the starting centroids and those that the same rounds lead to on a
bounded sample (``MAX_SAMPLE`` vectors), ``PIVOTS`` at most: later centroids lie near
the space they span, which keeps the bounds narrow. Their distances to every vector are
worked out once and kept with it. The pivots span a simplex; the distances
of a vector to them place an apex over it: its coordinates in the simplex's
space and its altitude. Between the apexes of a vector and a centroid the
Euclidean distance is a lower bound of the true one, and with the sign of one
altitude turned an upper bound. A centroid whose lower bound is above the least
upper bound of all is out; the others are compared by exact integer distances.
So the bounds only save work and never decide.

Components are floor(64 x). Distances, sums and means are whole numbers, so no
result depends on the order of tasks. Rounds read the written table of vectors
and pivot distances; each task hands on one sum per centroid and component, and
the driver sees k centroids.

Cases: a vector that is null, has another number of components, or holds a null,
NaN, infinite value or one of ``LIMIT`` or more in magnitude (its distances need not
fit a long) is left out. A null vec_id counts as an empty text in the hash that picks the
starting centroids; equal ids there are ordered by their vectors. Equal vectors
go to one centroid; ties go to the smaller number. With fewer than k vectors
each is a centroid; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_arrow

DIMENSIONS = 64
CENTROIDS = 16
ROUNDS = 3
PIVOTS = 32
MAX_SAMPLE = 8_192
SCALE = 64
LIMIT = 1 << 20  # of a component
SLACK = 1e-6     # of the largest distance met: rounding of the bounds
FLAT = 1e-2      # of its distances: a lower altitude of a pivot adds nothing


# --- geometry ----------------------------------------------------------------

class Simplex:
    """The simplex over pivots, in coordinates of its own."""

    def __init__(self, pivots: np.ndarray):
        """Pivots that lie in the space of the earlier ones are left out."""
        self.pivots = pivots[:0].astype(np.int64)
        self.corners = np.zeros((0, 0))
        for p in pivots.astype(np.int64):
            apex = self.apexes(self.distances(p[None]))[0] if len(self.pivots) else np.zeros(0)
            if len(self.pivots) and apex[-1] <= FLAT * max(1.0, float(np.abs(apex).max())):
                continue
            corners = np.zeros((len(self.pivots) + 1, len(apex)))
            corners[:-1, :self.corners.shape[1]] = self.corners
            corners[-1] = apex
            self.pivots, self.corners = np.vstack([self.pivots, p]), corners

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Squared distances to the pivots, exact."""
        return squared(vectors, self.pivots)

    def apexes(self, distances: np.ndarray) -> np.ndarray:
        """Squared pivot distances -> coordinates over the pivots' simplex, the
        altitude last. Corner i has zeros from place i on, so the coordinates
        follow one by one."""
        n = len(self.pivots)
        d = distances.astype(np.float64)
        out = np.zeros((len(d), n))
        for i in range(1, n):
            s = self.corners[i]
            known = out[:, :i - 1] @ s[:i - 1]
            out[:, i - 1] = ((d[:, 0] - d[:, i] + s @ s) / 2 - known) / s[i - 1]
        if n:
            out[:, n - 1] = np.sqrt(np.maximum(d[:, 0] - (out[:, :n - 1] ** 2).sum(axis=1), 0))
        return out


def squared(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of vectors (rows) to points (columns), whole numbers."""
    out = np.empty((len(vectors), len(points)), np.int64)
    for j, p in enumerate(points):
        apart = vectors - p
        out[:, j] = np.einsum("ij,ij->i", apart, apart)
    return out


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances between the owners of apexes."""
    flat = np.maximum((a[:, None, :-1] - b[None, :, :-1]) ** 2, 0).sum(axis=2)
    low, high = (a[:, None, -1] - b[None, :, -1]) ** 2, (a[:, None, -1] + b[None, :, -1]) ** 2
    return np.sqrt(flat + low), np.sqrt(flat + high)


def nearest(vectors: np.ndarray, distances: np.ndarray, centroids: np.ndarray, simplex: Simplex):
    """Per vector its centroid and squared distance, and the exact comparisons
    that were made. ``distances``: squared, to the pivots."""
    low, high = bounds(simplex.apexes(distances), simplex.apexes(simplex.distances(centroids)))
    least = high.min(axis=1, initial=np.inf)
    slack = SLACK * (1 + high.max(axis=1, initial=0))
    open_ = low <= (least + slack)[:, None]
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    cluster = np.full(len(vectors), -1, np.int32)
    for j in range(len(centroids)):  # ascending, so ties stay with the smaller number
        rows = np.flatnonzero(open_[:, j])
        d = squared(vectors[rows], centroids[j:j + 1])[:, 0]
        closer = d < best[rows]
        best[rows[closer]], cluster[rows[closer]] = d[closer], j
    return cluster, best, int(open_.sum())


# --- Spark -------------------------------------------------------------------

def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, column: str = "embedding") -> DataFrame:
    """vec_id and v, the integer components of the vectors that are kept."""
    x = F.col(column)
    bad = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) >= float(LIMIT))
    kept = vectors.where((F.size(x) == dimensions) & ~F.exists(x, bad))
    return kept.select("vec_id", F.transform(x, lambda e: F.floor(e.cast("double") * SCALE).cast("int")).alias("v"))


def starts(table: DataFrame, k: int) -> np.ndarray:
    mark = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = table.select(mark.alias("mark"), "vec_id", "v").orderBy("mark", "vec_id", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64) if rows else np.zeros((0, 0), np.int64)


def _arrays(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.int64)


def _with_distances(table: DataFrame, simplex: Simplex) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                far = simplex.distances(_arrays(batch, "v"))
                lists = pa.ListArray.from_arrays(np.arange(0, far.size + 1, far.shape[1], np.int32), far.ravel())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), lists],
                                                 names=["vec_id", "v", "far"])
    return map_arrow(table, run, f"vec_id {table.schema['vec_id'].dataType.simpleString()}, v array<int>, far array<long>")


def _means(table: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """The centroids after one round."""
    def run(batches):
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            if batch.num_rows:
                v = _arrays(batch, "v")
                cluster, _, _ = nearest(v, _arrays(batch, "far"), centroids, simplex)
                np.add.at(sums, cluster, v)
                counts += np.bincount(cluster, minlength=len(centroids))
        used = np.flatnonzero(counts)
        size = sums.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, size)), pa.array(np.tile(np.arange(size), len(used))),
             pa.array(sums[used].ravel()), pa.array(np.repeat(counts[used], size))],
            names=["cluster", "place", "total", "n"])
    parts = map_arrow(table.select("v", "far"), run, "cluster long, place long, total long, n long")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    moved = centroids.copy()
    for r in parts.groupBy("cluster", "place").agg(exact("total"), exact("n")).collect():  # k x dimensions rows
        moved[r["cluster"], r["place"]] = int(r["total"]) // int(r["n"])
    return moved


def _assign(table: DataFrame, centroids: np.ndarray, simplex: Simplex) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cluster, best, met = nearest(_arrays(batch, "v"), _arrays(batch, "far"), centroids, simplex)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(cluster), pa.array(best),
                     pa.array([met] + [0] * (batch.num_rows - 1), pa.int64())],
                    names=["vec_id", "cluster", "distance", "compared"])
    return map_arrow(table, run, f"vec_id {table.schema['vec_id'].dataType.simpleString()}, cluster int, "
                                 "distance long, compared long")


def means(vectors: np.ndarray, cluster: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Floored means of the clusters; an empty one keeps its centroid."""
    out = centroids.copy()
    for j in np.unique(cluster):
        mine = vectors[cluster == j]
        out[j] = mine.sum(axis=0) // len(mine)
    return out


def sampled_centroids(table: DataFrame, centroids: np.ndarray, rounds: int, max_sample: int) -> np.ndarray:
    """Where the rounds lead on about ``max_sample`` vectors, twice as many at most."""
    share = min(1.0, max_sample / max(1, table.count()))
    rank = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = table.where(rank < share).select("v").limit(2 * max_sample).collect()
    sample = np.array([r["v"] for r in rows], np.int64)
    for _ in range(rounds if rows else 0):
        centroids = means(sample, squared(sample, centroids).argmin(axis=1), centroids)
    return centroids


def far_apart(points: np.ndarray, count: int) -> np.ndarray:
    """At most ``count`` of the points; each next one is the farthest from those
    chosen."""
    chosen = [0] if len(points) else []
    while len(chosen) < min(count, len(points)):
        gap = squared(points, points[chosen]).min(axis=1)
        chosen.append(int(gap.argmax()))
    return points[chosen]


def cluster(vectors: DataFrame, *, k: int = CENTROIDS, rounds: int = ROUNDS, pivots: int = PIVOTS,
            max_sample: int = MAX_SAMPLE, dimensions: int = DIMENSIONS, column: str = "embedding") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), compared (exact
    comparisons, a batch's on its first row), cluster_inertia, inertia, centroid."""
    scratch, spark = Scratch(vectors.sparkSession, "centroids"), vectors.sparkSession
    kept = scratch.write(whole_vectors(vectors, dimensions, column), "vectors")
    centroids = starts(kept, k)
    kind = kept.schema["vec_id"].dataType.simpleString()
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, compared long, "
                                         "cluster_inertia long, inertia long, centroid array<long>")
    later = sampled_centroids(kept, centroids, rounds, max_sample)
    simplex = Simplex(far_apart(np.vstack([centroids, later]), pivots))
    table = scratch.write(_with_distances(kept, simplex), "distances")
    scratch.drop("vectors")
    for _ in range(rounds):
        centroids = _means(table, centroids, simplex)
    found = scratch.write(_assign(table, centroids, simplex), "assigned")
    scratch.drop("distances")
    sums = {r["cluster"]: int(r["d"]) for r in  # k rows
            found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    total = sum(sums.values())
    ends = spark.createDataFrame([(j, Decimal(d), Decimal(total), centroids[j].tolist()) for j, d in sums.items()],
                                 "cluster int, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid array<long>")
    fits = lambda c: F.expr(f"try_cast({c} AS bigint)").alias(c)
    return found.join(F.broadcast(ends), "cluster").select(
        "vec_id", "cluster", "distance", "compared", fits("cluster_inertia"), fits("inertia"), "centroid")


def digest(centroid: Column) -> Column:
    return F.sha2(F.array_join(F.transform(centroid, lambda x: x.cast("string")), ","), 256)
