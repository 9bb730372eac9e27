"""Centroid clustering with Orchard's nearest-neighbour search.

Every centroid has a list of the others, sorted by their distance to it.  A vector
starts at some centroid and walks down its list.  A centroid on the list that is
closer becomes the current one, and the walk goes on in *its* list; centroids
already measured are marked and skipped.  By the triangle inequality nothing on the
list beyond twice the current distance can be closer, so the walk stops at the first
entry strictly beyond.  Distances are squared whole numbers, so "twice" is four
times, comparisons are exact, and a tie is always met and goes to the smaller number.

The walk runs on all vectors of a batch at once.  A round sends the centroids to
the tasks (``k`` vectors, whatever the table) and gets back one row of sums a
centroid and task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import stored
from contrail.llm.vectors import matrix, quantised

#: Vectors that walk together.
BATCH = 1 << 12


class Orchard:
    """Centroids with their sorted neighbour lists."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        gaps = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
        self.near = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.near, axis=1)
        self.start = int(gaps.max(axis=1).argmin())    # the most central one
        #: Distances measured, of those a plain search would measure.
        self.measured = 0

    def _distance(self, vectors: np.ndarray, which: np.ndarray) -> np.ndarray:
        self.measured += len(which)
        apart = vectors - self.centroids[which]
        return np.einsum("ij,ij->i", apart, apart)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of, and squared distance to, each vector's nearest centroid."""
        n, k = len(vectors), len(self.centroids)
        current = np.full(n, self.start)
        best = self._distance(vectors, current)
        visited = np.zeros((n, k), bool)
        visited[:, self.start] = True
        place, walking = np.zeros(n, np.int64), np.arange(n)
        while len(walking):
            walking = walking[place[walking] < k]
            lists, places = current[walking], place[walking]
            # squared: strictly beyond twice the distance
            inside = self.gaps[lists, places] <= 4 * best[walking]
            walking = walking[inside]
            other = self.near[lists[inside], places[inside]]
            place[walking] += 1
            fresh = ~visited[walking, other]
            rows, other = walking[fresh], other[fresh]
            visited[rows, other] = True
            distance = self._distance(vectors[rows], other)
            closer = (distance < best[rows]) | ((distance == best[rows]) & (other < current[rows]))
            rows, other = rows[closer], other[closer]
            current[rows], best[rows], place[rows] = other, distance[closer], 0
        return current, best


def _vectors(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, batch.num_rows, BATCH):
        piece = batch.slice(at, BATCH)
        yield piece, matrix(piece.column(1), size)


def _sums(centroids: np.ndarray):
    """Vectors -> one row a centroid: how many are nearest to it, and their sum."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchard = Orchard(centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            for _, vectors in _vectors(batch, size):
                cluster, _ = orchard.nearest(vectors)
                count += np.bincount(cluster, minlength=k)
                order = np.argsort(cluster, kind="stable")
                some, first = np.unique(cluster[order], return_index=True)
                total[some] += np.add.reduceat(vectors[order], first, axis=0)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(count[held]), pa.array(list(total[held]), pa.list_(pa.int64()))],
            names=["cluster", "n", "total"])

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchard = Orchard(centroids)
        for batch in batches:
            for piece, vectors in _vectors(batch, centroids.shape[1]):
                cluster, distance = orchard.nearest(vectors)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                    names=["vec_id", "cluster", "distance"])

    return run


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of smallest SHA-256 of ``seed:id``, in that order; of equal
    ids the smaller vector goes first, a null id counts after all others."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    taken = rows.select("v", key.alias("key")).orderBy(F.col("key").asc_nulls_last(), "v").limit(k)
    return np.array([r["v"] for r in taken.collect()], np.int64)


def refined(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every centroid becomes the floor of its vectors' mean; one that
    is nearest to none stays.  ``k`` rows come to the driver."""
    size = centroids.shape[1]
    found = rows.mapInArrow(_sums(centroids), "cluster int, n long, total array<long>").groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(j))).alias(f"t{j}") for j in range(size)])
    out = centroids.copy()
    for row in found.collect():
        out[row["cluster"]] = [row[f"t{j}"] // row["n"] for j in range(size)]
    return out


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, size: int = 64,
            seed: int = 2, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per vector: ``vec_id``, ``cluster`` (number of the nearest centroid
    after ``rounds`` rounds), ``distance`` (squared), ``cluster_inertia`` and
    ``inertia`` (distances summed over the cluster and over all) and ``centroid``
    (its components).

    Vectors are ``floor(scale * x)`` of the components.  Vectors that are null, hold a
    null or non-finite component or have not exactly ``size`` components are left out;
    repeated rows each count and each get their row; fewer vectors than ``k`` give as
    many centroids.  A component of 2^27 or more after scaling fails the job, as
    distances would pass a long.  Ties go to the centroid of the smaller number.  An
    empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vec_col, scale, size)
    far = F.exists("v", lambda x: F.abs(x) >= 1 << 27)
    rows = stored(rows.withColumn("v", F.when(far, F.raise_error(F.lit(
        f"a component times {scale} reaches 2^27")).cast("array<bigint>")).otherwise(F.col("v"))))
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, "
                                         "inertia long, centroid array<long>")
    for _ in range(rounds):
        centroids = refined(rows, centroids)
    found = stored(rows.mapInArrow(_assigned(centroids), "vec_id long, cluster int, distance long"))
    # k rows at most, to the driver and back
    each = dict(found.groupBy("cluster").agg(F.sum("distance")).collect())
    whole = sum(each.values())
    table = spark.createDataFrame(
        [(i, d, whole, [int(x) for x in centroids[i]]) for i, d in each.items()],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest(centroid: str = "centroid"):
    """SHA-256 of the components as decimal integers joined by commas."""
    return F.sha2(F.concat_ws(",", F.transform(centroid, lambda x: x.cast("string"))).cast("binary"), 256)

