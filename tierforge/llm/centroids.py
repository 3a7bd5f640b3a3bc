"""Cluster vectors around centroids in exact integers, with simplex bounds in front.

Components become integers, so that sums, centroids and distances are exact and come out the same
however the rows are dealt. Each vector's distances to a few pivots are taken once; as the edges of
a simplex over the pivots they place the vector at an apex: coordinates in the pivots' hyperplane
and an altitude above it. The centroids get apexes too. Between two apexes the altitudes may lie on
the same side or on opposite ones, which bounds the true distance from below and from above; a
centroid whose lower bound is above the least upper bound is out, and only the rest are compared,
in integers. The bounds carry a margin for rounding, so they never decide a close case.

A round sends one row per centroid and component from each task; the driver holds the pivots and
the centroids, some kilobytes at any size. Vectors and apexes are stored once, read by every round,
and deleted at the end.

Defined cases: vectors that are null, of another length, or hold a null or non-finite component are
left out; equal rows are clustered one by one, and may seed several centroids, of which the ones
with higher numbers stay empty and keep their place; a null id seeds last; fewer vectors than
centroids make fewer centroids; no vectors give no rows. A component beyond 2**27 after scaling
raises an error, since distances would not fit 64 bits. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.scratch import scratch_dir, stage, staging

#: Beyond it, a squared distance over some 64 components might not fit 64 bits.
MOST = 1 << 27
#: Pivots that span the simplex; a vector's apex has as many coordinates.
PIVOTS = 16
#: A pivot closer to the hyperplane of those before it, relative to its distance from the first,
#: would make the coordinates unstable and is passed over.
FLAT = 0.05
#: Rounding that the bounds allow for, relative to the distances from the first pivot.
MARGIN = 1e-4


@dataclass(frozen=True)
class Simplex:
    """Pivots, and the corners of their simplex in coordinates of its own."""

    pivots: np.ndarray
    #: Row ``i`` is the corner of pivot ``i + 1``; the first one's is the origin.
    corners: np.ndarray

    @classmethod
    def over(cls, points: np.ndarray) -> Simplex:
        """The simplex of the points, less those that lie (nearly) in the plane of earlier ones."""
        simplex = cls(points[:1], np.zeros((0, 0)))
        for point in points[1:]:
            apex = simplex.apexes(point[None, :])[0]
            if apex[-1] > FLAT * np.sqrt((apex**2).sum()):
                held = len(simplex.corners)
                corners = np.zeros((held + 1, held + 1))
                corners[:held, :held] = simplex.corners
                corners[held] = apex
                simplex = cls(np.vstack([simplex.pivots, point[None, :]]), corners)
        return simplex

    def apexes(self, points: np.ndarray) -> np.ndarray:
        """Coordinates in the pivots' plane, and the altitude, from the distances to the pivots."""
        squares = np.stack([squared_distances(points, p) for p in self.pivots], axis=1).astype(float)
        n = len(self.corners)
        out = np.zeros((len(points), n + 1))
        norms = (self.corners**2).sum(axis=1)
        for i in range(n):
            known = out[:, :i] @ self.corners[i, :i]
            out[:, i] = (
                (squares[:, 0] - squares[:, i + 1] + norms[i]) / 2 - known
            ) / self.corners[i, i]
        rest = squares[:, 0] - (out[:, :n] ** 2).sum(axis=1)
        out[:, n] = np.sqrt(np.maximum(rest, 0.0))
        return out


def squared_distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    apart = points - centre
    return np.einsum("ij,ij->i", apart, apart)


def open_centroids(apexes: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Which centroids the bounds leave open, for each point."""
    plane = np.stack([((apexes[:, :-1] - c[:-1]) ** 2).sum(axis=1) for c in centres], axis=1)
    height, heights = apexes[:, -1:], centres[None, :, -1]
    low = np.sqrt(plane + (height - heights) ** 2)
    high = np.sqrt(plane + (height + heights) ** 2)
    spread = np.sqrt((apexes**2).sum(axis=1)) + np.sqrt((centres**2).sum(axis=1)).max()
    return low <= (high.min(axis=1) + MARGIN * spread + 1e-3)[:, None]


def nearest(
    points: np.ndarray, apexes: np.ndarray, centres: np.ndarray, centre_apexes: np.ndarray
) -> tuple[np.ndarray, int]:
    """The nearest centroid of each point (ties: smaller number), and how many were compared."""
    left = open_centroids(apexes, centre_apexes)
    best = left.argmax(axis=1)
    unsure = np.flatnonzero(left.sum(axis=1) > 1)
    least = np.full(len(unsure), np.iinfo(np.int64).max)
    compared = 0
    for number, centre in enumerate(centres):
        rows = np.flatnonzero(left[unsure, number])
        compared += len(rows)
        squares = squared_distances(points[unsure[rows]], centre)
        closer = squares < least[rows]
        least[rows[closer]] = squares[closer]
        best[unsure[rows[closer]]] = number
    return best, compared


def _rows(column: pa.Array, kind: type) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(kind) if len(column) else np.empty((0, 0), kind)


def integer_points(vectors: DataFrame, dims: int, scale: int, vector: str = "embedding") -> Column:
    """The vector as integers, null where it is not kept."""
    value = F.transform(F.col(vector), lambda x: x.cast("double"))
    # NaN is above every number.
    finite = F.forall(value, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    whole = F.transform(
        value,
        lambda x: F.when(
            F.abs(x) * scale < MOST, F.floor(x * scale).cast("int")
        ).otherwise(F.raise_error(F.lit("a component is too large for exact distances")).cast("int")),
    )
    return F.when((F.size(vector) == dims) & finite, whole)


def seed_order(vec_id: Column, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), vec_id.cast("string")), 256).asc_nulls_last()


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, np.ndarray, list[int]]:
    """``vec_id, cluster, distance`` of all kept vectors, the centroids, and the comparisons made.

    ``distance`` is squared. The last value lists, for each assignment, how many exact comparisons
    the bounds left. Rounds that could change nothing any more are not run.
    """
    spark = vectors.sparkSession
    kept = vectors.select("vec_id", integer_points(vectors, dims, scale).alias("point")).filter(
        F.col("point").isNotNull()
    )
    first = kept.orderBy(seed_order(F.col("vec_id"), seed), "point").limit(max(k, pivots)).collect()
    if not first:
        empty = kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty, np.empty((0, dims), np.int64), []
    seeds = np.array([r["point"] for r in first], np.int64)
    centres, simplex = seeds[:k].copy(), Simplex.over(seeds)

    with staging(spark):
        points = stage(_with_apexes(kept, simplex), "apexes")
        compared = []
        for _ in range(rounds):
            sums = _sums(points, centres, simplex.apexes(centres))
            compared.append(sums.pop((-1, -1), 0))
            new = centres.copy()
            for number in range(len(centres)):
                if count := sums.get((number, -1), 0):
                    new[number] = [sums[number, d] // count for d in range(dims)]
            if (new == centres).all():
                break
            centres = new
        path = scratch_dir(spark, "clusters")
        assigned = _assigned(points, centres, simplex.apexes(centres))
        assigned.write.parquet(path)
    return spark.read.schema(assigned.schema).parquet(path), centres, compared


def _with_apexes(kept: DataFrame, simplex: Simplex) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.float32())
        for batch in batches:
            apexes = simplex.apexes(_rows(batch.column("point"), np.int64)).astype(np.float32)
            offsets = np.arange(len(apexes) + 1, dtype=np.int32) * apexes.shape[1]
            column = pa.ListArray.from_arrays(offsets, apexes.ravel()).cast(kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("point"), column], ["vec_id", "point", "apex"]
            )

    kind = kept.schema["vec_id"].dataType.simpleString()
    return kept.mapInArrow(work, f"vec_id {kind}, point array<int>, apex array<float>")


def _sums(points: DataFrame, centres: np.ndarray, apexes: np.ndarray) -> dict[tuple[int, int], int]:
    """Sums by (cluster, component), counts at component -1, comparisons at (-1, -1)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros_like(centres), np.zeros(len(centres), np.int64)
        compared = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            point = _rows(batch.column("point"), np.int64)
            best, more = nearest(point, _rows(batch.column("apex"), float), centres, apexes)
            compared += more
            counts += np.bincount(best, minlength=len(centres))
            for number in np.unique(best):
                totals[number] += point[best == number].sum(axis=0)
        dims = centres.shape[1]
        number, place = np.divmod(np.arange(totals.size), dims)
        all_numbers = np.concatenate([number, np.arange(len(centres)), [-1]])
        all_places = np.concatenate([place, np.full(len(centres), -1), [-1]])
        values = np.concatenate([totals.ravel(), counts, [compared]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(all_numbers, pa.int32()), pa.array(all_places, pa.int32()), pa.array(values)],
            ["cluster", "place", "value"],
        )

    partial = points.select("point", "apex").mapInArrow(work, "cluster int, place int, value long")
    summed = partial.groupBy("cluster", "place").agg(F.sum("value").alias("value")).collect()
    return {(r["cluster"], r["place"]): r["value"] for r in summed}


def _assigned(points: DataFrame, centres: np.ndarray, apexes: np.ndarray) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            point = _rows(batch.column("point"), np.int64)
            best, _ = nearest(point, _rows(batch.column("apex"), float), centres, apexes)
            distance = np.empty(len(best), np.int64)
            for number in np.unique(best):
                rows = best == number
                distance[rows] = squared_distances(point[rows], centres[number])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(best, pa.int32()), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )

    kind = points.schema["vec_id"].dataType.simpleString()
    return points.mapInArrow(work, f"vec_id {kind}, cluster int, distance long")


def with_inertia(assigned: DataFrame, centres: np.ndarray) -> DataFrame:
    """The assignment with ``cluster_inertia, inertia, centroid_sha256`` (a row per cluster is read)."""
    sums = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centres]

    def of_cluster(values: list, kind: str) -> Column:
        held = F.array(*[F.lit(v).cast(kind) for v in values]).cast(f"array<{kind}>")
        return F.get(held, F.col("cluster"))

    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster([sums.get(n, 0) for n in range(len(centres))], "long").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        of_cluster(names, "string").alias("centroid_sha256"),
    )
