"""Centroid clustering of integer vectors, with centroids filtered by n-simplex projection.

A few pivots among the first centroids span a simplex. The distances of a vector to them, computed once and stored
with it, make it the apex over that simplex: its projection on the pivots' span, and the height above it. Of two
apexes, the Euclidean distance is a lower bound of the vectors' distance; with one height turned down it is an upper
bound. A centroid whose lower bound exceeds the least upper bound cannot be nearest; the others are compared by exact
64-bit integers. Each round sends at most ``k`` sums per task and reads the stored vectors once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import vectors
from tidemill.llm.workers import lean
from tidemill.sinks.layers import discard, store

#: Pivots of the simplex, at most. One is left out where it adds less height than ``_FLAT`` of the longest distance.
PIVOTS = 16
_FLAT = 1e-2
#: Slack of both bounds against rounding, as a share of the squared distances to the first pivot.
_SLACK = 1e-6
#: Largest integer component whose squared distances stay exact in 64 bits (up to 512 components).
LARGEST = 1 << 26
_PAIRS = 8192


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two integer matrices, row by row."""
    difference = a - b
    return np.einsum("ij,ij->i", difference, difference)


class Simplex:
    """Apex coordinates over pivots chosen greedily by their height over those chosen before."""

    def __init__(self, points: np.ndarray, most: int = PIVOTS):
        self.pivots, self.inverse, self.norms = points[:1], np.zeros((0, 0)), np.zeros(0)
        base, scale = np.zeros((0, 0)), max(1.0, float(max(squared(points, points[0]))))
        while len(self.pivots) < min(most, len(points)):
            apexes = self.apexes(points)
            best = int(apexes[:, -1].argmax())
            if apexes[best, -1] ** 2 <= _FLAT**2 * scale:
                break
            n = len(base)
            grown = np.zeros((n + 1, n + 1))
            grown[:n, :n], grown[n] = base, apexes[best]
            base = grown
            self.pivots = np.vstack([self.pivots, points[best]])
            self.inverse, self.norms = np.linalg.inv(base), (base**2).sum(axis=1)

    def apexes(self, points: np.ndarray) -> np.ndarray:
        """A row per point: coordinates in the pivots' span, then the height."""
        far = np.stack([squared(points, p) for p in self.pivots], axis=1).astype(float)
        first = far[:, :1]
        flat = ((first + self.norms - far[:, 1:]) / 2) @ self.inverse.T
        height = np.sqrt(np.maximum(first[:, 0] - (flat**2).sum(axis=1), 0))
        return np.hstack([flat, height[:, None]])


def possible(apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """For each vector and centroid, given by their apexes, whether the bounds let the centroid be nearest."""
    flat, height = apexes[:, :-1], apexes[:, -1:]
    other, top = centroids[:, :-1], centroids[:, -1]
    base = (flat**2).sum(axis=1)[:, None] + (other**2).sum(axis=1) - 2 * flat @ other.T
    slack = _SLACK * ((apexes**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1))
    lower, upper = base + (height - top) ** 2 - slack, base + (height + top) ** 2 + slack
    return lower <= upper.min(axis=1)[:, None]


def nearest(points: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (of several, the least number) and the squared distance."""
    rows, numbers = np.nonzero(possible(apexes, tops))
    far = np.concatenate([squared(points[rows[i : i + _PAIRS]], centroids[numbers[i : i + _PAIRS]]) for i in range(0, len(rows), _PAIRS)])
    starts = np.searchsorted(rows, np.arange(len(points)))
    least = np.minimum.reduceat(far, starts)
    hits = np.flatnonzero(far == least[rows])
    first = hits[np.unique(rows[hits], return_index=True)[1]]
    return numbers[first].astype(np.int32), least


def _project(points: DataFrame, simplex: Simplex, width: int) -> DataFrame:
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apexes = simplex.apexes(vectors.matrix(batch.column("v"), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, vectors.lists(apexes)], names=["vec_id", "v", "apex"])

    schema = f"vec_id {points.schema['vec_id'].dataType.simpleString()}, v array<long>, apex array<double>"
    return points.mapInArrow(lean(project), schema)


def _sums(stored: DataFrame, simplex: Simplex, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Of each centroid that is nearest to any vector, their number and componentwise sums."""
    width, tops = centroids.shape[1], simplex.apexes(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros(centroids.shape, dtype=np.int64), np.zeros(len(centroids), dtype=np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(range(len(counts)), pa.int32()), pa.array(counts), vectors.lists(totals)], names=["cluster", "n", "s"])

        for batch in batches:
            if not batch.num_rows:
                continue
            points = vectors.matrix(batch.column("v"), width)
            number, _ = nearest(points, vectors.matrix(batch.column("apex"), len(simplex.pivots)), centroids, tops)
            np.add.at(totals, number, points)
            counts += np.bincount(number, minlength=len(counts))
            if counts.sum() > 1 << 32:  # sums of larger runs could leave 64 bits
                yield out()
                totals[:], counts[:] = 0, 0
        yield out()

    parts = stored.select("v", "apex").mapInArrow(lean(add), "cluster int, n long, s array<long>").filter("n > 0")
    exact = parts.select("cluster", "n", F.posexplode("s").alias("i", "s")).groupBy("cluster", "i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    )
    found: dict[int, tuple[int, list[int]]] = {}
    for row in exact.collect():  # k rows for each component
        found.setdefault(row["cluster"], (row["n"], [0] * width))[1][row["i"]] = int(row["s"])
    return found


def cluster(embeddings: DataFrame, k: int = 40, rounds: int = 5, width: int = 64, scale: int = 256, salt: str = "2:", vector: str = "embedding") -> DataFrame:
    """One row per vector kept: ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Kept are vectors of ``width`` components, none null or non-finite; a component x becomes floor(scale * x). Centroids
    0, 1, ... start as the ``k`` vectors with the least hexadecimal SHA-256 of ``salt`` and their ``vec_id`` (null: the empty
    text), ties by the integer vector; with fewer vectors there are fewer centroids. Each round assigns every vector to its
    nearest centroid (ties: least number) and replaces each non-empty centroid by the floor of its vectors' mean; then all are assigned
    once more. Repeated rows and ids are vectors of their own; other columns are not read; an empty table gives an
    empty one. An integer component beyond ``LARGEST`` fails the job, as distances would leave 64 bits.
    """
    kept = embeddings.select("vec_id", F.col(vector).alias("e")).filter(vectors.sound(F.col("e"), width))

    def whole(x):
        y = F.floor(F.lit(float(scale)) * x.cast("double"))
        small = F.abs(x.cast("double")) * scale < LARGEST
        return F.when(small, y.cast("long")).otherwise(F.raise_error(F.lit("a component is too large for exact distances")).cast("long"))

    points = kept.select("vec_id", F.transform("e", whole).alias("v"))
    mark = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    seeds = [row["v"] for row in points.orderBy(mark, "v").limit(k).collect()]
    simplex = Simplex(np.array(seeds, dtype=np.int64)) if seeds else None
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, cluster int, distance long"
    if not seeds:
        empty = f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string"
        return embeddings.sparkSession.createDataFrame([], empty)
    centroids = np.array(seeds, dtype=np.int64)
    stored = store(_project(points, simplex, width), "projected")
    for _ in range(rounds):
        for number, (n, sums) in _sums(stored, simplex, centroids).items():
            centroids[number] = [s // n for s in sums]
    tops, n_pivots = simplex.apexes(centroids), len(simplex.pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = vectors.matrix(batch.column("v"), width)
                number, far = nearest(points, vectors.matrix(batch.column("apex"), n_pivots), centroids, tops)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number), pa.array(far)], names=["vec_id", "cluster", "distance"])

    assigned = store(stored.mapInArrow(lean(assign), schema), "assigned")
    discard(stored)
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r["s"]) for r in sums)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(r["cluster"], int(r["s"]), total, digests[r["cluster"]]) for r in sums]
    about = embeddings.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = assigned.join(F.broadcast(about), "cluster")  # k rows at most
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
