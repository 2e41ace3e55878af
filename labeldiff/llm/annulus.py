"""Centroid clustering of whole-number vectors by Lloyd's rounds, each assignment by annulus search.

A component counts as floor(scale * x). In a round the centroids are sorted by norm. A vector's upper bound is its
distance to the centroid whose norm is nearest its own; no centroid can be nearer whose norm differs from the vector's
by more than that, so two binary searches in the sorted norms leave the centroids of an annulus. Bounds are widened by
more than floating point may lose, so ties on the edge stay inside. The candidates are then compared exactly, in whole
numbers: nearest first, ties to the smaller number.

Vectors are scaled and written once; a round is one scan of them, with the centroids in a broadcast (clusters x
components numbers) and sums as the only result. A task adds up its own vectors, Spark adds up the tasks' sums, and what
reaches the driver is a number for each cluster and component. Sums travel in limbs of 60 bits, so they are exact
whatever the components' size, and means are exact floors. A common vector costs no more than any other: nothing is
shuffled by vector.

Defined results: vectors that are null, have another number of components, or hold null or non-finite ones (also after
scaling) take no part; repeated rows count each; rows without id take part and hash as those with the largest; equal
hashes start in order of their components; with fewer vectors than clusters there are as many clusters as vectors; an
empty table gives no rows; a distance beyond a long counts as the largest long, and so does a sum; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labeldiff.llm.common import received, shipped, stored

#: Rows that are compared at once; bits of a limb; largest long.
ROWS, LIMB, LONG = 2048, 60, 2**63 - 1
#: Relative width by which bounds are widened.
SLACK = 1e-9


def scaled(vectors: DataFrame, width: int, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """(vec_id, q): floor(scale * x) as whole doubles, of the vectors that take part."""
    q = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double") * F.lit(scale))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), q.alias("q")).where(F.coalesce(F.size("q") == width, F.lit(False)))
    rows = rows.where(F.forall("q", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    # Beyond 2^53 a double is whole already, and Spark's floor gives a long. Adding 0 turns -0 into 0.
    return rows.select("vec_id", F.transform("q", lambda x: F.when(F.abs(x) < float(2**53), F.floor(x).cast("double")).otherwise(x) + F.lit(0.0)).alias("q"))


def norms(rows: np.ndarray) -> np.ndarray:
    """Euclidean norms without overflow of squares."""
    top = np.abs(rows).max(1, initial=0.0)
    unit = np.where(top > 0, top, 1.0)
    with np.errstate(over="ignore"):
        return top * np.sqrt(((rows / unit[:, None]) ** 2).sum(1))


class Centroids:
    """Whole-number centroids, sorted by norm."""

    def __init__(self, rows: list[list[int]], width: int):
        self.rows, self.width = rows, width
        self.near = np.array([[float(x) for x in r] for r in rows], dtype=np.float64).reshape(len(rows), width)
        size = norms(self.near)
        self.order = np.argsort(size, kind="stable")
        self.norm = size[self.order]
        #: Components below this have distances that a long holds.
        self.small = float(np.sqrt(2.0**62 / max(1, width)) / 2)
        fits = max((abs(x) for r in rows for x in r), default=0) < self.small
        self.whole = np.array(rows, dtype=np.int64).reshape(len(rows), width) if fits else None

    def annulus(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end, in the sorted norms, of the centroids that may be nearest to each row."""
        own = norms(rows)
        at = np.searchsorted(self.norm, own)
        left, right = np.maximum(at - 1, 0), np.minimum(at, len(self.norm) - 1)
        with np.errstate(over="ignore", invalid="ignore"):
            probe = np.where(np.abs(own - self.norm[left]) <= np.abs(self.norm[right] - own), left, right)
            bound = norms(rows - self.near[self.order[probe]])
            reach = bound + SLACK * (bound + own + self.norm[probe]) + SLACK
            low, high = own - reach, own + reach
        low, high = np.where(np.isfinite(low), low, -np.inf), np.where(np.isfinite(high), high, np.inf)
        return np.searchsorted(self.norm, low, side="left"), np.searchsorted(self.norm, high, side="right")

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Number and squared distance of each row's nearest centroid. rows: at most ROWS."""
        first, end = self.annulus(rows)
        best, owner = np.full(len(rows), LONG, dtype=np.int64), np.full(len(rows), len(self.rows), dtype=np.int64)
        fits = np.abs(rows).max(1, initial=0.0) < self.small if self.whole is not None else np.zeros(len(rows), dtype=bool)
        whole = np.where(fits[:, None], rows, 0).astype(np.int64)
        for j in range(int((end - first)[fits].max(initial=0))):
            on = np.flatnonzero(fits & (first + j < end))
            number = self.order[first[on] + j]
            far = ((whole[on] - self.whole[number]) ** 2).sum(1)
            better = (far < best[on]) | ((far == best[on]) & (number < owner[on]))
            best[on[better]], owner[on[better]] = far[better], number[better]
        found = best.tolist()
        for i in np.flatnonzero(~fits).tolist():
            own = [int(x) for x in rows[i]]
            found[i], owner[i] = min((sum((a - b) ** 2 for a, b in zip(own, self.rows[c], strict=True)), c) for c in self.order[first[i] : end[i]].tolist())
        return owner, found


def parts(batches: Iterator[pa.RecordBatch], width: int, at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            yield part, part.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def summing(model):
    """For mapInArrow over (q): the task's sums by cluster, component (-1: rows) and limb."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = received(model)
        total: dict[tuple[int, int], int] = defaultdict(int)
        for _, rows in parts(batches, centroids.width, 0):
            owner, _ = centroids.nearest(rows)
            for c in np.unique(owner).tolist():
                own = rows[owner == c]
                total[(c, -1)] += len(own)
                if np.abs(own).max(initial=0.0) < 2.0**51:
                    sums = own.astype(np.int64).sum(0).tolist()
                else:
                    sums = [sum(int(x) for x in column) for column in own.T]
                for d, s in enumerate(sums):
                    total[(c, d)] += s
        out = []
        for (c, d), s in total.items():
            limb = 0
            while not -(2**LIMB) < s < 2**LIMB:
                out.append((c, d, limb, Decimal(s & (2**LIMB - 1))))
                s, limb = s >> LIMB, limb + 1
            out.append((c, d, limb, Decimal(s)))
        c, d, limb, s = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(d, pa.int32()), pa.array(limb, pa.int32()), pa.array(s, pa.decimal128(38, 0))], names=["cluster", "d", "limb", "s"])

    return run


def moved(rows: DataFrame, centroids: list[list[int]], width: int) -> list[list[int]]:
    """The centroids after one round."""
    model = shipped(rows.sparkSession, Centroids(centroids, width))
    sums = rows.select("q").mapInArrow(summing(model), "cluster int, d int, limb int, s decimal(38,0)").groupBy("cluster", "d", "limb").agg(F.sum("s").alias("s")).collect()
    model.destroy()
    total: dict[tuple[int, int], int] = defaultdict(int)
    for r in sums:
        total[(r.cluster, r.d)] += int(r.s) << (LIMB * r.limb)
    return [[total[(c, d)] // total[(c, -1)] for d in range(width)] if total[(c, -1)] else own for c, own in enumerate(centroids)]


def assigning(model):
    """For mapInArrow over (vec_id, q): (vec_id, cluster, distance)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = received(model)
        for part, rows in parts(batches, centroids.width, 1):
            owner, far = centroids.nearest(rows)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(owner.astype(np.int32)), pa.array([min(x, LONG) for x in far], pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def starts(rows: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors whose ids hash lowest."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [[int(x) for x in r.q] for r in rows.orderBy(hashed.asc_nulls_last(), "q").limit(k).select("q").collect()]


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, seed: str = "3", id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 1024.0) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance) of every vector that takes part, the final centroids)."""
    rows = stored(scaled(vectors, width, id_col, vec_col, scale), "annulus-vectors")
    centroids = starts(rows, k, seed)
    for _ in range(rounds if centroids else 0):
        after = moved(rows, centroids, width)
        if after == centroids:
            break
        centroids = after
    schema = "vec_id long, cluster int, distance long"
    if not centroids:
        return empty(rows.sparkSession, schema), centroids
    return stored(rows.mapInArrow(assigning(shipped(rows.sparkSession, Centroids(centroids, width))), schema), "annulus-clusters"), centroids


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def report(vectors: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, seed: str = "3") -> DataFrame:
    """Every vector's cluster and distance, with the sums of distances of its cluster and of all, and the digest of its centroid."""
    found, centroids = cluster(vectors, k, rounds, width, seed)
    spark = vectors.sparkSession
    said = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids)]
    digests = spark.createDataFrame(said, "cluster int, centroid_sha256 string")
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    inertia = spark.createDataFrame([(c, min(s, LONG), min(sum(sums.values()), LONG)) for c, s in sums.items()], "cluster int, cluster_inertia long, inertia long")
    about = digests.join(inertia, "cluster")
    # A row for each cluster: bounded by k.
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
