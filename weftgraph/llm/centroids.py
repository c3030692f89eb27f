"""Centroid clustering in exact integers, screened by block norms.

A vector and a centroid are cut into ``SEGMENTS`` segments.  By Cauchy and Schwarz their squared
distance is at least the sum of (|x_s| - |c_s|)^2 over segments, so the norms of segments, stored
once with each vector, give a bound from 16 numbers instead of 64.  Centroids are taken by rising
bound; those whose bound exceeds the best distance so far are pruned, and the others get their
exact distance in integers.  The bound is lowered by more than its rounding error, so the
result is that of comparing all.

A round is one pass over the stored vectors; what returns to the driver is one sum for each
centroid and component.  Those partial sums are added by Spark.

Cases: vectors that are null, not of ``DIM`` components, or hold null or non-finite ones are left
out; equal rows count once each; vectors with an equal id (or none: those come last) start as
centroids in the order of their stored bytes; fewer than ``k`` vectors give as many centroids;
integers are exact at any size (beyond 2^27 without the screen), and distances and sums over the
range of a long are given as its largest value; extra columns are left alone; no rows give none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

DIM, K, ROUNDS, SALT, SEGMENTS = 64, 40, 5, "2", 16
#: Below this, 64 squared differences stay within 2^62.
NARROW = 1 << 27
LONG = (1 << 63) - 1
#: More than the rounding error of a bound, as a share of both squared norms.
SLACK = 1e-12

_STORED = pa.schema([("vec_id", pa.int64()), ("vector", pa.binary()), ("norms", pa.binary()), ("wide", pa.string())])


def whole(x: float) -> int:
    """floor(256 x), exact for every finite double."""
    return math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x)


def segment_norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).reshape(len(x), SEGMENTS, -1).sum(axis=2))


class Centroids:
    """Centroids and their segment norms; ``nearest`` finds (number, squared distance) of each vector."""

    def __init__(self, rows: list[list[int]]):
        self.rows = rows
        self.narrow = np.array([max(map(abs, r)) < NARROW for r in rows])
        self.ints = np.array([r if ok else [0] * len(r) for r, ok in zip(rows, self.narrow, strict=True)], np.int64)
        # a wide centroid is at least NARROW away from zero in one segment
        self.norms = segment_norms(self.ints)

    def bounds(self, norms: np.ndarray) -> np.ndarray:
        """Lower bounds of squared distances to all centroids; those to wide ones are 0."""
        total = (norms**2).sum(axis=1)[:, None] + (self.norms**2).sum(axis=1)
        low = total - 2 * norms @ self.norms.T - SLACK * total
        low[:, ~self.narrow] = 0
        return low

    def exact(self, x: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Squared distances of rows to the centroids of these numbers; beyond a long its largest value."""
        apart = x - self.ints[number]
        out = np.einsum("ij,ij->i", apart, apart)
        for i in np.flatnonzero(~self.narrow[number]):
            out[i] = min(LONG, far(x[i].tolist(), self.rows[number[i]]))
        return out

    def nearest(self, x: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number, squared distance, exact distances taken) of vectors below ``NARROW``; ties go to the smaller number."""
        low = self.bounds(norms)
        order = np.argsort(low, axis=1, kind="stable")
        low = np.take_along_axis(low, order, axis=1)
        best, at, taken = np.full(len(x), LONG), np.full(len(x), len(self.rows)), np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for t in range(len(self.rows)):
            rows = rows[low[rows, t] <= best[rows]]
            if not len(rows):
                break
            number = order[rows, t]
            d = self.exact(x[rows], number)
            better = (d < best[rows]) | (d == best[rows]) & (number < at[rows])
            best[rows[better]], at[rows[better]] = d[better], number[better]
            taken[rows] += 1
        for i in np.flatnonzero(best == LONG):  # beyond the range of a long
            at[i], d = self.nearest_wide(x[i].tolist())
            best[i] = min(d, LONG)
        return at, best, taken

    def nearest_wide(self, x: list[int]) -> tuple[int, int]:
        d, number = min((far(x, c), j) for j, c in enumerate(self.rows))
        return number, d


def far(a: list[int], b: list[int]) -> int:
    return sum((u - v) ** 2 for u, v in zip(a, b, strict=True))


def prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, the integers (as 64-bit numbers; ``wide`` as text where they are too large for the screen) and segment norms."""
    x = F.col("embedding").cast("array<double>")
    good = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding"))
    good = good.where((F.size("embedding") == DIM) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch["embedding"].flatten().to_numpy(zero_copy_only=False).reshape(n, DIM)
            large = np.abs(x).max(axis=1) >= NARROW // 256
            q = np.floor(256 * np.where(large[:, None], 0, x)).astype(np.int64)
            wide = [",".join(str(whole(v)) for v in r) if big else None for r, big in zip(x.tolist(), large, strict=True)] if large.any() else [None] * n
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array([r.tobytes() for r in q], pa.binary()), pa.array([r.tobytes() for r in segment_norms(q)], pa.binary()), pa.array(wide, pa.string())], schema=_STORED)

    return good.mapInArrow(work, "vec_id long, vector binary, norms binary, wide string")


def parsed(vector: bytes, wide: str | None) -> list[int]:
    return list(map(int, wide.split(","))) if wide is not None else np.frombuffer(vector, "<i8").tolist()


def _assign(batches: Iterator[pa.RecordBatch], centroids: Centroids) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, list[int]]]]]:
    """Of each batch: (batch, integers, numbers, distances, exact distances taken, [(row, integers) of wide rows])."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.frombuffer(b"".join(batch["vector"].to_pylist()), "<i8").reshape(batch.num_rows, -1)
        norms = np.frombuffer(b"".join(batch["norms"].to_pylist()), "<f8").reshape(batch.num_rows, -1)
        at, best, taken = centroids.nearest(x, norms)
        wide = [(i, parsed(b"", w)) for i, w in enumerate(batch["wide"].to_pylist()) if w is not None] if batch["wide"].null_count < batch.num_rows else []
        for i, row in wide:
            at[i], d = centroids.nearest_wide(row)
            best[i], taken[i] = min(d, LONG), len(centroids.rows)
        yield batch, x, at, best, taken, wide


def limbs(v: int) -> Iterator[tuple[int, int]]:
    """(exponent, value) with v = sum of value * 2^(32 exponent), every value a long."""
    k = 0
    while abs(v) >= 1 << 62:
        yield k, v & 0xFFFFFFFF
        v, k = v >> 32, k + 1
    yield k, v


_SUMS = "cluster int, component int, limb int, value long"


def moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: exact floor of the mean of each one's vectors."""
    known = rows.sparkSession.sparkContext.broadcast(Centroids(centroids))  # k * DIM integers

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dim = len(known.value.rows), len(known.value.rows[0])
        sums, count, large = np.zeros((k, dim), np.int64), np.zeros(k, np.int64), {}
        for _, x, at, _, _, wide in _assign(batches, known.value):
            count += np.bincount(at, minlength=k)
            order = np.argsort(at, kind="stable")
            found, first = np.unique(at[order], return_index=True)
            sums[found] += np.add.reduceat(x[order], first, axis=0)
            for i, row in wide:
                large[at[i]] = [a + b for a, b in zip(large.get(at[i], [0] * dim), row, strict=True)]
        out = [(j, -1, 0, int(count[j])) for j in range(k) if count[j]]
        for j in np.flatnonzero(count).tolist():
            total = [a + b for a, b in zip(sums[j].tolist(), large.get(j, [0] * dim), strict=True)]
            out += [(j, c, e, v) for c, whole_sum in enumerate(total) for e, v in limbs(whole_sum)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["cluster", "component", "limb", "value"])

    added = rows.mapInArrow(work, _SUMS).groupBy("cluster", "component", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    sums: dict[tuple[int, int], int] = {}
    for r in added.collect():
        sums[r.cluster, r.component] = sums.get((r.cluster, r.component), 0) + (int(r.value) << 32 * r.limb)
    return [[sums[j, c] // sums[j, -1] for c in range(len(row))] if (j, -1) in sums else row for j, row in enumerate(centroids)]


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, salt: str = SALT) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, n_exact (distances taken in full) of each vector."""
    spark = vectors.sparkSession
    rows = stored(prepared(vectors))
    drawn = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(drawn.asc_nulls_last(), F.col("wide").asc_nulls_first(), "vector").limit(k).collect()
    centroids = [parsed(r.vector, r.wide) for r in first]
    out = "vec_id long, cluster int, distance long, n_exact long"
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, n_exact long")
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    known = spark.sparkContext.broadcast(Centroids(centroids))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, at, best, taken, _ in _assign(batches, known.value):
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(at.astype(np.int32)), pa.array(best), pa.array(taken)], ["vec_id", "cluster", "distance", "n_exact"])

    found = stored(rows.mapInArrow(work, out))
    sums = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    whole_sum = min(LONG, sum(sums.values()))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    known_sums = spark.createDataFrame([(j, min(LONG, sums[j]), whole_sum, digest[j]) for j in sorted(sums)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(known_sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_exact")  # at most k rows
