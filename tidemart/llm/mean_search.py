"""Centroid clustering of integer vectors: equal-average equal-variance nearest-centroid search, exact throughout."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import stored

# Components up to this size, in vectors up to this length, keep every square below 2^63; others go as Python integers.
FAST = 1 << 24
FAST_DIM = 64
# Sums leave a task in signed digits of this base, which Spark adds as longs without overflow over 2^22 tasks.
DIGIT = 1 << 40
LONG = (1 << 63) - 1


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as int64 where every result is small, else as Python integers; ``scale`` is a power of two."""
    if np.abs(values).max(initial=0.0) * scale < FAST:
        return np.floor(values * scale).astype(np.int64)
    exact = [math.floor(x * scale) if abs(x) < 2.0**53 else int(x) * scale for x in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def roots(moments: np.ndarray) -> np.ndarray:
    """Integer square roots, rounded down."""
    if moments.dtype == object:
        return np.array([math.isqrt(int(m)) for m in moments], dtype=object)
    # The square root of a 64-bit integer in floating point is at most one off after rounding down.
    root = np.sqrt(moments.astype(np.float64)).astype(np.int64)
    root -= root * root > moments
    return root + ((root + 1) * (root + 1) <= moments)


def spread(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of components, and the root of ``dim * sum of squares - sum * sum`` rounded down (dim times the deviation)."""
    sums = vectors.sum(axis=1)
    return sums, roots(vectors.shape[1] * (vectors * vectors).sum(axis=1) - sums * sums)


def nearest(vectors: np.ndarray, centroids: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each vector (ties: the smaller number) and its squared distance.

    Centroids lie in order of their mean.  Each vector scans outward from its own mean, always the side whose mean is closer; with
    S the sums, V the deviations (times dim) and d the squared distance, dim * d >= (S - S')^2 + (V - V')^2.  When the means alone
    exceed the best distance, that side ends; when both together do, the centroid is skipped.  All of it is integer arithmetic, the
    deviations rounded so that a bound is never too high, and only strictly worse centroids are rejected.
    """
    k, (n, dim) = len(centroids), vectors.shape
    wide = vectors.dtype == object or max(abs(c) for row in centroids for c in row) > FAST or dim > FAST_DIM
    if wide:
        vectors = vectors.astype(object)
    points = np.array(centroids, dtype=object if wide else np.int64).reshape(k, dim)
    point_sums, point_roots = spread(points)
    order = np.array(sorted(range(k), key=lambda c: (point_sums[c], c)))
    points, point_sums, point_roots = points[order], point_sums[order], point_roots[order]
    sums, deviations = spread(vectors)
    right = np.searchsorted(point_sums, sums) if not wide else np.array([int((point_sums < s).sum()) for s in sums], dtype=np.int64)
    left = right - 1
    best = np.full(n, -1, dtype=object if wide else np.int64)
    chosen = np.full(n, k, dtype=np.int64)
    active = np.arange(n)
    while len(active):
        lo, hi = left[active], right[active]
        gap_lo = np.where(lo >= 0, np.abs(sums[active] - point_sums[np.maximum(lo, 0)]), -1)
        gap_hi = np.where(hi < k, np.abs(sums[active] - point_sums[np.minimum(hi, k - 1)]), -1)
        take_lo = (gap_lo >= 0) & ((gap_hi < 0) | (gap_lo <= gap_hi))
        gap = np.where(take_lo, gap_lo, gap_hi)
        # The closer side is the next candidate: once its mean rules it out, all that are left are out as well.
        going = (gap >= 0) & ((best[active] < 0) | (gap * gap <= dim * best[active]))
        active, lo, hi, take_lo, gap = active[going], lo[going], hi[going], take_lo[going], gap[going]
        if not len(active):
            break
        candidate = np.where(take_lo, lo, hi)
        left[active], right[active] = lo - take_lo, hi + ~take_lo
        apart = np.abs(deviations[active] - point_roots[candidate]) - 1
        apart = np.where(apart > 0, apart, 0)
        near = (best[active] < 0) | (gap * gap + apart * apart <= dim * best[active])
        rows, candidate = active[near], candidate[near]
        step = vectors[rows] - points[candidate]
        distance, number = (step * step).sum(axis=1), order[candidate]
        better = (best[rows] < 0) | (distance < best[rows]) | ((distance == best[rows]) & (number < chosen[rows]))
        best[rows[better]], chosen[rows[better]] = distance[better], number[better]
    return chosen, best


def digits(value: int) -> list[int]:
    """Signed digits in base ``DIGIT``, the lowest first."""
    sign, value, found = (-1 if value < 0 else 1), abs(value), []
    while value or not found:
        value, low = divmod(value, DIGIT)
        found.append(sign * low)
    return found


def kept_vectors(vectors: DataFrame, dim: int) -> DataFrame:
    """vec_id and embedding (doubles) of the rows with exactly ``dim`` components, none null, infinite or NaN."""
    embedding = F.col("embedding").cast("array<double>")
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    fits = F.coalesce((F.size(embedding) == dim) & finite, F.lit(False))
    return vectors.where(fits).select(F.col("vec_id").cast("long").alias("vec_id"), embedding.alias("embedding"))


def matrix(batch: pa.RecordBatch, dim: int, scale: int) -> np.ndarray:
    values = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
    return integers(values.reshape(-1, dim), scale)


def seeds(vectors: DataFrame, k: int, salt: int, scale: int) -> list[tuple[int, ...]]:
    """The ``k`` vectors whose salted id has the smallest SHA-256, in that order; vectors that share an id go by their components.

    Each map task keeps its own ``k`` rows, so that ``k`` rows a task meet on one node.
    """
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = vectors.orderBy(F.sha2(name, 256), "embedding").limit(k).select("embedding").collect()
    return [tuple(int(c) for c in row) for row in integers(np.array([r.embedding for r in first], dtype=float), scale)] if first else []


def moved(vectors: DataFrame, centroids: list[tuple[int, ...]], dim: int, scale: int) -> list[tuple[int, ...]]:
    """One round: each non-empty centroid becomes the floor of its vectors' mean.  Tasks send sums, never vectors."""
    k = len(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = [[0] * dim for _ in range(k)], [0] * k
        for batch in batches:
            if not batch.num_rows:
                continue
            points = matrix(batch, dim, scale)
            chosen, _ = nearest(points, centroids)
            for c in np.unique(chosen).tolist():
                mine = points[chosen == c]
                counts[c] += len(mine)
                totals[c] = [a + int(b) for a, b in zip(totals[c], mine.sum(axis=0))]
        rows = [(c, p, d, v) for c in range(k) if counts[c]
                for p, total in enumerate([*totals[c], counts[c]]) for d, v in enumerate(digits(total))]
        yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows)] if rows else
                                         [pa.array([], pa.int64())] * 4, names=["cluster", "place", "digit", "total"])

    sums = (vectors.select("embedding").mapInArrow(add, "cluster long, place long, digit long, total long")
            .groupBy("cluster", "place", "digit").agg(F.sum("total").alias("total")))
    # At most k * (dim + 1) sums of a few digits each.
    totals: dict[tuple[int, int], int] = {}
    for r in sums.collect():
        totals[r.cluster, r.place] = totals.get((r.cluster, r.place), 0) + r.total * DIGIT**r.digit
    return [tuple(totals.get((c, p), 0) // totals[c, dim] for p in range(dim)) if (c, dim) in totals else centroids[c] for c in range(k)]


def assigned(vectors: DataFrame, centroids: list[tuple[int, ...]], dim: int, scale: int) -> DataFrame:
    """vec_id, cluster and squared distance of each vector; a distance beyond a long is null."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            chosen, best = nearest(matrix(batch, dim, scale), centroids)
            distance = [d if d <= LONG else None for d in best.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(chosen, pa.int32()), pa.array(distance, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(label, "vec_id long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64,
                    salt: int = 1) -> tuple[DataFrame, list[tuple[int, ...]]]:
    """vec_id, cluster, distance of each kept vector, and the final centroids.

    ``vectors`` holds vec_id and embedding; other columns do not matter.  Rows whose embedding is null, has another length, or a
    null, infinite or NaN component are left out.  Components become floor(scale * x).  Repeated rows count each time; a null
    vec_id is hashed as an empty one.  With fewer than ``k`` vectors there are as many centroids; without any, no rows.
    Each round reads the vectors once and shuffles only sums: k * (dim + 1) a task, added before the shuffle.
    """
    kept = kept_vectors(vectors, dim)
    centroids = seeds(kept, k, salt, scale)
    if not centroids:
        return kept.selectExpr("vec_id", "0 AS cluster", "0L AS distance").limit(0), []
    for _ in range(rounds):
        centroids = moved(kept, centroids, dim, scale)
    return assigned(kept, centroids, dim, scale), centroids


def cluster_report(vectors: DataFrame, **settings: int) -> DataFrame:
    """``cluster_vectors`` with its sums: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Inertias are sums of distances over the cluster and over all vectors, null beyond a long; the digest is of the final centroid's
    components in decimal, joined by commas.  What meets the driver and is broadcast is one row a cluster, ``k`` at most.
    """
    labels, centroids = cluster_vectors(vectors, **settings)
    labels = stored(labels, "clusters")
    sums = labels.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total"),
                                         (F.count("distance") < F.count(F.lit(1))).alias("beyond")).collect()
    inertias = {r.cluster: None if r.beyond else int(r.total) for r in sums}
    inertias[None] = None if None in inertias.values() else sum(inertias.values())
    rows = [(c, *(n if n is not None and n <= LONG else None for n in (inertias[c], inertias[None])), ",".join(map(str, centroids[c])))
            for c in inertias if c is not None]
    clusters = labels.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, components string")
    digest = F.sha2("components", 256).alias("centroid_sha256")
    return (labels.join(F.broadcast(clusters), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest))
