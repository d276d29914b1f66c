"""Centroid clustering with Elkan's bounds, exact to the last integer.

Components become whole numbers, distances between them are exact, and only
the bounds that save distances are floating point: each vector keeps an upper
bound of the distance to its centroid and a lower bound for every centroid,
rounded away from the truth. A centroid is passed over when it is certain to be
farther (the upper bound is below its lower bound, or below half the distance
between the two centroids); equality is never passed over, so ties go to the
smaller number as if all distances were computed.

A round is one map over a table that holds vectors with their bounds; sums of
clusters leave a task as one row for each cluster, component and limb.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import release, table
from .text import lean

K, ROUNDS, SCALE, DIMS, SEED = 40, 5, 256, 64, 2
#: Relative error that covers a square root or sum of doubles, and the bits of a limb of a sum.
SLACK, LIMB = 2.0**-50, 30


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector has so many components, none null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dims) & ~bad, F.lit(False))


def narrow_limit(dims: int) -> int:
    """Components below this give squared distances that fit 64 bits."""
    return math.isqrt((1 << 62) // max(dims, 1)) // 2


def whole_numbers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles: 64-bit integers where squared distances fit, Python integers otherwise."""
    with np.errstate(over="ignore"):
        v = np.floor(x * scale)
    if not v.size or np.abs(v).max() < narrow_limit(x.shape[1]):
        return v.astype(np.int64)
    exact = [int(y) if math.isfinite(y) else int(z) * scale for y, z in zip(v.ravel().tolist(), x.ravel().tolist())]
    return np.array(exact, dtype=object).reshape(x.shape)


def _centroids(rows: list[list[int]]) -> list[np.ndarray]:
    """A centroid is 64-bit where it can be, on its own, so that one far outlier slows nothing else down."""
    return [np.array(r, dtype=np.int64 if max(map(abs, r), default=0) < narrow_limit(len(r)) else object) for r in rows]


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one centroid or to one each."""
    if v.dtype != c.dtype:
        v, c = v.astype(object), c.astype(object)
    return ((v - c) ** 2).sum(axis=1)


def _root(d: np.ndarray, up: bool) -> np.ndarray:
    """Square roots that are never too small (up) or never too large."""
    if d.dtype == object:
        d = np.array([_double(x) for x in d.tolist()])
    root = np.sqrt(d.astype(np.float64))
    return root * (1 + SLACK) if up else np.where(np.isfinite(root), root * (1 - SLACK), 0.0)


def _double(x: int) -> float:
    try:
        return float(x)
    except OverflowError:
        return math.inf


def _below(x: np.ndarray) -> np.ndarray:
    """Single precision that is not above x."""
    with np.errstate(over="ignore"):
        out = x.astype(np.float32)
    return np.where(out > x, np.nextafter(out, np.float32(-np.inf)), out)


def between(centroids: list[np.ndarray]) -> np.ndarray:
    """Half the distance between each two centroids, rounded down."""
    out = np.zeros((len(centroids), len(centroids)))
    for i, c in enumerate(centroids):
        for j in range(i):
            out[i, j] = out[j, i] = _root(squared(c[None, :], centroids[j]), up=False)[0] / 2
    return out


def moved(old: list[np.ndarray], new: list[np.ndarray]) -> np.ndarray:
    """How far each centroid went, rounded up."""
    return np.array([_root(squared(a[None, :], b), up=True)[0] for a, b in zip(old, new)])


def assign(v: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: list[np.ndarray], half: np.ndarray) -> int:
    """Puts every row into its nearest centroid, in place, ties into the smaller number; returns how many distances it computed."""
    exact = object if v.dtype == object or any(c.dtype == object for c in centroids) else np.int64
    maybe = ~((upper[:, None] < lower) | (upper[:, None] < half[cluster]))
    maybe[np.arange(len(v)), cluster] = False
    rows = np.flatnonzero(maybe.any(axis=1))
    best = np.zeros(len(v), dtype=exact)
    for j in np.unique(cluster[rows]):  # bounds become distances where any centroid is in question
        own = rows[cluster[rows] == j]
        best[own] = squared(v[own], centroids[j])
        upper[own], lower[own, j] = _root(best[own], up=True), _root(best[own], up=False)
    many = len(rows)
    for j, c in enumerate(centroids):
        mine = cluster[rows]
        some = rows[(mine != j) & ~(upper[rows] < lower[rows, j]) & ~(upper[rows] < half[mine, j])]
        if not len(some):
            continue
        d = squared(v[some], c)
        many += len(some)
        lower[some, j] = _root(d, up=False)
        nearer = (d < best[some]) | ((d == best[some]) & (j < cluster[some]))
        to = some[nearer.astype(bool)]
        best[to], cluster[to] = d[nearer.astype(bool)], j
        upper[to] = _root(best[to], up=True)
    return many


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dims)


def _round(state: DataFrame, centroids: list[np.ndarray], shift: np.ndarray, scale: int, last: bool) -> DataFrame:
    """State after bounds have followed the centroids' moves and vectors have gone to the nearest one."""
    k, half = len(centroids), between(centroids)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            v = whole_numbers(_matrix(batch.column(1), len(centroids[0])), scale)
            cluster, upper = batch.column(2).to_numpy().copy(), batch.column(3).to_numpy().copy()
            raw = b"".join(x.as_py() or bytes(4 * k) for x in batch.column(4))
            lower = np.frombuffer(raw, dtype=np.float32).reshape(n, k).astype(np.float64)
            upper = (upper + shift[cluster]) * (1 + SLACK)
            lower = np.maximum((lower * (1 - SLACK) - shift * (1 + SLACK)) * (1 - SLACK), 0.0)
            assign(v, cluster, upper, lower, centroids, half)
            distance: list[int | None] = [None] * n
            if last:
                for j in np.unique(cluster):
                    some = np.flatnonzero(cluster == j)
                    for i, d in zip(some.tolist(), squared(v[some], centroids[j]).tolist()):
                        distance[i] = d if d < 1 << 63 else None
            bounds = [None] * n if last else [x.tobytes() for x in _below(lower)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cluster, pa.int32()), pa.array(upper), pa.array(bounds, pa.binary()), pa.array(distance, pa.int64())],
                names=["vec_id", "x", "cluster", "upper", "lower", "distance"],
            )

    return state.mapInArrow(run, state.schema)


def _means(state: DataFrame, centroids: list[np.ndarray], scale: int) -> list[list[int]]:
    """floor(sum / count) of every cluster's vectors; an empty cluster's centroid as it was."""
    k, dims = len(centroids), len(centroids[0])

    @lean
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), dtype=object), np.zeros(k, dtype=np.int64)
        for batch in batches:
            v, cluster = whole_numbers(_matrix(batch.column(0), dims), scale), batch.column(1).to_numpy()
            for j in np.unique(cluster):
                some = cluster == j
                total[j] += v[some].sum(axis=0).astype(object)
                count[j] += int(some.sum())
        found = [(j, -1, 0, int(count[j])) for j in range(k) if count[j]]
        for j, d in np.argwhere(total != 0).tolist():
            rest, sign, limb = abs(int(total[j, d])), 1 if total[j, d] > 0 else -1, 0
            while rest:
                found.append((j, d, limb, sign * (rest & ((1 << LIMB) - 1))))
                rest, limb = rest >> LIMB, limb + 1
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], names=["cluster", "dim", "limb", "part"])

    parts = state.select("x", "cluster").mapInArrow(add, "cluster int, dim int, limb int, part bigint").groupBy("cluster", "dim", "limb").agg(F.sum("part").alias("part"))
    total, count = [[0] * dims for _ in range(k)], [0] * k
    for j, d, limb, part in parts.collect():  # a few rows for each cluster and component
        if d < 0:
            count[j] = part
        else:
            total[j][d] += part << (LIMB * limb)
    return [[s // count[j] for s in total[j]] if count[j] else [int(x) for x in centroids[j]] for j in range(k)]


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) for each usable row of vectors (vec_id, embedding).

    Usable are vectors of dims components, none null or not finite; others have no row. Components count as floor(scale * x). Centroids
    start as the k vectors with the smallest sha256 of "seed:vec_id", in that order (equal hashes by the vectors; a null vec_id comes last, as
    it has none); fewer vectors give fewer centroids, none give no rows. Each round every vector goes to the nearest centroid (squared Euclidean
    distance, ties to the smaller number) and every centroid that has any becomes floor(mean) of its own; at last vectors are assigned once more.
    Repeated rows are vectors each, rows of a null vec_id too. Other columns are not looked at. Any finite component is exact; a distance or sum
    beyond 64 bits is returned as null (inertia is then null as well), the cluster is right even so.

    What the driver holds is k times dims numbers, and so is what tasks are sent.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("x")).where(usable(F.col("x"), dims))
    kept = kept.select("vec_id", "x", F.lit(0).alias("cluster"), F.lit(float("inf")).alias("upper"), F.lit(None).cast("binary").alias("lower"), F.lit(None).cast("long").alias("distance"))
    state = table(kept, "vectors")
    first = state.select("x").orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "x").limit(k).collect()
    if not first:
        empty = state.select("vec_id", "cluster", "distance")
        nothing = F.lit(None)
        return empty.select("*", nothing.cast("long").alias("cluster_inertia"), nothing.cast("long").alias("inertia"), nothing.cast("array<string>").alias("centroid"))
    centroids = _centroids([whole_numbers(np.array([r["x"]], dtype=np.float64), scale)[0].tolist() for r in first])
    shift = np.zeros(len(centroids))
    for step in range(rounds + 1):
        after = table(_round(state, centroids, shift, scale, last=step == rounds), "vectors")
        release(state)
        state = after
        if step < rounds:
            new = _centroids(_means(state, centroids, scale))
            shift, centroids = moved(centroids, new), new
    exact = F.sum(F.col("distance").cast("decimal(19,0)")).try_cast("bigint")
    whole_sum = F.when(F.count("distance") == F.count("*"), exact)
    sums = dict(state.groupBy("cluster").agg(whole_sum.alias("s")).collect())  # a row for each cluster
    total = None if None in sums.values() else sum(sums.values())
    total = total if total is not None and total < 1 << 63 else None
    facts = [(j, sums.get(j), total, [str(x) for x in c]) for j, c in enumerate(centroids)]
    named = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<string>")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
