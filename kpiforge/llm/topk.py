"""Exact top-k inner-product search by MaxScore.

Each dimension is a query term; its postings in a shard are the shard's
values. In a shard every term of a query has a score bound. Terms are split by
these bounds: the essential ones, without which no vector can reach the
query's threshold, are traversed for all vectors of the shard; the others are
probed only for vectors that stay competitive, in order of falling bounds. The
threshold is the k-th best score that the query has found so far: it rises
from block to block of a shard, and a first shard's result is where the others
begin. Shards are merged by the best k of each query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import table

K = 10
#: Vectors in a shard and queries in a block, about; a task holds one of each.
SHARD, QUERIES = 2048, 4096
#: Terms probed at a time; vectors of a shard between two looks at the threshold.
STEP, BLOCK = 16, 512


#: Whole numbers up to here are exact as doubles; scores beyond 64 bits are returned as the nearest number of 64 bits.
EXACT, LOW, HIGH = 2.0**53, -(1 << 63), (1 << 63) - 1


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 0), dtype=np.int64)


def _most(values: np.ndarray) -> float:
    return float(np.abs(values.astype(np.float64)).max(initial=0.0))


def search_wide(
    queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, vectors: np.ndarray, ids: np.ndarray, copies: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What search_shard() returns, for whole numbers of any 64 bits: doubles with a bound of their error tell which candidates may be
    among the k best, and these are scored in whole numbers of any size."""
    out = []
    near = vectors.astype(np.float64)
    slack = (vectors.shape[1] + 8) * 2.0**-51
    for place, (query, query_id, floor) in enumerate(zip(queries, query_ids.tolist(), floors.tolist())):
        many = copies - ((ids == query_id) & (vectors == query).all(axis=1))
        with np.errstate(over="ignore"):
            score, error = near @ query.astype(np.float64), slack * (np.abs(near) @ np.abs(query.astype(np.float64))) + 1
        live = np.flatnonzero(many > 0)
        if len(live) > k:
            least = np.partition(score[live] - error[live], len(live) - k)[len(live) - k]
            live = live[score[live] + error[live] >= min(least, float(HIGH))]
        live = live[score[live] + error[live] >= np.nextafter(floor, -np.inf)]
        exact = [max(LOW, min(HIGH, sum(a * b for a, b in zip(query.tolist(), vectors[i].tolist())))) for i in live.tolist()]
        best = sorted(range(len(live)), key=lambda r: (-exact[r], ids[live[r]]))[:k]
        times = np.minimum(many[live[best]], k).astype(np.int64)
        out.append((np.full(times.sum(), place), np.repeat(ids[live[best]], times), np.repeat(np.array([exact[r] for r in best], dtype=np.int64), times)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, dtype=np.int64),) * 3


def search_shard(
    queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, vectors: np.ndarray, ids: np.ndarray, copies: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's place, vector's id, score) of the k best of a shard for each query, whole numbers throughout.

    copies: how many rows a vector stands for; a query's own row is not among its candidates. floors: scores that k
    candidates of the query are known to reach, -inf if none are. The shard is gone through block by block, and the
    k-th best score so far is the threshold of the next. Sums that doubles can't hold exactly go another way.
    """
    if _most(queries) * _most(vectors) * max(vectors.shape[1], 1) >= EXACT:
        return search_wide(queries, query_ids, floors, vectors, ids, copies, k)
    queries, vectors = queries.astype(np.float64), vectors.astype(np.float64)
    out = []
    n = len(vectors)
    high, low = vectors.max(0), vectors.min(0)
    columns = np.ascontiguousarray(vectors.T)
    for place, (query, query_id, floor) in enumerate(zip(queries, query_ids.tolist(), floors.tolist())):
        top, bottom = np.maximum(query * high, query * low), np.minimum(query * high, query * low)
        bound = top - bottom  # of a term's part above its least
        order = np.argsort(-bound, kind="stable")
        rest = np.r_[np.cumsum(bound[order][::-1])[::-1], 0.0]  # what terms from here on can add at most
        base = bottom.sum()
        many = copies
        own = np.flatnonzero(ids == query_id)
        if len(own):
            own = own[(vectors[own] == query).all(1)]
            many = copies.copy()
            many[own] -= 1
        held, held_ids, held_many = np.empty(0), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for begin in range(0, n, BLOCK):
            live = begin + np.flatnonzero(many[begin : begin + BLOCK] > 0)
            if begin == 0 and not np.isfinite(floor):  # a first threshold from some vectors' exact scores
                exact = vectors[live[:: max(1, len(live) // (4 * k))]] @ query
                floor = np.partition(exact, len(exact) - k)[len(exact) - k] if len(exact) >= k else -np.inf
            # the non-essential terms are the longest tail whose bounds stay below the threshold
            essential = int(np.searchsorted(-(rest + base), -floor, side="right")) if np.isfinite(floor) else len(order)
            essential = min(max(essential, 1), len(order))
            terms = order[:essential]
            part = base + (query[terms] @ columns[terms, begin : begin + BLOCK] - bottom[terms].sum())[live - begin]
            for lo in range(essential, len(order) + STEP, STEP):
                keep = part + rest[min(lo, len(order))] >= floor
                live, part = live[keep], part[keep]
                terms = order[lo : lo + STEP]
                if not len(terms) or not len(live):
                    break
                part = part + (query[terms] @ columns[np.ix_(terms, live)] - bottom[terms].sum())
            if len(live):
                score, found, number = np.r_[held, part], np.r_[held_ids, ids[live]], np.r_[held_many, many[live]]
                best = np.lexsort((found, -score))[:k]
                held, held_ids, held_many = score[best], found[best], number[best]
                reached = np.searchsorted(np.cumsum(held_many), k)
                if reached < len(held):
                    floor = max(floor, held[reached])
        times = np.minimum(held_many, k)
        out.append((np.full(times.sum(), place), np.repeat(held_ids, times), np.repeat(held, times).astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, dtype=np.int64),) * 3


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x as a double; null if the vector or a component is null or not finite. What is beyond 64 bits
    becomes the nearest number of 64 bits."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query with the vectors, its own row aside.

    vectors and queries: (vec_id, terms array<bigint>) of whole numbers, as whole() makes them; scores are exact whatever
    the terms, and one beyond 64 bits counts as the nearest number of 64 bits. Rows
    with null terms or a null id take no part, nor do vectors of another length than the query's. Ties go to the
    smaller vec_id. Every row is a candidate, so a repeated one is found as often as it occurs; a query's own is one
    row of its id and terms. Repeated rows of queries ask once, different terms under one id each for themselves.

    Queries are dealt into blocks and vectors into shards, and each pair of them is one task's work, so memory grows
    with neither; their number grows with the product, which an exact search of all against all needs. One shard is
    searched before the others, which get its k-th best score of each query as their threshold.
    """
    usable = lambda df: df.select("vec_id", "terms").where("vec_id is not null and terms is not null").groupBy("vec_id", "terms").agg(F.count("*").alias("copies")).withColumn("dims", F.size("terms"))
    mine = table(usable(vectors), "vectors")
    asked = table(usable(queries).withColumn("floor", F.lit(None).cast("double")).withColumn("query", F.xxhash64("vec_id", "terms")), "queries")
    shards, blocks = (max(-(-df.count() // size), 1) for df, size in ((mine, SHARD), (asked, QUERIES)))
    place = lambda n, *by: F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")
    left_columns = ["dims", "vec_id", "terms", "query", "floor"]

    def pair(q: pa.Table, v: pa.Table) -> pa.Table:
        empty = np.empty(0, dtype=np.int64)
        at, vec_id, score = empty, empty, empty
        if q.num_rows and v.num_rows:
            floors = q.column("floor").to_numpy(zero_copy_only=False)
            at, vec_id, score = search_shard(
                _matrix(q.column("terms"), q.num_rows), q.column("vec_id").to_numpy(), np.where(np.isnan(floors), -np.inf, floors),
                _matrix(v.column("terms"), v.num_rows), v.column("vec_id").to_numpy(), v.column("copies").to_numpy(), k,
            )
        return pa.table({"query_id": pa.array(q.column("vec_id").to_numpy()[at], pa.int64()), "query": pa.array(q.column("query").to_numpy()[at], pa.int64()), "vec_id": pa.array(vec_id, pa.int64()), "score": pa.array(score, pa.int64())})

    def found(asked: DataFrame, shard: Column) -> DataFrame:
        left = asked.select(place(blocks, "vec_id").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), *left_columns).where(shard)
        right = mine.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), place(shards, "vec_id", "terms").alias("shard"), "dims", "vec_id", "terms", "copies").where(shard)
        keys = ["block", "shard", "dims"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(pair, "query_id bigint, query bigint, vec_id bigint, score bigint")

    first = table(found(asked, F.col("shard") == 0), "first")
    out = first
    if shards > 1:
        floors = first.groupBy("query").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("reached")).where(F.col("n") >= k).select("query", "reached")
        learnt = asked.join(floors, "query", "left").withColumn("floor", F.col("reached"))
        out = first.unionByName(found(learnt, F.col("shard") > 0))
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
