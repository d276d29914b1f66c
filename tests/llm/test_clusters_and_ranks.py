"""Clustering, SimHash near-duplicates and ranked search against brute force, and their defined results on odd input."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from kpiforge.llm import clustering, queries, ranked, simhash

SPACE = re.compile("[\x20\x09-\x0d]+")


def _lower(t: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# ---- 11 clustering --------------------------------------------------------------------------------------------------


def _plain_clusters(vectors, k, rounds, scale, seed):
    """(vec_id, cluster, distance) by the definition, in Python's own integers."""
    whole = [(i, [int(math.floor(scale * x)) if math.isfinite(scale * x) else int(x) * scale for x in v]) for i, v in vectors]
    mark = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "")
    centroids = [w for _, (_, w) in sorted(zip(vectors, whole), key=lambda r: (mark(r[0][0]), r[0][1]))[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for _ in range(rounds + 1):
        where = [min((apart(v, c), j) for j, c in enumerate(centroids)) for _, v in whole]
        last = centroids
        centroids = [[sum(x) // len(x) for x in zip(*of)] if (of := [v for (_, v), (_, j) in zip(whole, where) if j == n]) else c for n, c in enumerate(centroids)]
    return [(i, j, d) for (i, _), (d, j) in zip(whole, where)], last


def _vectors(n, dims, seed):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    grid = lambda x: round(8 * x) / 8  # noqa: E731  many ties
    return [(i, [grid(x + rng.gauss(0, 0.3)) for x in rng.choice(middles)]) for i in range(n)]


@pytest.mark.parametrize("scale,k", [(256, 12), (1, 7), (3, 400)])
def test_clusters_match_brute_force(spark, scale, k):
    vectors = _vectors(300, 6, k) + [(9, [0.0] * 6), (9, [0.0] * 6), (None, [1.0] * 6)]
    odd = [(500, None), (501, [1.0] * 5), (502, [1.0] * 5 + [None]), (503, [math.nan] + [0.0] * 5), (504, [math.inf] + [0.0] * 5), (505, [])]
    df = spark.createDataFrame([(i, v, "extra", 1) for i, v in vectors + odd], "vec_id long, embedding array<double>, cluster string, distance int")
    want, centroids = _plain_clusters(vectors, k, 4, scale, 2)
    rows = clustering.cluster(df, k, 4, scale, 6).collect()
    assert Counter((r["vec_id"], r["cluster"], r["distance"]) for r in rows) == Counter(want)
    sums = Counter()
    for _, j, d in want:
        sums[j] += d
    for r in rows:
        assert r["cluster_inertia"] == sums[r["cluster"]] and r["inertia"] == sum(sums.values()) and [int(x) for x in r["centroid"]] == centroids[r["cluster"]]


def test_clusters_of_huge_components(spark):
    """Far outliers, up to the largest double, leave every cluster right; what 64 bits can't hold is null."""
    vectors = _vectors(60, 4, 3) + [(100, [1e9, -1e9, 0.5, 0.0]), (101, [1e300, 0.0, -1.0, 2.0]), (102, [1.7e308, -1.7e308, 0.0, 0.0]), (103, [3e7, 3e7, 3e7, 3e7])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    want, _ = _plain_clusters(vectors, 20, 3, 256, 2)
    got = {r["vec_id"]: (r["cluster"], r["distance"]) for r in clustering.cluster(df, 20, 3, 256, 4).collect()}
    assert got == {i: (j, d if d < 1 << 63 else None) for i, j, d in want}


def test_no_vectors_and_one(spark):
    df = spark.createDataFrame([(1, [0.5] * 3)], "vec_id long, embedding array<float>")
    assert clustering.cluster(df, 5, 2, 256, 4).collect() == [] and clustering.cluster(df.limit(0), 5, 2, 256, 3).collect() == []
    assert [tuple(r)[:5] for r in clustering.cluster(df, 5, 2, 256, 3).collect()] == [(1, 0, 0, 0, 0)]


def test_bounds_skip_distances_and_keep_ties():
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(loc=1000 * c, scale=30, size=(400, 8)) for c in range(10)]).astype(np.int64)
    centroids = clustering._centroids([v[400 * c].tolist() for c in range(10)])
    half = clustering.between(centroids)
    cluster, upper, lower = np.zeros(len(v), dtype=np.int64), np.full(len(v), np.inf), np.zeros((len(v), 10))
    first = clustering.assign(v, cluster, upper, lower, centroids, half)
    again = clustering.assign(v, cluster, upper, lower, centroids, half)
    assert (cluster == np.repeat(np.arange(10), 400)).all() and first <= 40_000 and again == 0
    exact = np.stack([clustering.squared(v, c) for c in centroids], 1)
    assert (lower**2 <= exact * (1 + 1e-12)).all() and (upper**2 >= exact[np.arange(len(v)), cluster] * (1 - 1e-12)).all()


# ---- 12 simhash -----------------------------------------------------------------------------------------------------


def _plain_fingerprint(t):
    w = [x for x in SPACE.split(_lower(t)) if x]
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode("utf-8"), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(ids, fps, radius=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least: dict = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [least.get(find(k)) for k in range(len(fps))]


def test_simhash_of_texts(spark):
    rng = random.Random(4)
    words = ["alpha", "Beta", "ÄÖ", "gamma,", "δ", "one", "two", "three"]
    texts = [None, "", " \n ", "one", "one two three", "ONE two\tthree", "x" * 70_000] + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(None, "one", "z"), (None, "nothing else is like this text", "z"), (3, "one", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = Counter((r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(df).collect())
    fps = [_plain_fingerprint(t) for _, t, _ in rows]
    assert got == Counter(zip([i for i, _, _ in rows], fps, _components([i for i, _, _ in rows], fps)))
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def test_long_texts_are_read_in_chunks(monkeypatch):
    text = " ".join(random.Random(1).choice(["ab", "cde", "f", "g" * 50, "ö"]) for _ in range(3000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "CHUNK_BYTES", 37)
    monkeypatch.setattr(simhash, "SHINGLES", 100)
    assert simhash.fingerprint(text.encode()) == whole == _plain_fingerprint(text)


@pytest.mark.parametrize("block,cell", [(1024, 16), (6, 16), (40, 1)])
def test_links_match_brute_force(spark, monkeypatch, block, cell):
    """Chains of fingerprints a few bits apart, in cells that one task compares and in blocks of hot ones, with few grids and many."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = random.Random(block)
    fps = {0, (1 << 64) - 1} | {rng.getrandbits(64) for _ in range(60)}
    for _ in range(500):
        x = rng.choice(sorted(fps))
        for b in rng.sample(range(64), rng.randint(1, 6)):
            x ^= 1 << b
        fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fingerprint long")
    links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(df).collect()]
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    want = _components(fps, fps)
    groups: dict = {}
    for f, w in zip(fps, want):
        groups.setdefault(w, set()).add(find(f))
    assert all(len(g) == 1 for g in groups.values()) and len({find(f) for f in fps}) == len(groups)


def test_the_embedding_bounds_the_distance():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(0, 1 << 64, 4000, dtype=np.uint64) for _ in range(2))
    counts = lambda x: np.stack([np.bitwise_count((x >> np.uint64(2 * s)) & np.uint64(3)).astype(int) for s in range(32)], 1)
    manhattan = np.abs(counts(a) - counts(b)).sum(1)
    assert (np.bitwise_count(simhash.unary(a) ^ simhash.unary(b)) == manhattan).all() and (manhattan <= np.bitwise_count(a ^ b)).all()


# ---- 13 ranked search -----------------------------------------------------------------------------------------------


def _terms(t):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", _lower(t))


def _plain_ranks(docs, items, k):
    """A list of (item_id, rank, doc_id, score) by the definition."""
    counts = [(i, Counter(_terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 100 - 75 + 75 * c.total() * n_docs // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in _terms(text) if c[t])
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return out


@pytest.mark.parametrize("shard,terms", [(2048, 1 << 19), (16, 1 << 19), (16, 20)])
def test_ranks_match_brute_force(spark, monkeypatch, shard, terms):
    """In one shard and in many that a bisection makes, asked at once and in blocks."""
    monkeypatch.setattr(ranked, "SHARD", shard)
    monkeypatch.setattr(ranked, "TERMS", terms)
    rng = random.Random(5)
    topics = [["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4))) for _ in range(25)] for _ in range(6)]
    text = lambda: " ".join(rng.choice(topics[0] if rng.random() < 0.3 else rng.choice(topics)) + rng.choice(["", ".", "-X1"]) for _ in range(rng.randint(0, 50)))
    docs = [(i, text()) for i in range(260)]
    docs += [(300 + i, docs[i % 7][1]) for i in range(40)] + [(400, None), (401, ""), (402, " ... "), (403, "a" * 50_000), (5, docs[5][1]), (5, docs[5][1]), (None, docs[5][1])]
    items = [(i, text() or "ab") for i in range(12)] + [(3, "ab ab ab"), (None, docs[9][1]), (50, None), (51, ""), (52, "!"), (53, "zzzunseen")]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, n int, score string")
    q = spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, rank string")
    got = Counter(tuple(r) for r in ranked.search(d, q).collect())
    assert got == Counter(_plain_ranks(docs, items, 10))
    assert ranked.search(d, q.limit(0)).collect() == [] and ranked.search(d.limit(0), q).collect() == []


def test_bisection_brings_like_documents_together():
    rng = np.random.default_rng(6)
    topic = rng.permutation(np.repeat(np.arange(4), 60))
    docs = [np.unique(np.r_[rng.integers(0, 30, 4), 30 + 40 * t + rng.integers(0, 40, 25)]) for t in topic]
    weights = ranked.bisect(docs, 190, 2)
    of, term = np.repeat(np.arange(len(docs)), [len(d) for d in docs]), np.concatenate(docs)
    leaf = ranked.leaves(weights, term, of, len(docs), 2)
    assert all(np.bincount(leaf[topic == t], minlength=4).max() > 0.9 * 60 for t in range(4)) and len(set(leaf)) == 4


def test_terms_of_long_texts_are_whole(monkeypatch):
    text = "One two-three ÄÖ ä1 " * 500 + "x" * 100
    whole = ranked.term_counts(text.encode())
    monkeypatch.setattr(ranked, "CHUNK_BYTES", 11)
    assert ranked.term_counts(text.encode()) == whole == Counter(t.encode() for t in _terms(text))


# ---- the queries ----------------------------------------------------------------------------------------------------


def test_queries_of_small_tables(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice(["red", "Green", "blue", "é1"]) for _ in range(rng.randint(0, 12)))) for i in range(50)]
    items = [(7, "red green"), (8, "BLUE é1 blue")]
    vectors = _vectors(90, 64, 2)
    put = lambda name, key, rows, column, kind: pq.write_table(pa.table({key: pa.array([r[0] for r in rows], pa.int64()), column: pa.array([r[1] for r in rows], kind)}), tmp_path / f"{name}.parquet")
    put("documents", "doc_id", docs, "text", pa.string())
    put("benchmark", "item_id", items, "text", pa.string())
    put("embeddings", "vec_id", vectors, "embedding", pa.list_(pa.float32()))
    fps = [_plain_fingerprint(t) for _, t in docs]
    got = sorted(tuple(r) for r in queries.op12_simhash_dedup(spark, str(tmp_path)).collect())
    assert got == sorted((i, f"{f:016x}", c) for (i, _), f, c in zip(docs, fps, _components([i for i, _ in docs], fps)))
    assert sorted(tuple(r) for r in queries.op13_ranked_search(spark, str(tmp_path)).collect()) == sorted(_plain_ranks(docs, items, 10))
    want, centroids = _plain_clusters(vectors, 40, 5, 256, 2)
    for r in queries.op11_centroid_clustering(spark, str(tmp_path)).collect():
        i, j, d = want[r["vec_id"]]
        assert (r["cluster"], r["distance"]) == (j, d) and r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()
        assert r["cluster_inertia"] == sum(x for _, c, x in want if c == j) and r["inertia"] == sum(x for _, _, x in want)
