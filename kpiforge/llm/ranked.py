"""Ranked lexical search: a clustered index whose shards are visited by bound, with exact stopping.

Documents are put in order by recursive graph bisection: a set of documents is
halved so that each term's postings gather on one side, documents are swapped
between halves while that lowers the cost of coding the postings' gaps, and the
halves are halved in turn. The bisection is fitted on a bounded sample; every
document then goes down the tree by the same gains, to a leaf, and leaves are
cut into shards of bounded size. Where the tree sends a document decides how
early a query can stop, never its result.

A shard's bound for a query is the sum of its terms' largest parts of a score
in the shard. A query visits its shards in order of falling bounds, some at a
time, and is through when the next bound is below its k-th best score; at an
equal bound it goes on, as ties are decided by doc_id.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import release, table
from .text import CHUNK_BYTES, lean, slices

K = 10
#: Documents in the sample that the bisection is fitted on and bytes of the longest of them; terms that lead down the tree; depth of the tree and rounds of swaps.
SAMPLE, SAMPLE_BYTES, LEADING, DEPTH, SWAPS = 2048, 1 << 14, 8192, 6, 8
#: Documents in a shard, about; terms of the queries that are asked at once, repeats included.
SHARD, TERMS = 2048, 1 << 19
#: Shards that a query visits first, and how many times as many it has visited after each round.
FIRST, GROWTH = 2, 8
#: Query terms are broadcast up to so many rows; beyond, the same join shuffles.
BROADCAST_ROWS = 1_000_000

_TERM = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(raw: bytes) -> Counter[bytes]:
    """Terms of a text, with only A-Z lower-cased, and how often each occurs; the text is read in chunks."""
    out: Counter[bytes] = Counter()
    pos = 0
    while pos < len(raw):
        end = min(len(raw), pos + CHUNK_BYTES)
        while end < len(raw) and _TERM[raw[end]] != 32:  # not within a term
            end += 1
        out.update(raw[pos:end].translate(_TERM).split())
        pos = end
    return out


def term_weight(n: int, df: int) -> int:
    """floor(1000 * ln((2N + 2) / (2df + 1)))."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def parts(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A posting's part of a score."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def length_norms(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """25 + (75 * n * N) div L of documents with n terms, in whole numbers of any size."""
    return np.array([25 + 75 * x * documents // max(length, 1) for x in n.tolist()], dtype=np.int64)


def _cost(left: np.ndarray, right: np.ndarray, n_left: int, n_right: int) -> np.ndarray:
    """Bits that a term's postings need on both sides, by the logarithm of their average gap."""
    return left * np.log2(n_left / (left + 1.0)) + right * np.log2(n_right / (right + 1.0))


def bisect(docs: list[np.ndarray], terms: int, depth: int) -> np.ndarray:
    """Weights (node, term) of a tree of that depth: a document goes left where its terms' weights sum above zero."""
    weights = np.zeros(((1 << depth) - 1, terms), dtype=np.float32)
    sets = [np.arange(len(docs))]
    for level in range(depth):
        halves = []
        for k, held in enumerate(sets):
            half = len(held) // 2
            if not half:
                halves += [held, held[:0]]
                continue
            size = np.array([len(docs[d]) for d in held])
            term, of = np.concatenate([docs[d] for d in held]), np.repeat(np.arange(len(held)), size)
            on_left = np.arange(len(held)) < half
            for _ in range(SWAPS):
                mine = on_left[of]
                left, right = np.bincount(term[mine], minlength=terms), np.bincount(term[~mine], minlength=terms)
                n_left, n_right = int(on_left.sum()), int((~on_left).sum())
                now = _cost(left, right, n_left, n_right)
                gain = np.where(mine, (now - _cost(np.maximum(left - 1, 0), right + 1, n_left, n_right))[term], (now - _cost(left + 1, np.maximum(right - 1, 0), n_left, n_right))[term])
                gain = np.bincount(of, weights=gain, minlength=len(held))
                there, back = np.flatnonzero(on_left), np.flatnonzero(~on_left)
                there, back = there[np.argsort(-gain[there], kind="stable")], back[np.argsort(-gain[back], kind="stable")]
                pairs = min(len(there), len(back))
                swap = int((gain[there[:pairs]] + gain[back[:pairs]] > 0).sum())
                if not swap:
                    break
                on_left[there[:swap]], on_left[back[:swap]] = False, True
            mine = on_left[of]
            left, right = np.bincount(term[mine], minlength=terms), np.bincount(term[~mine], minlength=terms)
            n_left, n_right = int(on_left.sum()) + 1, int((~on_left).sum()) + 1
            weights[(1 << level) - 1 + k] = _cost(left, right + 1, n_left, n_right) - _cost(left + 1, right, n_left, n_right)
            halves += [held[on_left], held[~on_left]]
        sets = halves
    return weights


def leaves(weights: np.ndarray, term: np.ndarray, of: np.ndarray, n: int, depth: int) -> np.ndarray:
    """The leaf of each of n documents, whose leading terms are term[of == document]."""
    node = np.zeros(n, dtype=np.int64)
    for _ in range(depth):
        left = np.bincount(of, weights=weights[node[of], term], minlength=n) > 0
        node = 2 * node + np.where(left, 1, 2)
    return node - ((1 << depth) - 1)


class _Tree:
    """A fitted bisection: leading terms and their weights."""

    def __init__(self, texts: list[bytes], depth: int) -> None:
        seen = [list(term_counts(t)) for t in texts]
        often = Counter(t for s in seen for t in s)
        some = sorted((t for t, c in often.items() if 4 <= c <= len(texts) // 2), key=lambda t: (-often[t], t))[:LEADING]
        self.depth = depth if some else 0
        self.terms = {t: k for k, t in enumerate(some)}
        self.weights = bisect([np.array([self.terms[t] for t in s if t in self.terms], dtype=np.int64) for s in seen], len(some), self.depth)


def _fit(docs: DataFrame, rows: int) -> _Tree:
    """The bisection of a sample of SAMPLE documents, about, chosen by hash among those that aren't very long."""
    depth = min(max(math.ceil(math.log2(max(rows, 1) / SHARD)), 0), DEPTH)
    if not depth:
        return _Tree([], 0)
    share = max(rows // SAMPLE, 1)
    some = docs.where((F.octet_length("text") <= SAMPLE_BYTES) & (F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == 0))
    return _Tree([r["text"].encode() for r in some.select("text").limit(2 * SAMPLE).collect()], depth)


def _index(docs: DataFrame, tree: _Tree, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, leaf, salt, terms, tfs): every document's number of terms, its leaf, and its postings of the vocabulary."""
    both = vocabulary | {t: len(vocabulary) + k for k, t in enumerate(t for t in tree.terms if t not in vocabulary)}
    leading = np.full(len(both) + 1, -1, dtype=np.int64)
    for t, k in tree.terms.items():
        leading[both[t]] = k
    asked = len(vocabulary)

    @lean
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = 0
        get = both.get
        for batch in batches:
            for part in slices(batch, 1, rows=512):
                n, found, many, size = [], [], [], []
                for raw in part.column(1).cast(pa.binary()):
                    counts = term_counts(raw.as_py() or b"")
                    n.append(counts.total())
                    some = [(i, c) for t, c in counts.items() if (i := get(t)) is not None]
                    found += [i for i, _ in some]
                    many += [c for _, c in some]
                    size.append(len(some))
                term, tf, of = np.array(found, dtype=np.int64), np.array(many, dtype=np.int64), np.repeat(np.arange(len(n)), size)
                lead = leading[term] >= 0
                leaf = leaves(tree.weights, leading[term[lead]], of[lead], len(n), tree.depth)
                mine = term < asked
                at = pa.array(np.r_[0, np.cumsum(np.bincount(of[mine], minlength=len(n)))].astype(np.int32))
                lists = [pa.ListArray.from_arrays(at, pa.array(x[mine].astype(np.int32))) for x in (term, tf)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(leaf.astype(np.int32)), pa.array(np.arange(salt, salt + len(n))), *lists], names=["doc_id", "n", "leaf", "salt", "terms", "tfs"]
                )
                salt += len(n)

    return docs.mapInArrow(make, "doc_id bigint, n bigint, leaf int, salt bigint, terms array<int>, tfs array<int>")


class _Asked:
    """Queries by place: the places of their terms and how often each occurs; the terms' weights; what norms need."""

    def __init__(self, queries: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray, documents: int, length: int) -> None:
        self.queries, self.weight, self.documents, self.length = queries, weight, documents, length

    def postings(self, columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term, row, part of a score) of index columns n, terms, tfs."""
        n, terms, tfs = columns
        term, tf = (x.flatten().to_numpy().astype(np.int64) for x in (terms, tfs))
        row = np.repeat(np.arange(len(n)), terms.value_lengths().to_numpy())
        return term, row, parts(self.weight[term], tf, length_norms(n.to_numpy(), self.documents, self.length)[row])


def score_shard(asked: _Asked, places: list[int], floors: list[int], doc_ids: np.ndarray, term: np.ndarray, row: np.ndarray, part: np.ndarray, k: int) -> tuple[list[int], list[int], list[int]]:
    """(query, doc_id, score) of the k best documents of a shard for each of some queries; what lies below a query's floor is left out."""
    order = np.argsort(term, kind="stable")
    term, row, part = term[order], row[order], part[order]
    out: tuple[list[int], list[int], list[int]] = ([], [], [])
    for place, floor in zip(places, floors):
        terms, many = asked.queries[place]
        score = np.zeros(len(doc_ids), dtype=np.int64)
        for a, b, c in zip(np.searchsorted(term, terms).tolist(), np.searchsorted(term, terms, side="right").tolist(), many.tolist()):
            score[row[a:b]] += c * part[a:b]  # a document has one posting of a term
        some = np.flatnonzero(score >= max(floor, 1))
        if len(some) > k:
            some = some[score[some] >= np.partition(score[some], len(some) - k)[len(some) - k]]
        some = some[np.lexsort((doc_ids[some], -score[some]))][:k]
        out[0].extend([place] * len(some))
        out[1].extend(doc_ids[some].tolist())
        out[2].extend(score[some].tolist())
    return out


def _visits(index: DataFrame, asked: _Asked) -> DataFrame:
    """(query, shard, bound, nth): each query's shards in order of falling bounds."""
    spark = index.sparkSession

    @lean
    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, row, part = asked.postings(batch.columns[1:])
            shard = batch.column(0).to_numpy()[row]
            order = np.lexsort((-part, term, shard))
            term, shard, part = term[order], shard[order], part[order]
            first = np.ones(len(term), dtype=bool)
            first[1:] = (term[1:] != term[:-1]) | (shard[1:] != shard[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(shard[first]), pa.array(term[first].astype(np.int32)), pa.array(part[first])], names=["shard", "term", "part"])

    most = index.select("shard", "n", "terms", "tfs").mapInArrow(largest, "shard bigint, term int, part bigint").groupBy("shard", "term").agg(F.max("part").alias("part"))
    rows = pa.table({
        "query": pa.array(np.repeat(np.arange(len(asked.queries)), [len(t) for t, _ in asked.queries]), pa.int64()),
        "term": pa.array(np.concatenate([t for t, _ in asked.queries]).astype(np.int32)), "many": pa.array(np.concatenate([c for _, c in asked.queries])),
    })
    of_queries = spark.createDataFrame(rows)
    met = most.join(F.broadcast(of_queries) if rows.num_rows <= BROADCAST_ROWS else of_queries, "term")
    bounds = met.groupBy("query", "shard").agg(F.sum(F.col("part") * F.col("many")).alias("bound")).where("bound > 0")
    return bounds.withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("bound"), "shard")))


def _search(docs: DataFrame, tree: _Tree, items: list[tuple[int | None, Counter[bytes]]], k: int) -> DataFrame:
    """search() for some queries, all of whose terms tasks can hold."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in items for t in c}))}
    raw = table(_index(docs, tree, vocabulary), "postings")
    documents, length = raw.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = np.full(len(vocabulary), term_weight(documents, 0), dtype=np.int64)
    for t, df in raw.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row for each term asked for
        weight[t] = term_weight(documents, df)
    asked = _Asked([(np.array(sorted(vocabulary[t] for t in c), dtype=np.int64), np.array([n for _, n in sorted((vocabulary[t], n) for t, n in c.items())], dtype=np.int64)) for _, c in items], weight, documents, length)
    # leaves are cut into shards
    first, cuts = 0, []
    for leaf, count in sorted(raw.groupBy("leaf").count().collect()):  # a row for each leaf of the tree
        many = -(-count // SHARD)
        cuts.append((leaf, first, many))
        first += many
    where = spark.createDataFrame(cuts, "leaf int, first bigint, many bigint")
    shard = (F.col("first") + F.pmod(F.xxhash64("doc_id", "salt"), F.col("many"))).alias("shard")
    index = table(raw.where("doc_id is not null and size(terms) > 0").join(F.broadcast(where), "leaf").select(shard, "doc_id", "n", "terms", "tfs"), "index")
    release(raw)
    visits = table(_visits(index, asked), "visits")
    last = visits.agg(F.max("nth")).first()[0] or 0

    def visit(them: pa.Table, held: pa.Table) -> pa.Table:
        found: tuple = ([], [], [])
        if them.num_rows and held.num_rows:
            held = held.combine_chunks()
            term, row, part = asked.postings([held.column(c).chunk(0) for c in ("n", "terms", "tfs")])
            found = score_shard(asked, them.column("query").to_pylist(), them.column("floor").to_pylist(), held.column("doc_id").to_numpy(), term, row, part, k)
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("query", "doc_id", "score"), found)})

    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    best = spark.createDataFrame([], "query bigint, doc_id bigint, score bigint, rank int")
    seen, upto, spent = 0, FIRST, [index, visits]
    while seen < last:
        floors = best.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("reached")).where(F.col("n") >= k).select("query", "reached")
        now = visits.where((F.col("nth") > seen) & (F.col("nth") <= upto)).join(floors, "query", "left").withColumn("floor", F.coalesce("reached", F.lit(0).cast("long"))).where("bound >= floor")
        now = table(now.select("query", "shard", "floor"), "now")
        if now.isEmpty():  # bounds fall, so no later shard is worth a visit either
            release(now)
            break
        spent.append(now)
        found = now.groupBy("shard").cogroup(index.join(now.select("shard").distinct(), "shard", "left_semi").groupBy("shard")).applyInArrow(visit, "query bigint, doc_id bigint, score bigint")
        best = table(found.unionByName(best.select("query", "doc_id", "score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
        seen, upto = upto, upto * GROWTH
    for old in spent:
        release(old)
    names = spark.createDataFrame([(p, i) for p, (i, _) in enumerate(items)], "query bigint, item_id bigint")
    return best.join(F.broadcast(names) if len(items) <= BROADCAST_ROWS else names, "query").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents (doc_id, text) of the highest score above 0 for each query (item_id, text).

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased. Equal scores are
    ranked by ascending doc_id. Null, empty and termless texts count nowhere, and such a query has no rows. Rows of a null
    doc_id count in the statistics but are not found; repeated rows are documents each. A null item_id asks as any other;
    repeated rows of queries each have k rows. Other columns are not looked at; empty tables give no rows.

    Queries are asked in blocks of TERMS terms, about, each with one pass over the documents.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    queries = queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    rows = docs.count()
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (8 * TERMS)))
    tree = _fit(docs, rows)
    out = None
    for b in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        items = [(r["item_id"], c) for r in mine if (c := term_counts(r["text"].encode()))]
        if items and rows:
            found = _search(docs, tree, items, k)
            out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
