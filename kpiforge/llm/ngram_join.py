"""Exact n-gram Jaccard join of whole texts, and the components of its links.

A document's set of word shingles is a sorted array of 64-bit fingerprints.
Documents with equal sets are one class from the start. Classes meet in tiles:
sets that are similar enough share one of their first shingles in any common
order (prefix filter), so each such shingle is a tile, and its members are
compared within a band of sizes only. The order puts frequent shingles last,
which keeps tiles small; classes that consist of frequent shingles so far that
even their prefix has some (large groups of near copies) are dealt into tiles
of blocks in order of size. In either kind of tile the bit counts of two
hashed bitmaps bound the overlap from above, and the exact intersection of the
sorted arrays decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import release, table
from .text import U64, lean, shingle_hashes, slices, word_hashes

WIDTH, PERCENT = 5, 80
#: Shingles in so many sets are frequent; at most FREQUENT_LIMIT of them (the most frequent) are told apart.
FREQUENT_AT, FREQUENT_LIMIT = 32, 1 << 20
BLOCK = 512
#: Ids are broadcast up to so many; beyond, the same join shuffles.
BROADCAST_IDS = 2_000_000
TEXTS = 256
#: Proposed pairs that a task holds before it hands them on; shingles that a task counts at once, about.
PAIRS, COUNTED = 1 << 20, 1 << 23


def bitmap_bits(n: int) -> int:
    """Bits of the bitmap of a set of n: a power of two, four a member or more."""
    return max(64, 1 << (4 * n - 1).bit_length()) if n else 64


def bitmap(values: np.ndarray) -> np.ndarray:
    """The hashed bitmap of a set, as bytes; folding its halves gives that of half the width."""
    bits = np.zeros(bitmap_bits(len(values)), dtype=np.uint8)
    bits[(values & U64(len(bits) - 1)).astype(np.int64)] = 1
    return np.packbits(bits)


def overlap_bound(a: np.ndarray, na: int, b: np.ndarray, nb: int) -> int:
    """No less than the intersection: every bit that only one side has is a member the other lacks."""
    while len(a) > len(b):
        a = a[: len(a) // 2] | a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] | b[len(b) // 2 :]
    common = a & b
    return min(na - int(np.bitwise_count(a ^ common).sum()), nb - int(np.bitwise_count(b ^ common).sum()))


def least_overlap(na: int, nb: int, percent: int) -> int:
    """The smallest intersection with 100 * i >= percent * (na + nb - i)."""
    return -(-percent * (na + nb) // (100 + percent))


def _sorted_overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) if len(b) else 0


def _arrays(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype=U64) if x.is_valid and len(x.as_buffer()) else np.empty(0, dtype=U64) for x in column]


def text_key(text: Column) -> Column:
    """Tells texts under one doc_id apart."""
    return F.xxhash64(text.cast("string"))


def shingle_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n, sid, shingles, bitmap, key) for each row of docs (doc_id, text): its set, sorted, and the set's id.

    key is text_key() of the text; sid is a 64-bit fingerprint of the set, 0 for the empty one (null, empty or blank text); shingles are
    little-endian 64-bit fingerprints. Of equal sets in a task the first only carries shingles and bitmap, so that a large group of
    copies is a few rows to whatever comes next.
    """

    @lean
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, 1, rows=TEXTS, size=4 << 20):
                values, at = shingle_hashes(*word_hashes(part.column(1).to_pylist()), width)
                sets = [values[a:b] for a, b in zip(at[:-1], at[1:])]
                raw: list[bytes | None] = [s.tobytes() for s in sets]
                sid = [int.from_bytes(hashlib.blake2b(r, digest_size=8).digest(), "little", signed=True) if r else 0 for r in raw]
                bits: list[bytes | None] = []
                for k, one in enumerate(sid):
                    again = one in seen
                    seen.add(one)
                    raw[k] = None if again else raw[k]
                    bits.append(None if again else bitmap(sets[k]).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sid, pa.int64()), pa.array(raw, pa.binary()), pa.array(bits, pa.binary()), part.column(2)],
                    names=["doc_id", "n", "sid", "shingles", "bitmap", "key"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_key(F.col("text")).alias("key")).mapInArrow(
        make, "doc_id bigint, n bigint, sid bigint, shingles binary, bitmap binary, key bigint"
    )


def _region(values: np.ndarray, percent: int) -> int:
    """How many of a set's first shingles are counted at once: half as many again as a prefix has."""
    return 3 * _prefix_size(len(values), percent) // 2


def _frequent(sets: DataFrame, percent: int, at: int, limit: int) -> np.ndarray:
    """The first 48 bits of frequent shingles, ascending. At most limit, the most frequent, so it has a fixed size.

    Counted over all sets are the shingles that may come into a prefix: those of its region first, and then, of the
    sets whose region has too few that are not frequent, all the others. They only shape the order of shingles, and
    any order gives the same links.
    """
    first = _counted(sets, percent, at, limit, None)
    return np.union1d(first, _counted(sets, percent, at, limit, _Order(first, percent)))


def _counted(sets: DataFrame, percent: int, at: int, limit: int, order: _Order | None) -> np.ndarray:
    """Shingles in at or more of the regions; with an order, in the rest of those sets whose region is short in it."""
    many = sets.agg(F.sum("n")).first()[0] or 0
    parts = 1 << (max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), many // COUNTED, 1) - 1).bit_length()
    shift = U64(64 - (parts.bit_length() - 1))

    @lean
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = [x[: _region(x, percent)] for x in _arrays(batch.column(0))] if order is None else [x[_region(x, percent) :] for x in _arrays(batch.column(0)) if order.short(x)]
            if sum(map(len, low)):
                value = np.sort(np.concatenate(low))
                cuts = np.searchsorted(value >> shift, np.arange(parts + 1).astype(U64)) if parts > 1 else np.array([0, len(value)])
                value = value >> U64(16)
                some = np.flatnonzero(np.diff(cuts))
                blobs = [(value[cuts[i] : cuts[i + 1]] >> U64(16)).astype(np.uint32).tobytes() + value[cuts[i] : cuts[i + 1]].astype(np.uint16).tobytes() for i in some]
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(blobs, pa.binary())], names=["shard", "values"])

    def count(held: pa.Table) -> pa.Table:
        found = []
        for raw in held.column("values").to_pylist():
            n = len(raw) // 6
            found.append((np.frombuffer(raw, np.uint32, n).astype(U64) << U64(16)) | np.frombuffer(raw, np.uint16, n, 4 * n).astype(U64))
        value, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.table({"shingle": pa.array(value[n >= at].astype(np.int64)), "c": pa.array(n[n >= at].astype(np.int64))})

    counted = sets.select("shingles").mapInArrow(deal, "shard int, values binary").groupBy("shard").applyInArrow(count, "shingle bigint, c bigint")
    return np.sort(counted.orderBy(F.desc("c"), "shingle").limit(limit).toArrow().column("shingle").to_numpy()).astype(U64)


def _prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


class _Order:
    """Prefixes of sets in the order (frequent or not, fingerprint)."""

    def __init__(self, frequent: np.ndarray, percent: int) -> None:
        self.frequent, self.percent = frequent, percent

    def prefix(self, values: np.ndarray) -> tuple[np.ndarray, bool]:
        """The rare part of the prefix, and whether the prefix has frequent shingles too."""
        size = _prefix_size(len(values), self.percent)
        rare = values[self.is_rare(values)]
        return rare[:size], len(rare) < size

    def is_rare(self, values: np.ndarray) -> np.ndarray:
        if not len(self.frequent):
            return np.ones(len(values), dtype=bool)
        short = values >> U64(16)
        at = np.searchsorted(self.frequent, short)
        at[at == len(self.frequent)] = 0
        return self.frequent[at] != short

    def short(self, values: np.ndarray) -> bool:
        """Whether the prefix reaches beyond the region."""
        return int(self.is_rare(values[: _region(values, self.percent)]).sum()) < _prefix_size(len(values), self.percent)


class _Sets:
    """Disjoint sets over positions 0..n-1."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def join(self, a: int, b: int) -> None:
        x, y = self.label[a], self.label[b]
        if x != y:
            self.label[self.label == max(x, y)] = min(x, y)


def _block_links(sids: np.ndarray, sets: list[np.ndarray], left: int, percent: int) -> list[tuple[int, int]]:
    """Links that span the components within a tile; rows [0, left) meet the later ones and, if left is 0, each other.

    Pairs whose members some chain of found links already joins are not looked at again.
    """
    n = np.array([len(s) for s in sets])
    width = min(bitmap_bits(int(n.max())), 1 << 16)
    bits = np.zeros((len(sets), width // 8), dtype=np.uint8)
    for i, s in enumerate(sets):
        one = np.zeros(width, dtype=np.uint8)
        one[(s & U64(width - 1)).astype(np.int64)] = 1
        bits[i] = np.packbits(one)
    words = bits.view(np.uint64)
    joined, links = _Sets(len(sets)), []
    for i in range(left or len(sets)):
        j = np.arange(left or i + 1, len(sets))
        j = j[(joined.label[j] != joined.label[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))]
        if not len(j):
            continue
        common = words[j] & words[i]
        lacking = np.bitwise_count(words[i] ^ common).sum(axis=1, dtype=np.int64)
        extra = np.bitwise_count(words[j] ^ common).sum(axis=1, dtype=np.int64)
        bound = np.minimum(n[i] - lacking, n[j] - extra)
        need = -(-percent * (n[i] + n[j]) // (100 + percent))
        j, bound = j[bound >= need], bound[bound >= need]
        for k in j[np.argsort(-bound, kind="stable")]:
            if joined.label[k] != joined.label[i] and _sorted_overlap(sets[i], sets[k]) >= least_overlap(n[i], n[k], percent):
                joined.join(i, k)
                links.append((int(sids[i]), int(sids[k])))
    return links


def _semi(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, "left_semi")


def links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): links between set ids of a table of shingle_sets(), enough to join whatever any chain of links joins.

    Two sets link when 100 * intersection >= percent * union, which is tested exactly. Of pairs within the rare
    tiles every link is returned; within blocks of frequent ones, a spanning part of them. Empty sets link with
    nothing.
    """
    spark = sets.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = _Order(_frequent(sets, percent, FREQUENT_AT, FREQUENT_LIMIT), percent)

    @lean
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            found = [order.prefix(v)[0] for v in _arrays(batch.column(2))]
            size = [len(f) for f in found]
            if sum(size):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(sid, size)), pa.array(np.repeat(n, size))], names=["shingle", "sid", "n"]
                )

    @lean
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by shingle, n and sid; what later rows can still pair with is all that is held."""
        key, sid, n = (np.empty(0, dtype=np.int64) for _ in range(3))
        found, size = [], 0
        for batch in batches:
            old = len(key)
            key, sid, n = (np.concatenate([a, batch.column(k).to_numpy()]) for k, a in enumerate((key, sid, n)))
            keep = np.ones(len(key), dtype=bool)
            keep[1:] = (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])
            key, sid, n = key[keep], sid[keep], n[keep]
            old, gap = int(keep[:old].sum()), 1
            live = np.arange(len(key))
            while len(live):  # pairs a step apart in a tile's order of size, then two steps, ...: as far as its largest tile goes
                live = live[live + gap < len(key)]
                live = live[(key[live] == key[live + gap]) & (100 * n[live] >= percent * n[live + gap])]
                new = live[live + gap >= old]
                if len(new):
                    a, b = sid[new], sid[new + gap]
                    found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1))
                    size += len(new)
                if size >= PAIRS:
                    yield unique(found)
                    found, size = [], 0
                gap += 1
            if len(key):
                rest = (key == key[-1]) & (100 * n >= percent * n[-1])
                key, sid, n = key[rest], sid[rest], n[rest]
        if found:
            yield unique(found)

    def unique(found: list[np.ndarray]) -> pa.RecordBatch:
        out = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(out[:, 0])), pa.array(np.ascontiguousarray(out[:, 1]))], names=["a", "b"])

    some = sets.where("n > 0 and shingles is not null")
    met = some.select("sid", "n", "shingles").mapInArrow(members, "shingle bigint, sid bigint, n bigint")
    in_order = met.select("shingle", "sid", "n").repartition(parts, "shingle").sortWithinPartitions("shingle", "n", "sid")
    proposed = table(in_order.mapInArrow(pairs, "a bigint, b bigint").distinct(), "proposed")

    @lean
    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            maps = [[np.frombuffer(x.as_buffer(), dtype=np.uint8) for x in batch.column(c)] for c in (3, 5)]
            keep = [overlap_bound(x, p, y, q) >= least_overlap(p, q, percent) for x, p, y, q in zip(maps[0], na, maps[1], nb)]
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    @lean
    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_sorted_overlap(x, y) >= least_overlap(len(x), len(y), percent) for x, y in zip(_arrays(batch.column(2)), _arrays(batch.column(3)))]
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    spent = [proposed]

    def with_both(of: DataFrame, columns: list[str]) -> DataFrame:
        ids = of.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
        mine = table(_semi(some.select("sid", *columns), ids, "sid").dropDuplicates(["sid"]), "mine")
        spent.append(mine)
        out = of
        for side in "ab":
            out = out.join(mine.select(F.col("sid").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
        return out.select("a", "b", *[f"{c}_{side}" for side in "ab" for c in columns])

    likely = table(with_both(proposed, ["n", "bitmap"]).mapInArrow(bounded, "a bigint, b bigint"), "likely")
    rare = with_both(likely, ["shingles"]).mapInArrow(verified, "a bigint, b bigint")
    them = _frequent_ones(some, order)
    out = table(rare.unionByName(_frequent_links(them, percent)), "links")
    for old in (*spent, likely, them):
        release(old)
    return out


def _frequent_ones(some: DataFrame, order: _Order) -> DataFrame:
    """The classes (sid, n, shingles) whose prefix has frequent shingles."""

    @lean
    def frequent_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([order.prefix(v)[1] for v in _arrays(batch.column(2))], pa.bool_()))

    return table(some.select("sid", "n", "shingles").mapInArrow(frequent_ones, "sid bigint, n bigint, shingles binary").dropDuplicates(["sid"]), "frequent")


def _frequent_links(them: DataFrame, percent: int) -> DataFrame:
    """Links among classes whose prefix has frequent shingles: tiles of blocks in order of size."""
    spark = them.sparkSession
    sizes = them.groupBy("n").count().orderBy("n").toArrow().to_pydict()  # a row for each size of set
    if not sizes["n"]:
        return spark.createDataFrame([], "a bigint, b bigint")
    # size n holds the ranks [first, first + count); a class goes into a block of its size's range by its hash
    n, count = (np.array(sizes[c], dtype=np.int64) for c in ("n", "count"))
    seen = np.cumsum(count) - count
    first, last = seen // BLOCK, (seen + count - 1) // BLOCK
    # a class of size n meets the blocks from its own to the last whose smallest size is within n's band
    least_in = n[np.searchsorted(last, np.arange(last[-1] + 1))]  # smallest size of each block
    most_in = n[np.searchsorted(first, np.arange(last[-1] + 1), side="right") - 1]
    reach = np.searchsorted(least_in, 100 * most_in // percent, side="right") - 1  # the last block that block i meets
    back = np.searchsorted(reach, np.arange(last[-1] + 1))  # the first block that meets block j
    columns = [x.tolist() for x in (n, first, last - first + 1)]
    where = spark.createDataFrame(list(zip(*columns)), "n bigint, first bigint, many bigint")  # a row for each size
    meets = spark.createDataFrame(list(zip(range(len(reach)), reach.tolist(), back.tolist())), "block bigint, reach bigint, back bigint")  # and for each block
    small = lambda df, rows: F.broadcast(df) if rows <= BROADCAST_IDS else df
    dealt = them.join(small(where, len(n)), "n").withColumn("block", F.col("first") + F.pmod(F.xxhash64("sid"), F.col("many")))
    dealt = dealt.join(small(meets, len(reach)), "block")
    left = F.transform(F.sequence("block", "reach"), lambda j: F.struct(F.col("block").alias("i"), j.alias("j"), (j != F.col("block")).cast("int").alias("is_left")))
    right = F.transform(F.sequence("back", F.col("block")), lambda i: F.struct(i.alias("i"), F.col("block").alias("j"), F.lit(0).alias("is_left")))
    tiles = F.concat(left, F.filter(right, lambda t: t["i"] != t["j"]))
    placed = dealt.select(F.explode(tiles).alias("t"), "sid", "shingles").select("t.i", "t.j", "t.is_left", "sid", "shingles")

    def tile(held: pa.Table) -> pa.Table:
        held = held.sort_by([("is_left", "descending"), ("sid", "ascending")])
        sets = _arrays(held.column("shingles").combine_chunks())
        out = _block_links(held.column("sid").to_numpy(), sets, sum(held.column("is_left").to_pylist()), percent)
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return placed.groupBy("i", "j").applyInArrow(tile, "a bigint, b bigint")


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, key, n, top) for each row of docs: top (none, rep, sid) stands for its component and is null without words.

    rep is the component's smallest doc_id, none whether all are null.
    """
    sets = table(shingle_sets(docs, width), "sets", codec="none")
    found = links(sets, percent)
    slim = table(sets.select("doc_id", "key", "n", "sid"), "slim")
    release(sets)
    sets = slim
    # nodes are in order of their classes' smallest doc_id, null last, and differ where classes share it
    least = sets.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("rep"))
    node = F.struct(F.col("rep").isNull().alias("none"), F.coalesce("rep", F.lit(0).cast("long")).alias("rep"), F.col("sid").alias("sid"))
    least = table(least.select("sid", node.alias("node")), "classes")
    ids = found
    for side in "ab":
        ids = ids.join(least.select(F.col("sid").alias(side), F.col("node").alias(f"r{side}")), side)
    groups = table(components(ids.select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "groups")
    linked = groups.select(F.col("node.sid").alias("sid"), "component")
    named = least.join(linked, "sid", "left").select("sid", F.coalesce("component", "node").alias("top"))
    full = sets.where("n > 0").join(named, "sid").select("doc_id", "key", "n", "top")
    return full.unionByName(sets.where("n = 0").select("doc_id", "key", "n"), allowMissingColumns=True)


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs (doc_id, text); other columns are not looked at.

    component_id is the smallest doc_id that links reach. Texts without words (null, empty, blank) have no
    shingles and are components of their own. Repeated doc_ids give repeated rows; different texts under one are
    joined by links only. Rows with a null doc_id take part; component_id is null where no doc_id is reached. No
    rows give no rows.
    """
    smallest = F.when(F.col("n") == 0, F.col("doc_id")).when(~F.col("top.none"), F.col("top.rep"))
    return _grouped(docs, width, percent).select("doc_id", F.col("n").alias("n_shingles"), smallest.alias("component_id"))


def first_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, with all their columns, that have the smallest doc_id of their component, one of each.

    A component with null doc_ids only keeps one of these. Different texts under one doc_id are documents of their
    own; equal ones are one row. Rows without words stay, those with both doc_id and text equal as one row unless
    doc_id is null.
    """
    rows = table(_grouped(docs, width, percent), "grouped")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("f")
    with_words = rows.where("n > 0").groupBy("top").agg(first).select("f.doc_id", "f.key", F.lit(False).alias("own"))
    kept = with_words.unionByName(rows.where("n = 0").select("doc_id", "key", F.col("doc_id").isNull().alias("own")).distinct())
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key"), F.col("own").alias("kept_own"))
    mine = docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(F.col("kept_id")) & (text_key(docs["text"]) == F.col("kept_key")))
    return mine.withColumn("kept_own", F.when(F.col("kept_own"), F.monotonically_increasing_id())).dropDuplicates(["kept_id", "kept_key", "kept_own"]).select(docs.columns)
