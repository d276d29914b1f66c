"""Best-fit packing of token pieces into sequences by swap-based local search.

Lengths are whole numbers up to the capacity, so what has to be packed is a
histogram of fixed size. The driver packs that: best fit in descending order
first, then local search, which moves pieces and exchanges one for one or two
for one between underfull bins wherever the sum of squared fills grows, until
no exchange helps; bins that run empty go. Bins with the same contents are one
pattern with a count, so the work follows the patterns and not the pieces.
Every piece then finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pretokens import encode
from .store import release, table
from .text import lean

CAPACITY, END_ID, TEXTS = 1024, 2, 256
#: Offsets of the ranks are broadcast up to so many rows; beyond, the join shuffles.
BROADCAST_OFFSETS = 500_000

Pattern = tuple[int, ...]


def best_fit(lengths: dict[int, int], capacity: int) -> Counter[Pattern]:
    """Patterns (lengths in a bin, descending) and how many bins have each: every piece to the fullest bin with room."""
    open_bins: dict[int, Counter[Pattern]] = {}
    rooms: list[int] = []

    def put(pattern: Pattern, room: int, many: int) -> None:
        if room not in open_bins:
            open_bins[room] = Counter()
            insort(rooms, room)
        open_bins[room][pattern] += many

    for length in sorted(lengths, reverse=True):
        left = lengths[length]
        while left:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                pattern, many = next(iter(open_bins[room].items()))
                take = min(many, left)
                open_bins[room][pattern] -= take
                if not open_bins[room][pattern]:
                    del open_bins[room][pattern]
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(k)
                put((*pattern, length), room - length, take)
                left -= take
            else:
                fit = capacity // length
                if left >= fit:
                    put((length,) * fit, capacity - fit * length, left // fit)
                    left %= fit
                if left:
                    put((length,) * left, capacity - left * length, 1)
                    left = 0
    return sum(open_bins.values(), Counter())


def _swap(a: Pattern, b: Pattern, capacity: int) -> tuple[Pattern, Pattern] | None:
    """The exchange between two bins that adds most to the sum of squared fills; None if none does.

    a is the fuller bin and takes more than it gives: nothing for one (a move), one for one, or one for two.
    """
    room, low = capacity - sum(a), sum(b)
    best, found = 0, None
    for give in (None, *sorted(set(a))):
        given = give or 0
        for i, x in enumerate(b):
            if i and b[i - 1] == x and give is None:
                continue
            for y in (None, *(b[i + 1 :] if give is not None else ())):
                gain = x + (y or 0) - given
                if best < gain <= room and (sum(a) + gain) ** 2 + (low - gain) ** 2 > sum(a) ** 2 + low**2:
                    best, found = gain, (give, x, y)
    if not found:
        return None
    give, x, y = found
    to_a, to_b = list(a), list(b)
    if give is not None:
        to_a.remove(give)
        to_b.append(give)
    for z in (x, y):
        if z is not None:
            to_b.remove(z)
            to_a.append(z)
    return tuple(sorted(to_a, reverse=True)), tuple(sorted(to_b, reverse=True))


def local_search(bins: Counter[Pattern], capacity: int) -> Counter[Pattern]:
    """Exchanges between underfull bins until none helps, or until there are no more bins than the tokens need."""
    full = Counter({p: m for p, m in bins.items() if sum(p) == capacity})
    under = Counter({p: m for p, m in bins.items() if 0 < sum(p) < capacity})
    hopeless: set[tuple[Pattern, Pattern]] = set()
    least = -(-sum(sum(p) * m for p, m in bins.items()) // capacity)
    moved = True
    while moved and sum(full.values()) + sum(under.values()) > least:
        moved = False
        order = sorted(under, key=lambda p: (-sum(p), p))
        for b in reversed(order):  # empty the emptiest bins into the fullest
            for a in order:
                if not under[b]:
                    break
                if not under[a] or (a == b and under[a] < 2) or sum(a) < sum(b) or (a, b) in hopeless:
                    continue
                new = _swap(a, b, capacity)
                if new is None:
                    hopeless.add((a, b))
                    continue
                many = under[a] // 2 if a == b else min(under[a], under[b])
                under[a] -= many
                under[b] -= many
                for p in new:
                    (full if sum(p) == capacity else under)[p] += many if p else 0
                moved = True
        under = Counter({p: m for p, m in under.items() if m and p})
    return full + under


class Places:
    """Where the r-th piece of each length goes; arrays as large as the patterns."""

    def __init__(self, bins: Counter[Pattern]) -> None:
        rows, base = [], 0
        for pattern, many in sorted(bins.items()):
            at = 0
            for length in sorted(set(pattern), reverse=True):
                copies = pattern.count(length)
                rows.append((length, copies, many, base, at))
                at += copies * length
            base += many
        rows.sort()
        self.sequences = base
        self.length, self.copies, self.many, self.base, self.at = (np.array(c, dtype=np.int64) for c in (zip(*rows) if rows else [()] * 5))
        taken = self.copies * self.many
        self.end = np.cumsum(taken)
        self.start = self.end - taken
        self.first = {int(x): int(self.start[i]) for x, i in zip(*np.unique(self.length, return_index=True))}

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = pd.Series(length).map(self.first).to_numpy(dtype=np.int64) + rank
        i = np.searchsorted(self.end, slot, side="right")
        k = slot - self.start[i]
        return self.base[i] + k % self.many[i], self.at[i] + k // self.many[i] * length


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids, part, local_rank) of each row of docs (doc_id, text).

    ids are a document's token ids and end_id behind them, as little-endian unsigned 32-bit numbers; documents of more
    than capacity are cut, and the first piece takes what is over. local_rank counts the pieces of a length within a
    task's part. A null text is an empty one and has the end id alone. tokenizer: path of a tokenizers file.
    """

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS):
                some = batch.slice(lo, TEXTS)
                ids, at = encode([t or "" for t in some.column(1).to_pylist()], tokenizer, end_id)
                size = np.diff(at)
                many = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                over = (size - (many - 1) * capacity)[row]
                start = np.where(piece > 0, over + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, over)
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                run = np.arange(len(ranked)) - np.searchsorted(ranked, ranked)
                rank = np.empty(len(ranked), dtype=np.int64)
                rank[order] = run + seen[ranked]
                seen += np.bincount(length, minlength=capacity + 1)
                raw = ids.astype("<u4").tobytes()
                begin = 4 * (at[:-1][row] + start)
                body = pa.array([raw[b : b + 4 * n] for b, n in zip(begin.tolist(), length.tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), body, pa.array(np.full(len(row), part, dtype=np.int32)), pa.array(rank)],
                    names=["doc_id", "piece", "start", "length", "ids", "part", "local_rank"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        cut, "doc_id bigint, piece int, start bigint, length bigint, ids binary, part int, local_rank bigint"
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset): a row for each piece of each row of docs (doc_id, text).

    Sequences hold at most capacity tokens and are gapless from offset 0. Repeated rows are packed each; no rows give
    none; other columns are not looked at.
    """
    spark = docs.sparkSession
    cut = table(pieces(docs, tokenizer, capacity, end_id), "pieces")
    counts = table(cut.groupBy("part", "length").count(), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).toLocalIterator()}
    places = Places(local_search(best_fit(histogram, capacity), capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = table(counts.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")), "offsets")
    release(counts)
    rows = offsets.count()
    shared = spark.sparkContext.broadcast(places)

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = shared.value(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    ranked = cut.join(F.broadcast(offsets) if rows <= BROADCAST_OFFSETS else offsets, ["part", "length"])
    return ranked.withColumn("at", place("length", F.col("before") + F.col("local_rank"))).select(
        "doc_id", "piece", "start", "length", "ids", F.col("at.sequence_id").alias("sequence_id"), F.col("at.offset").alias("offset")
    )
