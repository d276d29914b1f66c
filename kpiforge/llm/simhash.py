"""SimHash near-duplicates: a grid range-join of segment popcounts, verified exactly.

A fingerprint of 64 bits is embedded as the bit counts of its 32 segments of two
bits. One bit that differs moves one count by one at most, so the Manhattan
distance of two embeddings is a lower bound of the Hamming distance. Counts are
kept in unary (two bits a segment), where Manhattan distance is a bit count too.

The segments are dealt into groups, and a choice of all groups but the radius is
a grid: a cell is the counts of its groups' segments. Embeddings within the
radius differ in no more groups than that, so they share a cell of some grid.
Members of a cell are compared, the bound first and fingerprints then. Cells
with many members are compared block by block, and what is handed on are stars
that span a block's links, so neither a task's memory nor its output grows with
the square of a cell. Equal fingerprints are one from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import release, table
from .text import CHUNK_BYTES, U64, lean, mix, slices

WIDTH, RADIUS, SEED = 4, 4, 42
SEGMENTS, MOST_GROUPS = 32, 10
#: Members of a cell that are compared at once; cells with more are cut into blocks. Members that a cell should have, on average.
BLOCK, CELL = 1024, 16
#: Hot cells are broadcast up to so many; beyond, the same join shuffles.
BROADCAST_CELLS = 500_000
#: Shingles whose bits are counted at once; links that a task holds.
SHINGLES, LINKS = 1 << 15, 1 << 20
_EVEN = U64(0x5555555555555555)


def _shingles(raw: bytes, width: int) -> Iterator[bytes]:
    """Every shingle of a text's words, in order; the whole sequence if there are fewer words. The text is read in chunks."""
    held: list[bytes] = []
    pos, many = 0, 0
    while pos < len(raw):
        end = min(len(raw), pos + CHUNK_BYTES)
        while end < len(raw) and raw[end] not in b" \t\n\v\f\r":  # not within a word
            end += 1
        words = held + raw[pos:end].lower().split()
        pos = end
        if len(words) >= width:
            many += len(words) - width + 1
            for group in zip(*[words[k:] for k in range(width)]):
                yield b" ".join(group)
        held = words[max(0, len(words) - width + 1) :]
    if not many and held:
        yield b" ".join(held)


def fingerprint(raw: bytes, width: int = WIDTH) -> int:
    """The SimHash of a text's shingles, repeats included; zero without words."""
    ones, many = np.zeros(64, dtype=np.int64), 0
    held: list[int] = []

    def count() -> None:
        bits = np.unpackbits(np.array(held, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones[:] += bits.sum(axis=0, dtype=np.int64)

    for shingle in _shingles(raw, width):
        held.append(xxhash.xxh64_intdigest(shingle, SEED))
        many += 1
        if len(held) == SHINGLES:
            count()
            held = []
    if held:
        count()
    return int.from_bytes(np.packbits(2 * ones > many).tobytes(), "big") if many else 0


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fingerprint) for each row of docs (doc_id, text): the 64 bits as a signed number; zero for null, empty and blank texts."""

    @lean
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, rows=512):
                raws = part.column(1).cast(pa.binary())
                found = np.array([fingerprint(x.as_py() or b"", width) for x in raws], dtype=U64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(make, "doc_id bigint, fingerprint bigint")


def unary(x: np.ndarray) -> np.ndarray:
    """The embedding: each two bits' count as 00, 01 or 11, so that differing bits are the Manhattan distance of the counts."""
    high, low = (x >> U64(1)) & _EVEN, x & _EVEN
    return ((high & low) << U64(1)) | high | low


def groups_for(n: int, radius: int) -> int:
    """Groups of segments: the fewest with which n random embeddings leave no more than CELL in a cell of a grid, MOST_GROUPS at most.

    Any number gives the same links. Two random segments have equal counts with a chance of 3/8.
    """
    for groups in range(radius + 1, MOST_GROUPS):
        if n * 0.375 ** (SEGMENTS * (groups - radius) / groups) <= CELL:
            return groups
    return MOST_GROUPS


def grids(groups: int, radius: int) -> list[np.uint64]:
    """The bits that each grid looks at."""
    edges = [SEGMENTS * g // groups for g in range(groups + 1)]
    group = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(edges, edges[1:])]
    return [U64(sum(group[g] for g in some)) for some in combinations(range(groups), groups - radius)]


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as join what the links (a, b) join: each node's smallest one within reach."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b):
            np.minimum.at(new, label[side], low)
            np.minimum.at(new, side, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    some = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[some], nodes[label[some]]


def _matches(cell: np.ndarray, fp: np.ndarray, side: np.ndarray, old: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within runs of equal cells; the first `old` rows have been compared with each other. side: 0 meets all, 1 meets 2 only."""
    counts, live, gap = unary(fp), np.arange(len(cell)), 1
    while len(live):  # rows a step apart, then two, ...: as far as the longest run goes
        live = live[live + gap < len(cell)]
        live = live[cell[live] == cell[live + gap]]
        new = live[(live + gap >= old) & ((side[live] != side[live + gap]) | (side[live] == 0))]
        new = new[np.bitwise_count(counts[new] ^ counts[new + gap]) <= radius]  # the lower bound
        new = new[(np.bitwise_count(fp[new] ^ fp[new + gap]) <= radius) & (fp[new] != fp[new + gap])]
        if len(new):
            yield fp[new], fp[new + gap]
        gap += 1


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between distinct fingerprints (a table with a column fingerprint) that join whatever any chain of links joins.

    Two fingerprints link when they differ in at most radius bits.
    """
    spark = classes.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    masks = grids(groups_for(classes.count(), radius), radius)

    @lean
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(U64)
            counts = unary(fp)
            with np.errstate(over="ignore"):
                cell = np.concatenate([mix((counts & m) ^ mix(np.full(1, k + 1, dtype=U64))) for k, m in enumerate(masks)])  # cells that share a key cost time only
            yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(np.tile(fp, len(masks)).view(np.int64))], names=["cell", "fp"])

    @lean
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of cell and block; what the last run still can meet is all that is held, two blocks at most."""
        held = [np.empty(0, dtype=np.int64)] * 3 + [np.empty(0, dtype=U64)]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            old = len(held[0])
            i_cell, i, j = (np.concatenate([h, batch.column(k).to_numpy()]) for k, h in enumerate(held[:3]))
            fp = np.concatenate([held[3], batch.column(3).to_numpy().view(U64)])
            new = np.ones(len(fp), dtype=bool)
            new[1:] = (i_cell[1:] != i_cell[:-1]) | (i[1:] != i[:-1]) | ((j >> 2)[1:] != (j >> 2)[:-1])
            run = np.cumsum(new)
            for a, b in _matches(run, fp, j & 3, old, radius):
                found.append((a, b))
                size += len(a)
                if size >= LINKS:
                    found = [stars(*(np.concatenate(x) for x in zip(*found)))]
                    size = len(found[0][0])
                    if 2 * size >= LINKS:
                        yield rows(found)
                        found, size = [], 0
            last = run == run[-1] if len(run) else np.zeros(0, dtype=bool)
            held = [x[last] for x in (i_cell, i, j, fp)]
        if found:
            yield rows(found)

    def rows(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b = stars(*(np.concatenate(x) for x in zip(*found)))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    members = classes.select("fingerprint").mapInArrow(cells, "cell bigint, fp bigint")
    hot = table(members.groupBy("cell").count().where(F.col("count") > BLOCK).select("cell", F.ceil(F.col("count") / BLOCK).alias("blocks")), "hot")
    # a block of a hot cell meets itself and every other one; of two blocks, i < j, the first's rows have side 1 and the other's side 2 (j holds the side in its last bits)
    dealt = members.join(F.broadcast(hot) if hot.count() <= BROADCAST_CELLS else hot, "cell", "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    tile = lambda i, j, side: F.struct(i.cast("long").alias("i"), (j * 4 + side).cast("long").alias("j"))
    others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda o: F.when(o == own, tile(own, own, 0)).when(own < o, tile(own, o, 1)).otherwise(tile(o, own, 2)))
    alone = F.array(tile(F.lit(0), F.lit(0), 0))
    placed = dealt.select("cell", F.explode(F.when(F.col("blocks").isNull(), alone).otherwise(others)).alias("t"), "fp").select("cell", "t.i", "t.j", "fp")
    in_order = placed.withColumn("jj", F.shiftright("j", 2)).repartition(parts, "cell", "i", "jj").sortWithinPartitions("cell", "i", "jj").select("cell", "i", "j", "fp")
    out = table(in_order.mapInArrow(compare, "a bigint, b bigint"), "links")
    release(hot)
    return out


def near_duplicates(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs (doc_id, text): fingerprint as a signed number, component_id the
    smallest doc_id that links between fingerprints within radius reach, its own included.

    Texts without words (null, empty, blank) have the fingerprint zero and link as any other. Repeated rows stay; rows with
    a null doc_id take part, and component_id is null where no doc_id is reached. Other columns are not looked at; no rows
    give no rows.
    """
    found = table(fingerprints(docs, width), "fingerprints")
    classes = table(found.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "classes")
    between = links(classes, radius)
    reached = components(between).select(F.col("node").alias("fingerprint"), "component")
    joined = table(classes.join(reached, "fingerprint", "left").select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")), "joined")
    for old in (between, classes):
        release(old)
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.select("fingerprint", "component").join(least, "component").select("fingerprint", "component_id")
    return found.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")
