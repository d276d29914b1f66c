"""Benchmark decontamination with DataFrame functions only.

Every benchmark item of L words is held against windows of L words of each
document; a document of fewer words is one window as a whole. A window and an item have 64-bit SimHashes over their five-word
shingles. The fingerprints are cut into blocks, and two of them within the
radius must agree in one block up to one bit, so a join on (L, block, value)
finds every pair within the radius. The exact weighted Jaccard similarity of
the shingle multisets then decides.

Words are lower-cased runs of letters and digits. Before any fingerprint is
made, windows that cannot reach the threshold are left out: intersection >=
t * union >= t * size(window) needs that many of the window's shingles to be
shingles of some benchmark item. The same holds with the item's size, which a
shorter document's shingles have to reach.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import release, table

WIDTH, THRESHOLD, RADIUS, BITS = 5, 0.8, 19, 64
#: A side is broadcast below so many rows (two longs each); above, the join shuffles.
BROADCAST_ROWS = 1_000_000
#: Windows begin in segments of so many words, or of the longest item's, and carry no more of a long document.
SEGMENT = 512


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; none for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(w: Column, width: int) -> Column:
    """Hashes of the runs of width words, by position; none if there are fewer words."""
    at = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)])
    return F.when(F.size(w) >= width, F.transform(F.sequence(F.lit(0), F.size(w) - width), at)).otherwise(F.array().cast("array<bigint>"))


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, bits) of blocks so many that two fingerprints within the radius differ by at most one bit in one of them."""
    n = radius // 2 + 1
    sizes = [BITS // n + (i < BITS % n) for i in range(n)]
    return [(sum(sizes[:i]), sizes[i]) for i in range(n)]


def _lane_mask(lane: int) -> int:
    """The lowest bit of each counter in a long."""
    return sum(1 << i for i in range(0, BITS, lane))


def simhash(shingles: Column, lane: int) -> Column:
    """Counters of the fingerprint's bits over an array of shingle hashes, repeats counted; lane: bits of a counter.

    Counters share longs: sum k counts the bits k, k + lane, k + 2 * lane, ... of the hashes in lanes of their own.
    """
    mask = F.lit(_lane_mask(lane))

    def tally(k: Column) -> Column:
        return F.aggregate(shingles, F.lit(0).cast("long"), lambda acc, x: acc + F.call_function("shiftrightunsigned", x, k).bitwiseAND(mask))

    return F.transform(F.sequence(F.lit(0), F.lit(lane - 1)), tally)


def _signs(sums: str, size: Column, lane: int) -> Column:
    bits = []
    for bit in range(BITS):
        count = F.shiftrightunsigned(F.get(F.col(sums), F.lit(bit % lane)), bit // lane * lane).bitwiseAND(F.lit((1 << lane) - 1))
        one = F.lit((1 << bit) - (1 << BITS if bit == BITS - 1 else 0))
        bits.append(F.when(2 * count > size, one).otherwise(F.lit(0).cast("long")))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _similarity(a: Column, b: Column) -> Column:
    """Sum of smaller counts over sum of larger counts of the shingles of two arrays."""
    count = lambda arr, x: F.size(F.filter(arr, lambda y: y == x))
    common = F.array_intersect(a, b)
    once = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    both = F.when(once, F.size(common)).otherwise(F.aggregate(common, F.lit(0), lambda acc, x: acc + F.least(count(a, x), count(b, x))))
    return both / (F.size(a) + F.size(b) - both)


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _row_key() -> Column:
    """Tells rows apart by doc_id, null included, and text."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text")


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, start, n_words, distance, similarity): each document and item with a window as similar as threshold.

    docs: (doc_id, text), benchmark: (item_id, text); other columns are not looked at. start: the word where the
    best window begins, from 0; ties go to the first. n_words: of the window, fewer than the item's if the document is
    shorter. distance: of the fingerprints. Null or empty texts and items
    match nothing. An item of fewer than five words has its whole sequence as one shingle. Repeated item ids count as
    one each; repeated rows of docs give one row, and so do different texts under one doc_id, each of them compared.
    A null doc_id or item_id counts as an id. The verification is exact; pairs of fingerprints further apart
    than radius are not candidates (about one in 2000 at a similarity of just 0.8, none for equal passages).
    """
    best = F.max_by(F.struct("start", "n", "distance", "similarity"), F.struct(F.col("similarity").alias("s"), (-F.col("start")).alias("t"), F.col("n").alias("u")))
    return (
        _matches(docs, benchmark, threshold, radius)
        .groupBy("doc_id", "item_id").agg(best.alias("b"))
        .select("doc_id", "item_id", F.col("b.start").alias("start"), F.col("b.n").alias("n_words"), F.col("b.distance").cast("int").alias("distance"), F.col("b.similarity").alias("similarity"))
    )


def _matches(docs: DataFrame, benchmark: DataFrame, threshold: float, radius: int) -> DataFrame:
    """(row, doc_id, item_id, start, n, distance, similarity) of all windows as similar as threshold; row: _row_key()."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0).distinct().withColumn("n", F.size("w")).withColumn("width", F.least("n", F.lit(WIDTH)))
    shingled = None
    for width in range(1, WIDTH + 1):
        shingled = F.when(F.col("width") == width, _shingles(F.col("w"), width)) if shingled is None else shingled.when(F.col("width") == width, _shingles(F.col("w"), width))
    items = table(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "n", "width", shingled.alias("item_shingles")), "items")
    known = items.agg(F.max("n"), F.sum(F.size("item_shingles")), F.count("*"), F.sort_array(F.collect_set("width")), F.countDistinct("n")).first()
    longest, of_items, many, widths, sizes = known[0] or 0, known[1], known[2], list(known[3]), known[4]
    lane = 16 if longest < 1 << 16 else 32
    schema = "row bigint, doc_id bigint, item_id bigint, start int, n int, distance int, similarity double"
    if not widths:
        return spark.createDataFrame([], schema)
    lengths = items.select(F.col("n"), "width").distinct().withColumn("need", F.greatest(F.ceil(threshold * (F.col("n") - F.col("width") + 1)), F.lit(1)).cast("int"))
    least = lengths.groupBy("width").agg(F.min("need").alias("least"))  # a row for each width, WIDTH at most
    # a segment has the windows that begin in its step; its shingles reach as far as the longest of them
    step = max(SEGMENT, longest)

    # 1. positions whose shingle any item has, for each segment that reaches there
    split = docs.select(_row_key().alias("row"), "doc_id", words(F.col("text")).alias("w"))
    keys = items.select("width", F.explode("item_shingles").alias("shingle")).distinct()
    hits = None
    for width in widths:
        own = split.select("row", F.posexplode(_shingles(F.col("w"), width)).alias("pos", "shingle"))
        found = own.join(_maybe_broadcast(keys.where(F.col("width") == width).select("shingle"), of_items), "shingle", "left_semi").select("row", F.lit(width).alias("width"), "pos")
        hits = found if hits is None else hits.unionByName(found)
    segment = lambda pos: F.greatest(F.floor(pos / step), F.lit(0)).cast("int")
    hits = hits.distinct().withColumn("segment", F.explode(F.sequence(segment(F.col("pos") - longest), segment(F.col("pos")))))
    grouped = hits.groupBy("row", "width", "segment").agg(F.sort_array(F.collect_list("pos")).alias("hits"))
    grouped = table(grouped.join(F.broadcast(least), "width").where(F.size("hits") >= F.col("least")).drop("least"), "hits")

    # 2. their shingles, and windows of each item's size that hold enough of such positions
    rows = grouped.groupBy("row").agg(F.collect_set("segment").alias("segments"))
    mine = split.join(_maybe_broadcast(rows, 20 * grouped.count()), "row").dropDuplicates(["row"])
    near = None
    for width in widths:
        shingles = mine.select("row", "doc_id", F.size("w").alias("size"), "segments", _shingles(F.col("w"), width).alias("shingles"))
        cut = F.transform("segments", lambda g: F.struct(g.alias("segment"), F.slice("shingles", g * step + 1, step + longest).alias("shingles")))
        one = shingles.select("row", "doc_id", "size", F.explode(cut).alias("g")).select("row", "doc_id", "size", "g.segment", "g.shingles")
        one = one.join(grouped.where(F.col("width") == width), ["row", "segment"])
        near = one if near is None else near.unionByName(one)
    near = table(near, "near")
    first = F.col("at")
    last = F.get(F.col("hits"), F.col("k") + F.col("need") - 1)
    before = F.when(F.col("k") > 0, F.get(F.col("hits"), F.col("k") - 1) + 1).otherwise(F.lit(0))
    # a document shorter than the item is its one window, from 0
    words_of = F.least("n", "size")
    run = words_of - F.col("width")
    begin = F.col("segment") * step
    inside = lambda start, n: F.slice("shingles", start - begin + 1, n - F.col("width") + 1)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    windows = (
        near.repartition(parts, "row", "segment", "width")
        .join(_maybe_broadcast(lengths, sizes), "width")
        .where(F.size("hits") >= F.col("need"))
        .select("*", F.posexplode("hits").alias("k", "at"))
        .withColumn("low", F.greatest(before, last - run, begin))
        .withColumn("high", F.least(first, F.col("size") - words_of, begin + step - 1))
        .where(last.isNotNull() & (F.col("low") <= F.col("high")))
        .select("row", "segment", "n", "width", "shingles", F.explode(F.sequence("low", "high")).alias("start"))
        .select("row", "segment", "n", "start", F.explode(inside(F.col("start"), F.col("n"))).alias("shingle"))
    )
    # counters are summed as rows of the window's shingles, in compiled code; they are few numbers when they are shuffled
    sums = [F.sum(F.call_function("shiftrightunsigned", F.col("shingle"), F.lit(k)).bitwiseAND(F.lit(_lane_mask(lane)))).alias(f"s{k}") for k in range(lane)]
    counted = windows.groupBy("row", "segment", "n", "start").agg(*sums, F.count("*").alias("many"))
    marked = counted.select("row", "segment", "n", "start", F.array(*[f"s{k}" for k in range(lane)]).alias("sums"), "many")
    marked = marked.withColumn("print", _signs("sums", F.col("many"), lane)).drop("sums", "many")

    # 3. blocks: the item's side has each block's value and those one bit away
    blocks = _blocks(radius)
    part = lambda x, shift, bits: F.shiftrightunsigned(x, shift).bitwiseAND(F.lit((1 << bits) - 1))
    printed = items.withColumn("sums", simhash(F.col("item_shingles"), lane)).withColumn("item_print", _signs("sums", F.size("item_shingles"), lane)).drop("sums")
    values = [
        F.struct(F.lit(b).alias("block"), (part(F.col("item_print"), shift, bits).bitwiseXOR(F.lit(flip).cast("long"))).alias("value"))
        for b, (shift, bits) in enumerate(blocks)
        for flip in [0, *(1 << i for i in range(bits))]
    ]
    index = printed.select("item", "n", "item_print", F.explode(F.array(*values)).alias("v")).select("item", "n", "item_print", "v.block", "v.value")
    probes = F.array(*[F.struct(F.lit(b).alias("block"), part(F.col("print"), shift, bits).alias("value")) for b, (shift, bits) in enumerate(blocks)])
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    probed = marked.select("row", "segment", "n", "start", "print", F.explode(probes).alias("v")).select("row", "segment", "n", "start", "print", "v.block", "v.value")
    pairs = (
        probed.join(_maybe_broadcast(index, many * len(values)), ["n", "block", "value"])
        .withColumn("distance", distance)
        .where(F.col("distance") <= radius)
        .select("row", "segment", "n", "start", "item", "distance")
        .distinct()
    )

    # 4. exact similarity of what the blocks proposed
    pairs = table(pairs, "pairs")
    checked = (
        pairs.join(_maybe_broadcast(items.select("item", "item_id", "n", "width", "item_shingles"), of_items), ["item", "n"])
        .join(near.select("row", "segment", "doc_id", "width", "size", "shingles"), ["row", "segment", "width"])
        .withColumn("similarity", _similarity(inside(F.col("start"), F.col("n")), F.col("item_shingles")))
    )
    found = checked.where(F.col("similarity") >= threshold).select("row", "doc_id", "item_id", "start", F.least("n", "size").alias("n"), "distance", "similarity")
    out = table(found, "matches")
    for old in (items, grouped, near, pairs):
        release(old)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns and a null doc_id or not, whose text has no benchmark passage."""
    found = _matches(docs, benchmark, THRESHOLD, RADIUS).select(F.col("row").alias("found_row")).distinct()
    return docs.join(found, _row_key() == F.col("found_row"), "left_anti").select(docs.columns)
