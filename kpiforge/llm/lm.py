"""Language-model scoring with Elias-Fano n-gram tries.

Tokens are a text's words and one end. The model is of order four, smoothed by
interpolated absolute discounting: with a context h of c(h) training tokens and
t(h) different ones,

    p(w | h) = max(c(h, w) - d, 0) / c(h) + d * t(h) / c(h) * p(w | shorter h),

with a discount d for each order, down to p(w) = (c(w) + 1) / (N + V + 1). A
context that was not seen hands on to the shorter one.

Every token moves once, to the shard of its context's last word, where all
counts of contexts that end in this word are together. The shard builds a trie
of its training tokens: a level for contexts of one, two and three words, each
with the words that follow a context, their quantised smoothed probabilities,
and the quantised weight that is left to the shorter context. Levels are
Elias-Fano sequences in one memory-mapped buffer: 32 bits of each word, and in
unary the monotone pointers from a context to its words and to the contexts
with one more word in front. A word or longer context is found by successor
search among those of its context. What the trie knows of each document is
summed up and sent back.

* p(w) is needed where w is predicted. It is known everywhere for the words
  that make up a 2**20th of the training tokens or more; of other words a
  longer context that knows w takes p(w) as 0 there (it is below 2**-20), and
  where none does, log p(w) is added by the shard of w, which knows c(w) and
  whether the pair was seen, as w is the context of the token that follows.
* Contexts with so many tokens that one shard should not have them are dealt
  out by longer contexts, those of three words by document. All shards know
  their counts and their most frequent followers from a table of bounded size;
  other followers fall to the shorter context.

Where the whole model is asked for, neither leaves anything out, so a score
does not depend on how many tokens there are: a shard asks for the counts of
those rare words and rare followers of dealt contexts that its own tokens have,
and they come by a join.
"""

from __future__ import annotations

import heapq
import mmap
import struct
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .elias_fano import Codes, EliasFano
from .store import release, table
from .text import U64, lean, mix, slices, word_table

#: Discounts of orders two to four: the best on a seventh of the training documents of sf0.1, learnt from the others.
DISCOUNTS = (0.95, 0.9, 0.8)
#: Training tokens of a shard, about; a context with more of them is dealt out, and one with a HEAVY-th goes where there is room.
SHARD_TOKENS, HEAVY = 1_000_000, 16
#: Known everywhere: words with a KNOWN-th of the training tokens, followers of dealt contexts with a PAIRS-th.
KNOWN, PAIRS = 1 << 20, 1 << 16
#: Scores travel in units of so many to one.
UNITS = 1 << 14
#: Keys that a task counts before it hands them on.
HELD = 1 << 19
#: Fingerprints of the end, which no word has, and of the start, the context of a text's first token.
END, START = U64(0x5E4D_0E4D_5E4D_0E4D), U64(0x57A7_57A7_57A7_57A7)
#: Words that travel as two bytes, the most frequent ones; ESCAPE marks the others.
COMMON, ESCAPE = 65_535, 65_535
_MULT = U64(0x9E3779B97F4A7C15)
_HALF = U64(32)


def _first_context(word: np.ndarray) -> np.ndarray:
    """Keys of contexts of one word, given by 32 bits."""
    return mix(word.astype(U64) + U64(0xC0_17E8_7000_0001))


def _longer(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of contexts that begin with one more word; of a pair, if the word follows."""
    return mix(key * _MULT + word.astype(U64))


def _word_key(word: np.ndarray) -> np.ndarray:
    """Keys that counts of words, given by 32 bits, are asked for by."""
    return mix(word.astype(U64) + U64(0xA5_0BD0_0000_0001))


def _place(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key is among ascending ones, -1 for those that aren't there."""
    if not len(known):
        return np.full(len(keys), -1, dtype=np.int64)
    at = np.searchsorted(known, keys)
    at[at == len(known)] = 0
    return np.where(known[at] == keys, at, -1)


def _together(key: np.ndarray) -> np.ndarray:
    """An order that brings equal keys together, equal ones as they came. Keys are ordered by their first bits, the place takes the
    last ones, so that numbers are sorted, which is much faster than places; of keys alike in the first bits equal ones may be apart."""
    low = U64((1 << len(key).bit_length()) - 1)
    packed = (key & ~low) | np.arange(len(key), dtype=U64)
    packed.sort()
    return (packed & low).astype(np.int64)


def _once(key: np.ndarray) -> np.ndarray:
    """A place of each different key; of a few keys there may be more."""
    at = _together(key)
    found = key[at]
    return at[np.diff(found, prepend=~found[:1]) != 0]


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different key, and for each key the number of that place. Of a few keys there may be more, as of _together()."""
    at = _together(key)
    found = key[at]
    new = np.diff(found, prepend=~found[:1]) != 0
    of = np.empty(len(key), dtype=np.int64)
    of[at] = np.cumsum(new) - 1
    return at[new], of


@dataclass
class Shared:
    """What every shard knows, of bounded size. Each first array is ascending; the others go with it."""

    total: float
    words: np.ndarray
    counts: np.ndarray
    halves: np.ndarray
    unigram: np.ndarray
    common: np.ndarray
    ranks: np.ndarray
    by_rank: np.ndarray
    rank_counts: np.ndarray
    hot: np.ndarray
    left: np.ndarray
    pairs: np.ndarray
    chance: np.ndarray
    sizes: np.ndarray
    shards: int = 1
    heavy: np.ndarray = None
    heavy_shard: np.ndarray = None

    @classmethod
    def of(cls, words: np.ndarray, counts: np.ndarray, total: float) -> Shared:
        """words: fingerprints, with their counts, the end among them."""
        order = np.argsort(words)
        words, counts = words[order], counts[order]
        halves, first = np.unique((words >> _HALF).astype(np.uint32), return_index=True)
        most = np.lexsort((words, -counts))[: COMMON - 1]
        by_rank = np.r_[START, words[most]]
        by_word = np.argsort(by_rank)
        none = np.empty(0, dtype=U64), np.empty(0)
        return cls(total, words, counts, halves, (counts[first] + 1) / total, by_rank[by_word], by_word.astype(np.uint16), by_rank, np.r_[-1, counts[most]], *none, *none, np.empty(0, dtype=np.int64))

    def codes(self, token: np.ndarray) -> np.ndarray:
        """The two bytes that words travel as."""
        one, of = _distinct(token)
        at = _place(self.common, token[one])
        return np.where(at >= 0, self.ranks[at], ESCAPE).astype(np.uint16)[of]

    def count(self, token: np.ndarray) -> np.ndarray:
        """Training tokens of words that are known everywhere, -1 for others."""
        at = _place(self.words, token)
        return np.where(at >= 0, self.counts[at] if len(self.counts) else -1, -1)

    def spread(self, shards: int) -> None:
        """Deals contexts of one word into shards: heavy ones to the shard with the least of them, the others by key."""
        self.shards = shards
        some = np.flatnonzero((self.counts >= SHARD_TOKENS // HEAVY) & (self.counts < SHARD_TOKENS))
        keys = _first_context((self.words[some] >> _HALF).astype(np.uint32))
        load, place = [(0, s) for s in range(shards)], {}
        for k in np.lexsort((keys, -self.counts[some])).tolist():
            size, s = heapq.heappop(load)
            place[int(keys[k])] = s
            heapq.heappush(load, (size + int(self.counts[some[k]]), s))
        self.heavy = np.array(sorted(place), dtype=U64)
        self.heavy_shard = np.array([place[k] for k in sorted(place)], dtype=np.int64)

    def shard(self, key: np.ndarray) -> np.ndarray:
        """The shard of contexts by key."""
        out = ((mix(key) >> _HALF) * U64(self.shards) >> _HALF).astype(np.int64)
        at = _place(self.heavy, key)
        return np.where(at >= 0, self.heavy_shard[at], out) if len(self.heavy) else out

    def p1(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of words, given by 32 bits, and which of them are known; 0 for the others."""
        at = _place(self.halves, word)
        return np.where(at >= 0, self.unigram[at] if len(self.unigram) else 0.0, 0.0), at >= 0

    def chances(self, context: np.ndarray, word: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """p(w | h) in dealt contexts, given by key; lower: p(w) in the shorter ones."""
        at = _place(self.pairs, _longer(context, word))
        rest = self.left[_place(self.hot, context)] * lower
        return np.where(at >= 0, self.chance[at] if len(self.chance) else 0.0, rest)


class Trie:
    """Levels 0 to 2: contexts of one to three words, their children and the words that follow them."""

    def __init__(self, contexts: list[EliasFano], words: list[EliasFano], counts: EliasFano, chance: list[Codes], left: list[Codes]) -> None:
        self.contexts, self.words, self.counts, self.chance, self.left = contexts, words, counts, chance, left

    @classmethod
    def build(cls, first: np.ndarray, first_counts: np.ndarray, longer: list[np.ndarray], words: list[np.ndarray], chance: list[np.ndarray], left: list[np.ndarray]) -> Trie:
        """first: last words of contexts, ascending, with their counts; longer: parent << 32 | word of the contexts of two and three
        words, ascending.

        words: context << 32 | word for each level, ascending, with their log10 probabilities; left: log10 of what a context leaves to
        the shorter one.
        """
        sizes = [len(first), *map(len, longer)]
        below = lambda keys, n: EliasFano.of(keys, max(n, 1) << 32, 32)
        contexts = [EliasFano.of(first, 1 << 64), *(below(k, n) for k, n in zip(longer, sizes))]
        counts = EliasFano.of(np.r_[0, np.cumsum(first_counts)], int(first_counts.sum()) + 1)
        return cls(contexts, [below(k, n) for k, n in zip(words, sizes)], counts, [Codes.of(c) for c in chance], [Codes.of(x) for x in left])

    def mapped(self) -> mmap.mmap:
        """The trie in one memory-mapped buffer."""
        parts = [p for x in (*self.contexts, *self.words, self.counts, *self.chance, *self.left) for p in x.parts()]
        head = struct.pack("<q", len(parts)) + b"".join(struct.pack("<4sq", p.dtype.str.encode().ljust(4), len(p)) for p in parts)
        size = len(head) + sum(p.nbytes + 8 for p in parts)
        out = mmap.mmap(-1, size)
        out.write(head)
        for p in parts:
            out.write(b"\0" * (-out.tell() % 8))
            out.write(p.tobytes())
        return out

    @classmethod
    def read(cls, raw: mmap.mmap | bytes) -> Trie:
        """The trie in a buffer, not copied."""
        (n,) = struct.unpack_from("<q", raw)
        at, parts = 8 + 12 * n, []
        for k in range(n):
            kind, size = struct.unpack_from("<4sq", raw, 8 + 12 * k)
            dtype = np.dtype(kind.decode().strip())
            at += -at % 8
            parts.append(np.frombuffer(raw, dtype=dtype, count=size, offset=at))
            at += size * dtype.itemsize
        sequences = [EliasFano.read(parts[3 * k : 3 * k + 3]) for k in range(7)]
        codes = [Codes.read(parts[21 + 2 * k : 23 + 2 * k]) for k in range(6)]
        return cls(sequences[:3], sequences[3:6], sequences[6], codes[:3], codes[3:])

    def count(self, root: np.ndarray) -> np.ndarray:
        """Training tokens of contexts of one word, 0 for those that were not seen."""
        out = np.zeros(len(root), dtype=np.int64)
        some = np.flatnonzero(root >= 0)
        out[some] = (self.counts.access(root[some] + 1) - self.counts.access(root[some])).astype(np.int64)
        return out

    def roots(self, word: np.ndarray) -> np.ndarray:
        """Indices of contexts of one word, -1 for those that were not seen."""
        return self.contexts[0].find(word)

    @staticmethod
    def _below(level: EliasFano, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.full(len(parent), -1, dtype=np.int64)
        some = np.flatnonzero(parent >= 0)
        out[some] = level.find((parent[some].astype(U64) << _HALF) | word[some].astype(U64))
        return out

    def child(self, level: int, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Indices of the contexts of this level that put a word in front of the parent's; -1 where there is none or no parent."""
        return self._below(self.contexts[level], parent, word)

    def follower(self, level: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Indices of words behind contexts of this level; -1 where there is none or no context."""
        return self._below(self.words[level], context, word)


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all texts' tokens, each text's end included, and the number of each text's."""
    words, _, at = word_table(texts)
    return np.insert(words, at[1:], END), np.diff(at) + 1


def _before(token: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token its text's one, two and three words before: a context, its last word first."""
    place = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
    out = []
    for k in (1, 2, 3):
        word = np.full(len(token), START)
        word[k:] = np.where(place[k:] >= k, token[:-k], START)
        out.append(word)
    return tuple(out)


def _source(docs: DataFrame, train: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))


def unigrams(docs: DataFrame, train: Column) -> DataFrame:
    """(token, c): how often the texts for training hold each token, by fingerprint."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                token, c = np.unique(_tokens(part.column(0).to_pylist())[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(c.astype(np.int64))], names=["token", "c"])

    return _source(docs, train).where("train").select("text").mapInArrow(count, "token bigint, c bigint").groupBy("token").agg(F.sum("c").alias("c"))


def _places(context: list[np.ndarray], spread: np.ndarray, shared: Shared) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The key by which each token goes to a shard, and for each level which tokens have dealt contexts there, and these.

    spread: numbers by which the tokens of dealt contexts of three words are told apart.
    """
    place, found = _first_context(context[0]), []
    live = np.flatnonzero(_place(shared.hot, place) >= 0)
    for level in range(3):
        found.append((live, place[live]))
        if level < 2:
            place[live] = _longer(place[live], context[level + 1][live])
            live = live[_place(shared.hot, place[live]) >= 0]
    place[live] = mix(place[live] + mix(spread[live]))
    return place, found


def _spread(ids: pa.Array, size: np.ndarray) -> np.ndarray:
    """A number for each token, from its document and its place there, so that it is the same however documents come."""
    doc_id = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(mix(doc_id), size) + at.astype(U64)


def followers(docs: DataFrame, train: Column, shared: Shared) -> DataFrame:
    """(key, hot, c): how often each word follows each dealt context in training; hot: the context's place."""
    everywhere = docs.sparkSession.sparkContext.broadcast(shared)

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, held = everywhere.value, None
        for batch in batches:
            for part in slices(batch, 0):
                token, size = _tokens(part.column(0).to_pylist())
                word = (token >> _HALF).astype(np.uint32)
                _, dealt = _places([(x >> _HALF).astype(np.uint32) for x in _before(token, size)], np.zeros(len(token), dtype=U64), shared)
                found = [held] if held else []
                for live, key in dealt:
                    found.append((_longer(key, word[live]), _place(shared.hot, key).astype(np.int32), np.ones(len(live), dtype=np.int64)))
                key, hot, c = (np.concatenate(x) for x in zip(*found))
                at, of = _distinct(key)
                held = key[at], hot[at], np.bincount(of, weights=c, minlength=len(at)).astype(np.int64)
                if len(at) > HELD:
                    yield rows(held)
                    held = None
        if held:
            yield rows(held)

    def rows(held: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held[0].view(np.int64)), pa.array(held[1]), pa.array(held[2])], names=["key", "hot", "c"])

    counted = _source(docs, train).where("train").select("text").mapInArrow(count, "key bigint, hot int, c bigint")
    return counted.groupBy("key", "hot").agg(F.sum("c").alias("c"))


def _rare_words(counts: DataFrame, known: int) -> DataFrame:
    """(key, hot, c): the training tokens of words that are not known everywhere; hot is -1."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = _word_key(batch.column(0).to_numpy().astype(np.uint32))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(len(key), -1, dtype=np.int32)), batch.column(1)], names=["key", "hot", "c"])

    half = F.shiftrightunsigned("token", 32)
    return counts.where(F.col("c") < known).groupBy(half.alias("half")).agg(F.min_by("c", "token").alias("c")).mapInArrow(keyed, "key bigint, hot int, c bigint")


def _dealt_contexts(docs: DataFrame, train: Column, shared: Shared, least: int, pair_least: int, starts: int, whole: bool) -> tuple[Shared, DataFrame | None]:
    """shared with the contexts of least or more training tokens, and of those the followers of pair_least or more.

    Only contexts all of whose words are that frequent, and only followers that are, can be, so few keys are counted.
    whole: what contexts leave to shorter ones follows from all their followers, which are the table, see followers().
    """
    many = np.concatenate([shared.words[(shared.counts >= least) & (shared.words != END)], np.array([START] if starts >= least else [], dtype=U64)])
    if not len(many):
        return shared, None
    often = np.sort((many >> _HALF).astype(np.uint32))
    behind_any = np.unique((shared.words[shared.counts >= pair_least] >> _HALF).astype(np.uint32))

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # what a task has counted, a row for each key; those of followers are inverted, as a word may stand on either side
        for batch in batches:
            for part in slices(batch, 0):
                token, size = _tokens(part.column(0).to_pylist())
                word = (token >> _HALF).astype(np.uint32)
                context = [(x >> _HALF).astype(np.uint32) for x in _before(token, size)]
                live = np.flatnonzero(_place(often, context[0]) >= 0)
                key, parent = _first_context(context[0][live]), np.zeros(len(live), dtype=U64)
                found = [held] if held else []
                for level in range(3):
                    if level:
                        keep = _place(often, context[level][live]) >= 0
                        live, parent = live[keep], key[keep]
                        key = _longer(parent, context[level][live])
                        found.append((np.full(len(key), level, dtype=np.int8), key, key, parent, np.full(len(key), -1, dtype=np.int64), np.ones(len(key), dtype=np.int64)))
                    some = np.flatnonzero(_place(behind_any, word[live]) >= 0)
                    follower = word[live[some]]
                    found.append((np.full(len(some), level, dtype=np.int8), ~_longer(key[some], follower), key[some], parent[some], follower.astype(np.int64), np.ones(len(some), dtype=np.int64)))
                columns = [np.concatenate(x) for x in zip(*found)]
                at, of = _distinct(columns[1])
                held = (*[x[at] for x in columns[:5]], np.bincount(of, weights=columns[5], minlength=len(at)).astype(np.int64))
                if len(at) > HELD:
                    yield rows(held)
                    held = None
        if held:
            yield rows(held)

    def rows(held: tuple) -> pa.RecordBatch:
        level, _, context, parent, word, c = held
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (level, context.view(np.int64), parent.view(np.int64), word, c)], names=["level", "context", "parent", "word", "c"])

    counted = _source(docs, train).where("train").select("text").mapInArrow(count, "level tinyint, context bigint, parent bigint, word bigint, c bigint")
    counted = counted.groupBy("level", "context", "parent", "word").agg(F.sum("c").alias("c")).where(F.col("c") >= F.when(F.col("word") < 0, least).otherwise(pair_least)).toArrow()
    level, context, parent, word, c = (counted.column(k).to_numpy() for k in range(5))
    context, parent = context.view(U64), parent.view(U64)
    at = _place(shared.words, many)
    keys, sizes = _first_context((many >> _HALF).astype(np.uint32)), np.where(at >= 0, shared.counts[at], starts)
    dealt, parents, behind = [], {}, None
    for k in range(3):
        if k:
            some = (level == k) & (word < 0)
            keys, sizes = context[some], c[some]
            parents |= dict(zip(keys.tolist(), parent[some].tolist()))
        order = np.argsort(keys)
        dealt.append((keys[order], sizes[order]))
    if whole:
        hot = np.sort(np.concatenate([keys for keys, _ in dealt]))
        behind = table(followers(docs, train, replace(shared, hot=hot)), "followers")
        kinds = np.zeros(len(hot), dtype=np.int64)
        found = behind.groupBy("hot").agg(F.count("*").alias("n")).toArrow()
        kinds[found.column("hot").to_numpy()] = found.column("n").to_numpy()
    for k, (keys, sizes) in enumerate(dealt):  # from short to long, as chances build on the shorter ones
        some = np.flatnonzero((level == k) & (word >= 0))
        of = _place(keys, context[some])
        some, of = some[of >= 0], of[of >= 0]
        follower, pair = word[some].astype(np.uint32), _longer(context[some], word[some])
        certain = (c[some] - DISCOUNTS[k]) / sizes[of]
        left = DISCOUNTS[k] * kinds[_place(hot, keys)] / sizes if whole else 1 - np.bincount(of, weights=certain, minlength=len(keys))
        if not ((left > 0) & (left <= 1)).all():
            raise ArithmeticError("a context's followers are more than its tokens")
        lower, _ = shared.p1(follower)
        if k == 2:
            lower = shared.chances(np.array([parents[x] for x in parent[some].tolist()], dtype=U64), follower, lower)
        if k:
            lower = shared.chances(parent[some], follower, lower)
        chance = certain + left[of] * lower
        shared.hot, by = np.unique(np.r_[shared.hot, keys], return_index=True)
        shared.left, shared.sizes = np.r_[shared.left, left][by], np.r_[shared.sizes, sizes][by]
        shared.pairs, by = np.unique(np.r_[shared.pairs, pair], return_index=True)
        shared.chance = np.r_[shared.chance, chance][by]
    return shared, behind


def _planes(values: np.ndarray) -> bytes:
    """The bytes of integers, all first ones first."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unplaned(raw: bytes, at: int, n: int, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(dtype).ravel()


_ZSTD = pa.Codec("zstd", compression_level=1)


def _compress(raw: bytes) -> bytes:
    return struct.pack("<q", len(raw)) + _ZSTD.compress(raw, asbytes=True)


def _decompress(raw: bytes) -> bytes:
    return _ZSTD.decompress(raw[8:], struct.unpack_from("<q", raw)[0], asbytes=True)


def _pack(row: int, train: np.ndarray, doc: np.ndarray, last: np.ndarray, last_code: np.ndarray, words: list[np.ndarray], codes: list[np.ndarray]) -> bytes:
    """Tokens of a batch for a shard, by their context's last word: that word once with its number of tokens, and for each
    token its document and three words. Words are codes, and their bits where they have none."""
    first = np.flatnonzero(np.r_[True, last[1:] != last[:-1]])
    sizes = np.diff(np.r_[first, len(last)]).astype(np.uint32)
    step = np.diff(doc, prepend=doc.dtype.type(0)).astype(np.uint16)
    own = last[first][last_code[first] == ESCAPE]
    rare = [(w[c == ESCAPE] >> _HALF).astype(np.uint32) for w, c in zip(words, codes)]
    parts = [
        struct.pack("<q7I", row, len(train), len(first), len(last), len(own), *map(len, rare)), np.packbits(train).tobytes(), _planes(last_code[first]), own.tobytes(), _planes(sizes), _planes(step),
        *(_planes(c) for c in codes), *(r.tobytes() for r in rare),
    ]
    return _compress(b"".join(parts))


def _unpack(blob: bytes, by_rank: np.ndarray) -> tuple:
    """(batch, train, last words, sizes, document, three words' 32 bits)."""
    raw = _decompress(blob)
    row, docs, firsts, n, own, *rare = struct.unpack_from("<q7I", raw)
    at = 36
    train = np.unpackbits(np.frombuffer(raw, np.uint8, -(-docs // 8), at))[:docs].astype(bool)
    at += -(-docs // 8)
    code = _unplaned(raw, at, firsts, np.uint16)
    escaped = code == ESCAPE
    last = by_rank[np.where(escaped, 0, code)]
    last[escaped] = np.frombuffer(raw, U64, own, at + 2 * firsts)
    at += 2 * firsts + 8 * own
    sizes = _unplaned(raw, at, firsts, np.uint32)
    at += 4 * firsts
    doc = np.cumsum(_unplaned(raw, at, n, np.uint16), dtype=np.uint16)
    codes = [_unplaned(raw, at + 2 * n * (k + 1), n, np.uint16) for k in range(3)]
    at += 8 * n
    words = []
    for code, many in zip(codes, rare):
        escaped = code == ESCAPE
        word = (by_rank[np.where(escaped, 0, code)] >> _HALF).astype(np.uint32)
        word[escaped] = np.frombuffer(raw, np.uint32, many, at)
        at += 4 * many
        words.append(word)
    return row, train, last, sizes, doc, words


def _deal(token: np.ndarray, size: np.ndarray, code: np.ndarray, train: np.ndarray, spread: np.ndarray, row: int, shared: Shared) -> Iterator[tuple[int, bytes]]:
    """The tokens of a batch, with their codes, for each shard that gets any."""
    words = [*_before(token, size)]
    context = [(x >> _HALF).astype(np.uint32) for x in words]
    shard = shared.shard(_places(context, spread, shared)[0])
    bits = U64(shared.shards.bit_length())
    order = _together((shard.astype(U64) << (U64(64) - bits)) | (words[0] >> bits))
    start = shared.codes(np.array([START]))[0]
    place_in = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
    codes = [code]
    for k in (1, 2, 3):
        one = np.full(len(code), start, dtype=np.uint16)
        one[k:] = np.where(place_in[k:] >= k, code[:-k], start)
        codes.append(one)
    doc = np.repeat(np.arange(len(size), dtype=np.uint16), size)[order]
    last, last_code, shard = words[0][order], codes.pop(1)[order], shard[order]
    words, codes = [x[order] for x in (token, words[1], words[2])], [x[order] for x in codes]
    cuts = np.searchsorted(shard, np.arange(shared.shards + 1))
    for s in np.flatnonzero(np.diff(cuts)).tolist():
        some = slice(cuts[s], cuts[s + 1])
        yield s, _pack(row, train, doc[some], last[some], last_code[some], [x[some] for x in words], [x[some] for x in codes])


def _known_sums(token: np.ndarray, size: np.ndarray, code: np.ndarray, shared: Shared) -> list[np.ndarray]:
    """Of each text the number of tokens, of those that are known everywhere, and the latter's sum of log10(c + 1)."""
    doc = np.repeat(np.arange(len(size)), size)
    coded = code != ESCAPE
    c = shared.rank_counts[np.where(coded, code, 0)]
    c[~coded] = shared.count(token[~coded])
    some = c >= 0
    n = len(size)
    return [size.astype(np.uint32), np.bincount(doc[some], minlength=n).astype(np.uint32), np.bincount(doc[some], weights=np.log10(c[some] + 1.0), minlength=n)]


def _log10(x: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(x, 1e-300))


def _told(shared: Shared, key: np.ndarray, c: np.ndarray, word: np.ndarray, dealt: list[np.ndarray]) -> list[np.ndarray]:
    """Chances of a shard's tokens: of their words, and for each level behind their context there, where that is dealt out.

    key, c: what the shard was answered; word, dealt: its tokens, and the places of their contexts of each level, -1 for others.
    """
    key, at = np.unique(key, return_index=True)
    c = np.r_[c[at], 0]  # the last for keys that training does not hold
    at, of = _distinct(_word_key(word))
    words = word[at]
    chance, known = shared.p1(words)
    chance[~known] = (c[_place(key, _word_key(words[~known]))] + 1) / shared.total
    out = [chance[of]]
    for k, hot in enumerate(dealt):
        chance = out[-1].copy()
        some = np.flatnonzero(hot >= 0)
        context = hot[some]
        pair = _longer(shared.hot[context], word[some])
        one, at = _distinct(pair)
        pair = pair[one]
        known, n = _place(shared.pairs, pair), c[_place(key, pair)][at]
        told = np.where(known >= 0, np.r_[shared.chance, 0.0][known], -1.0)[at]
        p = np.where(n > 0, (n - DISCOUNTS[k]) / shared.sizes[context], 0.0) + shared.left[context] * chance[some]
        chance[some] = np.where(told >= 0, told, p)
        out.append(chance)
    return out


def _score_shard(blobs: list[bytes], shared: Shared, kept: bytes | None = None, build_only: bool = False, told: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[list[int], list[bytes]] | bytes:
    """Builds the shard's trie from its training tokens, unless it was kept, and sums up what it knows of each document.

    told: keys and counts that the shard asked for, in the whole model. For each blob its batch's number and, of the batch's documents with tokens here, the sums; or the trie itself.
    """
    parts = [_unpack(b, shared.by_rank) for b in blobs]
    batches = [p[0] for p in parts]
    base = np.cumsum([0] + [len(p[1]) for p in parts])
    last, first_of = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
    key = np.repeat(first_of.astype(U64), np.concatenate([p[3] for p in parts])) << _HALF
    key |= np.concatenate([p[5][1] for p in parts])
    more = np.concatenate([p[5][2] for p in parts]).astype(U64) << _HALF
    more |= np.concatenate([p[5][0] for p in parts])
    doc = np.concatenate([p[4] + np.int32(b) for p, b in zip(parts, base)])
    learn = np.concatenate([p[1] for p in parts])[doc]
    del parts, first_of
    order = np.lexsort((more, key)).astype(np.int32)  # by context, its last word first, and word
    key, more = key[order], more[order]
    doc, learn = doc[order], learn[order]
    del order
    step = np.diff(key, prepend=~key[:1]) != 0
    starts = [np.flatnonzero(step).astype(np.int32)]
    number = np.cumsum(step, dtype=np.int32) - np.int32(1)
    step |= np.diff(more >> _HALF, prepend=~(more[:1] >> _HALF)) != 0
    starts.append(np.flatnonzero(step).astype(np.int32))
    two_of = number[starts[1]]
    number = np.cumsum(step, dtype=np.int32) - np.int32(1)
    step |= np.diff(more, prepend=~more[:1]) != 0
    starts.append(np.flatnonzero(step).astype(np.int32))
    three_of = number[starts[2]]
    token_of = np.cumsum(step, dtype=np.int32) - np.int32(1)
    # all contexts here, of training or not: the shorter one and the word in front of it
    one_of = (key[starts[0]] >> _HALF).astype(np.int32)
    front2, front3 = key[starts[0]].astype(np.uint32), (more[starts[1]] >> _HALF).astype(np.uint32)
    word = more[starts[2]].astype(np.uint32)
    del number, step, key, more
    learn = learn.astype(np.int32)
    seen = [np.add.reduceat(learn, at) for at in starts]
    seen.insert(0, np.bincount(one_of, weights=seen[0], minlength=len(last)).astype(np.int64))
    del learn, starts
    half = (last >> _HALF).astype(np.uint32)
    dealt = _dealt(shared, half, [one_of, two_of], [front2, front3])
    chances = None if told is None else _told(shared, *told, word, [dealt[0][one_of[two_of[three_of]]], dealt[1][two_of[three_of]], dealt[2][three_of]])

    raw = _built(shared, last, [one_of, two_of, three_of], [front2, front3], word, seen, dealt, chances).mapped() if kept is None else kept
    if build_only:
        return raw[:]
    del seen
    trie = Trie.read(raw)
    at = [trie.roots(last)]
    at.append(trie.child(1, at[0][one_of], front2))
    at.append(trie.child(2, at[1][two_of], front3))
    score = np.zeros(len(word))
    open_, context = np.arange(len(word)), three_of
    for level, parent in ((2, two_of), (1, one_of), (0, None)):
        hot = dealt[level][context]
        node = np.where(hot >= 0, -1, at[level][context])
        found = trie.follower(level, node, word[open_])
        hit = found >= 0
        score[open_[hit]] += trie.chance[level](found[hit])
        away = ~hit & (node >= 0)
        score[open_[away]] += trie.left[level](node[away])
        some = np.flatnonzero(hot >= 0)
        if chances is not None:
            score[open_[some]] += _log10(chances[level + 1][open_[some]])
            hit[some] = True
        elif len(some):
            pair = _place(shared.pairs, _longer(shared.hot[hot[some]], word[open_[some]]))
            there = pair >= 0
            score[open_[some[there]]] += _log10(shared.chance[pair[there]])
            score[open_[some[~there]]] += _log10(shared.left[hot[some[~there]]])
            hit[some[there]] = True
        open_, context = open_[~hit], context[~hit]
        context = parent[context] if parent is not None else context
    p1, known = shared.p1(word[open_]) if chances is None else (chances[0][open_], np.ones(len(open_), dtype=bool))
    score[open_[known]] += _log10(p1[known])

    # words that are not known everywhere, if they were not asked for: their own probability, where the token before this one, which they were, was not found
    count = trie.count(at[0])
    rare_word = (shared.count(last) < 0) & (last != START)
    rare = np.flatnonzero((rare_word & ~shared.p1(half)[1])[one_of][two_of]) if told is None else np.empty(0, dtype=np.int64)
    matched = at[1][two_of[rare]] >= 0
    if len(shared.hot):
        before = _first_context(front2[two_of[rare]])
        first = _place(shared.hot, before) >= 0
        second = _place(shared.hot, _longer(before, front3[rare])) >= 0
        matched = np.where(first, ~second & (at[2][rare] >= 0), matched)
    late = np.zeros(len(two_of))
    late[rare] = np.where(matched, 0.0, np.log10((count + 1) / shared.total)[one_of[two_of[rare]]])
    score += late[three_of]

    n = int(base[-1])
    total = np.rint(np.bincount(doc, weights=score[token_of], minlength=n) * UNITS).astype(np.int32)
    here = np.bincount(doc, minlength=n) > 0
    told = np.flatnonzero((rare_word & (count > 0))[one_of[two_of[three_of]]][token_of])
    told = told[np.argsort(doc[told], kind="stable")]
    told_doc, told_count = doc[told], count[one_of[two_of[three_of[token_of[told]]]]].astype(np.uint32)
    cuts = np.searchsorted(told_doc, base)
    out = []
    for k, (lo, hi) in enumerate(zip(base[:-1].tolist(), base[1:].tolist())):
        some = np.flatnonzero(here[lo:hi])
        own = slice(cuts[k], cuts[k + 1])
        step = lambda x: _planes(np.diff(x, prepend=0).astype(np.uint16))
        out.append(_compress(struct.pack("<2I", len(some), cuts[k + 1] - cuts[k]) + step(some) + _planes(total[lo:hi][some]) + step(told_doc[own].astype(np.int64) - lo) + _planes(told_count[own])))
    return batches, out


def _dealt(shared: Shared, half: np.ndarray, parents: list[np.ndarray], fronts: list[np.ndarray]) -> list[np.ndarray]:
    """For the contexts of each level their place among the dealt ones, -1 for others."""
    out = [_place(shared.hot, _first_context(half)).astype(np.int32)]
    for parent, front in zip(parents, fronts):
        one = np.full(len(front), -1, dtype=np.int32)
        some = np.flatnonzero(out[-1][parent] >= 0)
        if len(some):
            one[some] = _place(shared.hot, _longer(shared.hot[out[-1][parent[some]]], front[some]))
        out.append(one)
    return out


def _built(shared: Shared, last: np.ndarray, parents: list[np.ndarray], fronts: list[np.ndarray], word: np.ndarray, seen: list[np.ndarray], dealt: list[np.ndarray], chances: list[np.ndarray] | None) -> Trie:
    """The trie of a shard's contexts and words; only what training holds goes into it. chances: of all its tokens, see _told()."""
    low = U64(0xFFFFFFFF)
    keep = [s > 0 for s in seen[:3]]
    number = [np.cumsum(k, dtype=np.int32) - np.int32(1) for k in keep]
    longer = [(number[k][parents[k][keep[k + 1]]].astype(U64) << _HALF) | fronts[k][keep[k + 1]] for k in (0, 1)]
    hot = [d[k] for d, k in zip(dealt, keep)]
    size = [s[k] for s, k in zip(seen, keep)]
    some = seen[3] > 0
    # (context, word) of each level, ascending, with counts; to: the place of each longer one's shorter
    words, counts, to = [(number[2][parents[2][some]].astype(U64) << _HALF) | word[some]], [seen[3][some]], []
    own = [np.flatnonzero(some)]  # a token of each
    for k in (1, 0):
        pair = (longer[k] >> _HALF)[(words[0] >> _HALF).astype(np.int32)] << _HALF
        pair |= words[0] & low
        order = np.argsort(pair, kind="stable").astype(np.int32)
        pair = pair[order]
        new = np.diff(pair, prepend=~pair[:1]) != 0
        at = np.empty(len(pair), dtype=np.int32)
        at[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
        to.insert(0, at)
        counts.insert(0, np.add.reduceat(counts[0][order], np.flatnonzero(new)) if len(pair) else counts[0])
        words.insert(0, pair[new])
        own.insert(0, own[0][order[new]])
        del order, pair, new
    logs, lefts, held = [], [], []
    lower, known = shared.p1((words[0] & low).astype(np.uint32)) if chances is None else (chances[0][own[0]], np.ones(len(own[0]), dtype=bool))
    for k in range(3):
        context = (words[k] >> _HALF).astype(np.int32)
        if k:
            lower, known = chance[to[k - 1]], known[to[k - 1]]
        left = DISCOUNTS[k] * np.bincount(context, minlength=len(size[k])) / np.maximum(size[k], 1)
        chance = (counts[k] - DISCOUNTS[k]) / np.maximum(size[k][context], 1) + left[context] * lower
        of_hot = np.flatnonzero(hot[k][context] >= 0)
        if chances is not None:
            chance[of_hot] = chances[k + 1][own[k][of_hot]]
        elif len(of_hot):
            chance[of_hot] = shared.chances(shared.hot[hot[k][context[of_hot]]], (words[k][of_hot] & low).astype(np.uint32), lower[of_hot])
        lefts.append(_log10(np.where(hot[k] >= 0, 1.0, left)))
        stays = hot[k][context] < 0
        if k == 2 and len(longer[1]):  # a rare word that the dealt context of two words leaves out
            stays &= ~((hot[1][(longer[1] >> _HALF).astype(np.int32)] >= 0)[context] & ~known)
        logs.append(_log10(chance[stays]))
        held.append(words[k][stays])
    return Trie.build(last[keep[0]], size[0], longer, held, logs, lefts)


def _ids(row: int, ids: pa.Array, train: np.ndarray, sums: list[np.ndarray]) -> bytes:
    """A batch's documents: ids, and what is known of them where they are."""
    doc_id = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = [struct.pack("<qq", row, len(ids)), *(_planes(x) for x in (doc_id, *sums)), np.asarray(ids.is_valid()).astype(np.uint8).tobytes(), train.astype(np.uint8).tobytes()]
    return _compress(b"".join(parts))


def _merge(ids: bytes, blobs: list[bytes]) -> pa.Table:
    """The documents of a batch with the sums of all shards."""
    raw = _decompress(ids)
    _, n = struct.unpack_from("<qq", raw)
    at, columns = 16, []
    for dtype in (np.int64, np.uint32, np.uint32, np.float64, np.uint8, np.uint8):
        columns.append(_unplaned(raw, at, n, dtype))
        at += n * np.dtype(dtype).itemsize
    doc_id, n_tokens, n_known, base, there, train = columns
    n_known, base, score = n_known.astype(np.int64), base.copy(), np.zeros(n, dtype=np.int64)
    for blob in blobs:
        raw = _decompress(blob)
        some, rare = struct.unpack_from("<2I", raw)
        place = np.cumsum(_unplaned(raw, 8, some, np.uint16), dtype=np.uint16)
        score[place] += _unplaned(raw, 8 + 2 * some, some, np.int32)
        doc = np.cumsum(_unplaned(raw, 8 + 6 * some, rare, np.uint16), dtype=np.uint16)
        count = _unplaned(raw, 8 + 6 * some + 2 * rare, rare, np.uint32)
        n_known += np.bincount(doc, minlength=n)
        base += np.bincount(doc, weights=np.log10(count + 1.0), minlength=n)
    return pa.table({
        "doc_id": pa.array(doc_id, mask=there == 0), "train": pa.array(train.astype(bool)), "n_tokens": pa.array(n_tokens.astype(np.int64)),
        "n_known": pa.array(n_known), "base": pa.array(base), "score": pa.array(score / UNITS),
    })


@dataclass
class Model:
    """A language model that remains: the tries of its shards, in a table, and what all shards know."""

    tries: DataFrame
    shared: Shared
    tokens: int
    asked: DataFrame | None = None


def _learnt(docs: DataFrame, train: Column, whole: bool = False) -> tuple[Shared, int, DataFrame | None]:
    """What all shards know of the texts for training, the number of their tokens, and in the whole model the table (key, hot, c)
    of all else that shards may ask for, if there is anything."""
    counts = table(unigrams(docs, train), "unigrams")
    v, n = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    known = max(n // KNOWN, 1)
    rows = counts.where((F.col("c") >= known) | (F.col("token") == int(END.view(np.int64)))).toArrow()
    token, c = rows.column("token").to_numpy().view(U64), rows.column("c").to_numpy()
    ends = int(c[token == END].sum())
    least = max(SHARD_TOKENS, known)
    shared, asked = _dealt_contexts(docs, train, Shared.of(token, c, float(n + v + 1)), least, max(n // PAIRS, known, 2), ends, whole)
    if whole and known > 1:
        rare = table(_rare_words(counts, known), "rare_words")
        asked = rare if asked is None else asked.unionByName(rare)
    release(counts)
    shared.spread(max(-(-n // SHARD_TOKENS), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return shared, int(n), asked


def _answers(docs: DataFrame, everywhere, asked: DataFrame) -> DataFrame:
    """(shard, key, c): of the counts in asked those that shards need for the tokens of docs that go there."""

    @lean
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, held = everywhere.value, []
        for batch in batches:
            for part in slices(batch, 1):
                token, size = _tokens(part.column(1).to_pylist())
                word = (token >> _HALF).astype(np.uint32)
                place, dealt = _places([(x >> _HALF).astype(np.uint32) for x in _before(token, size)], _spread(part.column(0), size), shared)
                shard = shared.shard(place)
                rare = np.flatnonzero(shared.codes(token) == ESCAPE)
                rare = rare[~shared.p1(word[rare])[1]]
                held.append((_word_key(word[rare]), shard[rare]))
                for live, key in dealt:
                    pair = _longer(key, word[live])
                    some = np.flatnonzero(_place(shared.pairs, pair) < 0)
                    held.append((pair[some], shard[live[some]]))
                if sum(len(key) for key, _ in held) > 2 * HELD:  # looked through when there are many
                    held = [once(held)]
                    if len(held[0][0]) > HELD:
                        yield rows(held[0])
                        held = []
        if held:
            yield rows(once(held))

    def once(held: list[tuple]) -> tuple:
        key, shard = (np.concatenate(x) for x in zip(*held))
        at = _once(_longer(key, shard))
        return key[at], shard[at]

    def rows(held: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held[0].view(np.int64)), pa.array(held[1].astype(np.int32))], names=["key", "shard"])

    wanted = _source(docs, F.lit(False)).mapInArrow(ask, "key bigint, shard int").repartition("key").dropDuplicates(["key", "shard"])
    return wanted.join(asked.select("key", "c").hint("shuffle_hash"), "key").select("shard", "key", "c")


def _by_shard(dealt: DataFrame, docs: DataFrame, everywhere, asked: DataFrame | None, work, schema: str) -> DataFrame:
    """work(shard, rows, told) of each shard's rows, with the counts that it asked for; None where nothing is asked."""
    if asked is None:
        return dealt.groupBy("shard").applyInArrow(lambda key, held: work(key[0].as_py(), held, None), schema)

    def met(key: tuple, held: pa.Table, told: pa.Table) -> pa.Table:
        return work(key[0].as_py(), held, (told.column("key").to_numpy().view(U64), told.column("c").to_numpy()))

    return dealt.groupBy("shard").cogroup(_answers(docs, everywhere, asked).groupBy("shard")).applyInArrow(met, schema)


def _dealt_tokens(docs: DataFrame, train: Column, everywhere) -> DataFrame:
    """(shard, ids, blob): the tokens of docs by shard, and once for each batch what its documents are."""

    @lean
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row, shared = TaskContext.get().partitionId() << 33, everywhere.value
        for batch in batches:
            for part in slices(batch, 1):
                train = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                token, size = _tokens(part.column(1).to_pylist())
                code = shared.codes(token)
                at = int(shared.shard(mix(np.array([row], dtype=U64)))[0])
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([True]), pa.array([_ids(row, part.column(0), train, _known_sums(token, size, code, shared))], pa.binary())], names=["shard", "ids", "blob"])
                for s, blob in _deal(token, size, code, train, _spread(part.column(0), size), row, shared):
                    yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([False]), pa.array([blob], pa.binary())], names=["shard", "ids", "blob"])
                row += part.num_rows

    return _source(docs, train).mapInArrow(deal, "shard int, ids boolean, blob binary")


def _shard_rows(held: pa.Table, shared: Shared, told: tuple | None = None, kept: bytes | None = None) -> pa.Table:
    """What a shard returns of its batches, and their documents as they came."""
    ids = held.filter(held.column("ids")).column("blob").to_pylist()
    blobs = held.filter(pa.compute.invert(held.column("ids"))).column("blob").to_pylist()
    batches, sums = _score_shard(blobs, shared, kept, told=told) if blobs else ([], [])
    batches = [struct.unpack_from("<q", _decompress(b))[0] for b in ids] + batches
    return pa.table({"batch": pa.array(batches, pa.int64()), "ids": pa.array([True] * len(ids) + [False] * len(sums), pa.bool_()), "sums": pa.array(ids + sums, pa.binary())})


def _summed(partial: DataFrame, shared: Shared, n: int) -> DataFrame:
    """The documents of all batches with the sums of all shards."""

    def merged(held: pa.Table) -> pa.Table:
        is_ids = held.column("ids").to_pylist()
        blobs = held.column("sums").to_pylist()
        return _merge(blobs[is_ids.index(True)], [b for b, i in zip(blobs, is_ids) if not i])

    return partial.groupBy("batch").applyInArrow(merged, "doc_id bigint, train boolean, n_tokens bigint, n_known bigint, base double, score double").select(
        "doc_id", F.col("train").alias("trained"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * float(np.log10(shared.total))).alias("base_score"), "score",
    )


_SUMS = "batch bigint, ids boolean, sums binary"


def score(docs: DataFrame, train: Column, whole: bool = False) -> DataFrame:
    """(doc_id, trained, n_tokens, n_known, train_tokens, base_score, score) of each row of docs (doc_id, text).

    train: a condition on the rows of docs whose texts the model learns from. base_score is the sum of the tokens'
    log10 unigram probabilities, score the model's of the text. A null or empty text is its end alone; a null doc_id
    and repeated rows stay; other columns are not looked at. Without training rows N and V are 0 and every token is
    unknown. No rows give none. Tokens move once: a shard builds its trie and asks it in one task; fit() and score_with()
    do the same in two steps, with tries that remain.

    whole: the model leaves out nothing, however many tokens there are; otherwise rare followers of dealt contexts fall to
    the shorter context, and rare words add nothing to a longer context's chance.
    """
    shared, n, asked = _learnt(docs, train, whole)
    everywhere = docs.sparkSession.sparkContext.broadcast(shared)
    dealt = _dealt_tokens(docs, train, everywhere)
    return _summed(_by_shard(dealt, docs, everywhere, asked, lambda _, held, told: _shard_rows(held, everywhere.value, told), _SUMS), shared, n)


def fit(docs: DataFrame, train: Column, whole: bool = False) -> Model:
    """The model of the texts that train holds for, its tries written to the shared folder; whole: see score()."""
    shared, n, asked = _learnt(docs, train, whole)
    everywhere = docs.sparkSession.sparkContext.broadcast(shared)
    trained = docs.where(F.coalesce(train, F.lit(False)))
    learnt = _dealt_tokens(trained, F.lit(True), everywhere).where("not ids")

    def build(shard: int, held: pa.Table, told: tuple | None) -> pa.Table:
        blobs = held.column("blob").to_pylist()
        tries = [_score_shard(blobs, everywhere.value, build_only=True, told=told)] if blobs else []
        return pa.table({"shard": pa.array([shard] * len(tries), pa.int32()), "trie": pa.array(tries, pa.binary())})

    return Model(table(_by_shard(learnt, trained, everywhere, asked, build, "shard int, trie binary"), "tries"), shared, n, asked)


def score_with(model: Model, docs: DataFrame) -> DataFrame:
    """As score(), of any docs with a model that was fitted before; trained is false."""
    everywhere = docs.sparkSession.sparkContext.broadcast(model.shared)
    dealt = _dealt_tokens(docs, F.lit(False), everywhere)

    def ask(held: pa.Table, tries: pa.Table) -> pa.Table:
        kept = tries.column("trie").drop_null()
        told = None if not whole else (tries.column("key").drop_null().to_numpy().view(U64), tries.column("c").drop_null().to_numpy())
        return _shard_rows(held, everywhere.value, told, kept[0].as_buffer().to_pybytes() if len(kept) else None)

    tries, whole = model.tries, model.asked is not None
    if whole:
        tries = tries.unionByName(_answers(docs, everywhere, model.asked), allowMissingColumns=True)
    partial = dealt.groupBy("shard").cogroup(tries.groupBy("shard")).applyInArrow(ask, _SUMS)
    return _summed(partial, model.shared, model.tokens)
