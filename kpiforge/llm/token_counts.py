"""Edit-aware token counts: a segment tree of pre-tokens for each document.

A leaf has the characters and the tokens of a pre-token, inner nodes their
sums. An edit re-encodes only the pre-tokens that it touches and those whose
boundary may depend on it: it starts one pre-token before the one that holds
the character before the edit, since a boundary depends on at most the
character behind a run, and it stops at the first old boundary behind the edit
that the new pre-tokens meet, since what follows a boundary never depends on
what is before it. Then the sums above the changed leaves are updated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretokens import CHUNK, CONTRACTIONS, Tokens, boundaries, safe_cuts, tokens
from .text import lean, slices

_NEXT = regex.compile("|".join(CONTRACTIONS) + r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: A leaf that edits have grown beyond so many characters makes its tree be built anew.
LEAF_CHARS = 4096


class SegmentTree:
    """Sums of characters and tokens over leaves; levels[0] are the leaves, each further level half as many nodes."""

    def __init__(self, chars: np.ndarray, counts: np.ndarray) -> None:
        level = np.zeros((max(len(chars) + len(chars) % 2, 2), 2), dtype=np.int64)
        level[: len(chars), 0], level[: len(chars), 1] = chars, counts
        self.levels = [level]
        while len(level) > 1:
            level = level.reshape(-1, 2, 2).sum(1)
            if len(level) > 1 and len(level) % 2:
                level = np.concatenate([level, np.zeros((1, 2), dtype=np.int64)])
            self.levels.append(level)

    @property
    def chars(self) -> int:
        return int(self.levels[-1][0, 0])

    @property
    def count(self) -> int:
        return int(self.levels[-1][0, 1])

    def leaf_at(self, pos: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it starts; pos must be below chars."""
        node, start = 0, 0
        for level in reversed(self.levels[:-1]):
            node *= 2
            left = int(level[node, 0])
            if pos - start >= left:
                start += left
                node += 1
        return node, start

    def count_before(self, leaf: int) -> int:
        """Tokens of the leaves before one."""
        total = 0
        for level in self.levels[:-1]:
            if leaf % 2:
                total += int(level[leaf - 1, 1])
            leaf //= 2
        return total

    def replace(self, first: int, last: int, chars: int, count: int) -> None:
        """Leaves first to last - 1 become one with these sums, the others of them empty."""
        self.levels[0][first:last] = 0
        self.levels[0][first] = chars, count
        lo, hi = first, max(last - 1, first)
        for below, level in zip(self.levels, self.levels[1:]):
            lo, hi = lo // 2, hi // 2
            level[lo : hi + 1] = below[2 * lo : 2 * hi + 2].reshape(-1, 2, 2).sum(1)


class CountedText:
    """A text whose token count follows its edits."""

    def __init__(self, text: str | None, own: Tokens, chars: np.ndarray | None = None, counts: np.ndarray | None = None) -> None:
        self.text, self.own, self.reencoded = text or "", own, 0
        self.known: dict[str, int] = {}
        if chars is None:
            (chars, counts), = leaves([self.text], own)
        self.pretokens = len(chars)
        self.tree = SegmentTree(chars, counts)

    @property
    def count(self) -> int:
        return self.tree.count

    def _size(self, pretoken: str) -> int:
        if pretoken not in self.known:
            self.known[pretoken] = len(self.own.batch([pretoken])[0])
        return self.known[pretoken]

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Puts replacement in place of characters [start, end), both taken to the nearest that exist."""
        old, tree = self.text, self.tree
        start = min(max(start, 0), len(old))
        end = min(max(end, start), len(old))
        if start == end and not replacement:
            return
        self.text = text = old[:start] + replacement + old[end:]
        first = restart = 0
        if old:
            first, restart = tree.leaf_at(min(max(start - 1, 0), len(old) - 1))
            if restart:
                first, restart = tree.leaf_at(restart - 1)
        moved, safe = len(replacement) - (end - start), start + len(replacement)
        pos, count, last = restart, 0, len(tree.levels[0])
        while pos < len(text):
            if pos >= safe:
                leaf, begin = tree.leaf_at(pos - moved)
                if begin == pos - moved:
                    last = leaf
                    break
            match = _NEXT.match(text, pos)
            count += self._size(match.group())
            self.reencoded += 1
            pos = match.end()
        if last == first:  # no old leaf was met, so the new characters go into the one that follows
            chars, more = tree.levels[0][first].tolist()
            tree.replace(first, first + 1, pos - restart + chars, count + more)
        else:
            tree.replace(first, last, pos - restart, count)
        if pos - restart > LEAF_CHARS:
            (chars, counts), = leaves([text], self.own)
            self.tree = SegmentTree(chars, counts)


def leaves(texts: list[str], own: Tokens) -> list[tuple[np.ndarray, np.ndarray]]:
    """Characters and token counts of each text's pre-tokens. Special tokens' strings are ordinary text here."""
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in texts]

    def flush(parts: list[tuple[int, str]]) -> None:
        joined = "\0".join(p for _, p in parts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        breaks = np.cumsum([len(p) + 1 for _, p in parts]) - 1
        starts = boundaries(points, breaks)
        size = own.spans(joined, points, starts)[1]
        chars = np.diff(np.r_[starts, len(points)])
        lo = 0
        for (i, _), hi in zip(parts, np.searchsorted(starts, breaks).tolist()):
            found[i].append((chars[lo:hi], size[lo:hi]))
            lo = hi + 1

    held: list[tuple[int, str]] = []
    size = 0
    for i, text in enumerate(texts):
        for part in safe_cuts(text):
            held.append((i, part))
            size += len(part) + 1
            if size >= CHUNK:
                flush(held)
                held, size = [], 0
    if held:
        flush(held)
    return [f[0] if len(f) == 1 else (np.concatenate([c for c, _ in f]), np.concatenate([n for _, n in f])) for f in found]


def _packed(tree: SegmentTree) -> bytes:
    """A tree's leaves that are not empty: their number, characters, and tokens."""
    leaf = tree.levels[0]
    some = leaf[leaf[:, 0] > 0]
    return np.int64(len(some)).tobytes() + some[:, 0].astype("<u4").tobytes() + some[:, 1].astype("<u4").tobytes()


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    return np.frombuffer(raw, "<u4", n, 8).astype(np.int64), np.frombuffer(raw, "<u4", n, 8 + 4 * n).astype(np.int64)


_SLIM = {"doc_id": pa.int64(), "text": pa.string(), "tree": pa.binary(), "n_tokens": pa.int64(), "n_pretokens": pa.int64()}
_EDITED = ("doc_id", "text", "tree", "n_tokens", "n_pretokens", "n_tokens_before", "n_pretokens_before", "n_reencoded", "chars")


def _planted(tokenizer: str, rest: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What trees() does to batches (doc_id, text, *rest)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(tokenizer)
        for batch in batches:
            for part in slices(batch, 1, rows=256):
                texts = [t or "" for t in part.column(1).to_pylist()]
                made = [SegmentTree(*x) for x in leaves(texts, own)]
                columns = [part.column(0), pa.array(texts, pa.string()), pa.array([_packed(t) for t in made], pa.binary()), pa.array([t.count for t in made], pa.int64()), pa.array([int((t.levels[0][:, 0] > 0).sum()) for t in made], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *(part.column(2 + k) for k in range(len(rest)))], names=[*_SLIM, *rest])

    return make


def _followed(tokenizer: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What edited() does to batches with (doc_id, text, tree, edits)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(tokenizer)
        for batch in batches:
            for part in slices(batch.select(["doc_id", "text", "tree", "edits"]), 1, rows=256):
                rows = []
                for text, tree, edits in zip(*(part.column(k).to_pylist() for k in (1, 2, 3))):
                    one = CountedText(text, own, *_unpacked(tree))
                    before = one.count
                    for e in edits or []:
                        if e:
                            one.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
                    rows.append((one.text, _packed(one.tree), one.count, int((one.tree.levels[0][:, 0] > 0).sum()), before, one.pretokens, one.reencoded, len(one.text)))
                kinds = (pa.string(), pa.binary(), *[pa.int64()] * 6)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))], names=list(_EDITED))

    return make


_EDIT = "array<struct<start:bigint,end:bigint,text:string>>"


def trees(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text, tree, n_tokens, n_pretokens, ...) of each row of docs (doc_id, text, ...), further columns as they are.

    tree: the leaves of the text's segment tree, to be kept with the text; edited() takes both up where edits left them. A
    null text is an empty one. Repeated rows stay; no rows give none. tokenizer: path of a tokenizers file.
    """
    rest = [c for c in docs.columns if c not in _SLIM]
    types = dict(docs.dtypes)
    schema = ", ".join(["doc_id bigint, text string, tree binary, n_tokens bigint, n_pretokens bigint", *(f"`{c}` {types[c]}" for c in rest)])
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(f"`{c}`") for c in rest])
    return source.mapInArrow(lean(_planted(tokenizer, rest)), schema)


def edited(kept: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text, tree, n_tokens, n_pretokens, n_tokens_before, n_pretokens_before, n_reencoded, chars): kept rows after their edits.

    kept: (doc_id, text, tree, edits array<struct<start, end, text>>) with trees of trees() or of an earlier edited(); other
    columns are not looked at. Edits are made in order, each on what the ones before it left; positions are code points,
    taken to the nearest that exist; null positions are 0, null edits are none. Only pre-tokens that edits touch, and those
    beside them, are encoded: n_reencoded of them.
    """
    return kept.select("doc_id", "text", "tree", F.col("edits").cast(_EDIT).alias("edits")).mapInArrow(
        lean(_followed(tokenizer)), "doc_id bigint, text string, tree binary, n_tokens bigint, n_pretokens bigint, n_tokens_before bigint, n_pretokens_before bigint, n_reencoded bigint, chars bigint"
    )


def recount(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, n_tokens_edited, n_pretokens, n_reencoded, edited_chars) of each row of docs.

    docs: (doc_id, text, edits); other columns are not looked at: what edited() says of trees(), in one pass that keeps no
    tree. n_pretokens: before the edits. Repeated rows stay; no rows give none. tokenizer: path of a tokenizers file.
    """

    @lean
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _followed(tokenizer)(_planted(tokenizer, ["edits"])(batches)):
            out = part.select(["doc_id", "n_tokens_before", "n_tokens", "n_pretokens_before", "n_reencoded", "chars"])
            yield pa.RecordBatch.from_arrays(out.columns, names=["doc_id", "n_tokens", "n_tokens_edited", "n_pretokens", "n_reencoded", "edited_chars"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("edits").cast(_EDIT).alias("edits"))
    return source.mapInArrow(make, "doc_id bigint, n_tokens bigint, n_tokens_edited bigint, n_pretokens bigint, n_reencoded bigint, edited_chars bigint")


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """docs (doc_id, text) with the edits of a table (doc_id, seq, start, end, text), in order of seq, as recount() takes them."""
    gathered = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("seq", "start", "end", "text"))).alias("edits"))
    return docs.select("doc_id", "text").join(gathered, "doc_id", "left")
