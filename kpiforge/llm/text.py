"""Vectorised text kernels shared by the operators of this subpackage.

Words are runs of bytes other than space and U+0009-U+000D, after A-Z are
lower-cased. A word is represented by a 64-bit fingerprint: the polynomial
hash of its UTF-8 bytes modulo 2**64, mixed afterwards. Texts are worked on in
chunks of bounded size, so memory does not follow the length of a text.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np

U64 = np.uint64
CHUNK_BYTES = 1 << 20
_MULT = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def lean(work: Callable) -> Callable:
    """A worker's function that gives freed memory back to the system when it is through with a task.

    Workers live on between tasks, and several wait beside those that work.
    """

    def give_back() -> None:
        import pyarrow as pa

        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    @functools.wraps(work)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word (splitmix64's)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class _Powers:
    """Powers of the multiplier and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=U64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            inverse = pow(_MULT, -1, 1 << 64)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.r_[U64(1), np.full(n - 1, _MULT, dtype=U64)])
                self.down = np.cumprod(np.r_[U64(1), np.full(n - 1, inverse, dtype=U64)])
        return self.up, self.down


_powers = _Powers()


def span_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of units[start:end] for every span; the spans must not be empty."""
    n = len(units)
    if not len(starts):
        return np.empty(0, dtype=U64)
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum((units.astype(U64) + U64(1)) * up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def _word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = np.zeros(len(raw) + 2, dtype=np.int8)
    solid[1:-1] = ~_SPACE[raw]
    step = np.diff(solid)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _pieces(texts: list[bytes]) -> Iterator[tuple[bytes, list[int], list[int]]]:
    """Joined chunks of about CHUNK_BYTES: bytes, index of each text in it and where each starts.

    A longer text is cut before a word, so no word is divided unless it is longer than a chunk itself.
    """
    held: list[bytes] = []
    index: list[int] = []
    at: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        pos = 0
        while pos < len(text) or pos == 0:
            end = min(len(text), pos + CHUNK_BYTES)
            if end < len(text):
                cut = max(text.rfind(b" ", pos + 1, end), text.rfind(b"\n", pos + 1, end))
                while cut < 0 and end < len(text):  # a word longer than a chunk stays whole
                    end = min(len(text), end + CHUNK_BYTES)
                    found = [x for x in (text.find(b" ", pos + 1, end), text.find(b"\n", pos + 1, end)) if x > 0]
                    cut = min(found) if found else -1
                end = cut if cut > 0 else len(text)
            index.append(i)
            at.append(size)
            held.append(text[pos:end])
            size += end - pos + 1
            pos = end if end > pos else len(text) + 1
            if size >= CHUNK_BYTES:
                yield b"\n".join(held), index, at
                held, index, at, size = [], [], [], 0
            if not text:
                break
    if held:
        yield b"\n".join(held), index, at


def word_table(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints and lengths in bytes of the words of all texts in order, and the texts' offsets (one more than texts)."""
    raws = [(t or "").encode() for t in texts]
    counts = np.zeros(len(raws), dtype=np.int64)
    out, lengths = [np.empty(0, dtype=U64)], [np.empty(0, dtype=np.int64)]
    for joined, index, at in _pieces(raws):
        units = _LOWER[np.frombuffer(joined, dtype=np.uint8)]
        starts, ends = _word_spans(units)
        out.append(span_hashes(units, starts, ends))
        lengths.append(ends - starts)
        np.add.at(counts, index, np.diff(np.r_[np.searchsorted(starts, at), len(starts)]))
    return np.concatenate(out), np.concatenate(lengths), np.r_[0, np.cumsum(counts)]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the words of all texts in order, and the texts' offsets into them (one more than texts)."""
    out, _, offsets = word_table(texts)
    return out, offsets


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of each text's distinct shingles, ascending, and the texts' offsets into them.

    A text of fewer words than width has its whole sequence as one shingle; one without words has none.
    """
    n = np.diff(offsets)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(words) - width + 1), dtype=U64)
        for k in range(width):
            rolled = rolled * U64(_MULT) + words[k : k + len(rolled)]
        rolled = mix(rolled)
        found, none = [], np.empty(0, dtype=U64)
        for start, size in zip(offsets[:-1].tolist(), n.tolist()):
            if size >= width:
                value = np.sort(rolled[start : start + size - width + 1])
                keep = np.ones(len(value), dtype=bool)
                np.not_equal(value[1:], value[:-1], out=keep[1:])
                found.append(value[keep])
            elif size:
                h = U64(0)
                for w in words[start : start + size]:
                    h = h * U64(_MULT) + w
                found.append(mix(np.array([h + U64(size)], dtype=U64)))
            else:
                found.append(none)
    return (np.concatenate(found) if found else none), np.r_[0, np.cumsum([len(f) for f in found])].astype(np.int64)


def slices(batch, column: int, rows: int = 2048, size: int = 8 << 20):
    """Consecutive parts of a record batch with at most so many rows and, unless a row has more, bytes in a column."""
    import pyarrow.compute as pc

    length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    lo = 0
    total = np.cumsum(length)
    while lo < batch.num_rows:
        done = total[lo - 1] if lo else 0
        hi = max(lo + 1, min(lo + rows, int(np.searchsorted(total, done + size, side="right"))))
        yield batch.slice(lo, hi - lo)
        lo = hi
