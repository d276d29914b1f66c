"""Vectorised pre-tokens of byte-level BPE and their token ids.

The boundaries follow the usual pattern of byte-level BPE: contractions, then
runs of letters, numbers or other signs with one space before them, then white
space that leaves its last character to what follows. They are found for many
texts at once on arrays of code points. Each distinct pre-token is given to
the tokenizer once in a worker and then kept by its fingerprint.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np

from .text import U64, span_hashes

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
CHUNK = 1 << 20
_classes: np.ndarray | None = None
#: The contractions, which are pre-tokens of their own.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: White space beyond what Unicode's separator categories hold.
CONTROL_SPACE = (9, 10, 11, 12, 13, 0x85)


def classes() -> np.ndarray:
    """The class of every code point; made once in a process."""
    global _classes
    if _classes is None:
        kind = {"L": LETTER, "N": NUMBER, "Z": SPACE}
        found = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), dtype=np.uint8, count=0x110000)
        found[list(CONTROL_SPACE)] = SPACE
        _classes = found
    return _classes


def boundaries(points: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens in code points; breaks are positions of separators, which are pre-tokens of their own."""
    n = len(points)
    if not n:
        return np.empty(0, dtype=np.int64)
    kind = classes()[points]
    kind[breaks] = 0
    before = np.r_[np.uint8(0), kind[:-1]]
    after = np.r_[kind[1:], np.uint8(0)]
    change = kind != before
    start = change.copy()
    start[breaks] = True
    if len(breaks):
        follow = breaks[breaks + 1 < n] + 1
        start[follow] = True
    # the last white space before something else stands apart from the run before it, ...
    last = (kind == SPACE) & (after != SPACE) & (after != 0)
    start |= last
    # ... and if it is a plain space it belongs to what follows
    glued = last & (points == 32)
    at = np.flatnonzero(glued) + 1
    start[at] = False
    # contractions where an apostrophe starts a pre-token of its own
    tick = np.flatnonzero((points == 39) & start)
    if len(tick):
        padded = np.r_[points, 0, 0]
        real = np.r_[kind, 0, 0]
        done = np.zeros(len(tick), dtype=bool)
        for text in CONTRACTIONS:
            hit = ~done
            for k, c in enumerate(text[1:], 1):
                hit &= (padded[tick + k] == ord(c)) & (real[tick + k] == LETTER)
            done |= hit
            end = tick[hit] + len(text)
            end = end[end < n]
            start[tick[hit] + 1] = False
            # letters that go on, or signs after them, are a new pre-token; a plain space before something starts there anyway
            start[end] = True
    return np.flatnonzero(start)


def safe_cuts(text: str, size: int = CHUNK) -> list[str]:
    """The text in parts of about size characters, cut where a pre-token surely begins: a space between two letters."""
    if len(text) <= size:
        return [text]
    parts, pos = [], 0
    while len(text) - pos > size:
        cut = pos + size
        while cut + 1 < len(text) and not (text[cut] == " " and text[cut - 1].isalpha() and text[cut + 1].isalpha()):
            cut += 1
        if cut + 1 >= len(text):
            break
        parts.append(text[pos:cut])
        pos = cut
    parts.append(text[pos:])
    return parts


def _byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in the vocabulary files of byte-level BPE."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Ranked:
    """Byte-pair merging of single pre-tokens, for vocabularies whose ids follow the order of merges.

    There the lowest id is the first merge, which is what tiktoken goes by; it has the same ids as the tokenizers
    library then, several times faster on short strings.
    """

    def __init__(self, model: dict) -> None:
        import tiktoken

        signs, special = _byte_signs(), {}
        ranks = {bytes(signs[c] for c in token): i for token, i in model["vocab"].items() if all(c in signs for c in token)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"][a + b] for a, b in merges]
        if len(model["vocab"]) - len(ranks) > 16 or any(x >= y for x, y in zip(ids, ids[1:])) or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("ids do not follow the order of merges")
        ranks.pop(b"<|endoftext|>", None)
        self.one = tiktoken.Encoding("own", pat_str=".", mergeable_ranks=ranks, special_tokens=special)._core_bpe.encode_single_piece

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [self.one(t.encode()) for t in texts]


class Tokens:
    """Token ids of pre-tokens, kept by fingerprint; at most limit of them, then it starts afresh."""

    def __init__(self, path: str, limit: int = 2_000_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        #: strings that the tokenizer takes for special tokens, and their ids
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        try:
            self.batch = _Ranked(file["model"])
        except (KeyError, ValueError):
            self.batch = lambda texts: [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self._clear()

    def _clear(self) -> None:
        self.keys = np.empty(0, dtype=U64)
        self.first = np.empty(0, dtype=np.int64)
        self.size = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.uint32)

    def _add(self, keys: np.ndarray, texts: list[str]) -> None:
        """New pre-tokens; a text is what the tokenizer makes one pre-token of."""
        found = self.batch(texts)
        size = np.array([len(x) for x in found], dtype=np.int64)
        first = len(self.ids) + np.r_[0, np.cumsum(size)[:-1]].astype(np.int64)
        self.ids = np.concatenate([self.ids, np.array([i for x in found for i in x], dtype=np.uint32)])
        keys, first, size = np.r_[self.keys, keys], np.r_[self.first, first], np.r_[self.size, size]
        order = np.argsort(keys, kind="stable")
        self.keys, self.first, self.size = keys[order], first[order], size[order]

    def spans(self, joined: str, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each pre-token of joined lie in self.ids: first, size."""
        import pandas as pd

        ends = np.r_[starts[1:], len(points)]
        code, keys = pd.factorize(span_hashes(points, starts, ends))
        if len(self.keys) + len(keys) > self.limit:
            self._clear()
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        new = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            some = np.full(len(keys), -1)
            some[code[::-1]] = np.arange(len(code))[::-1]
            self._add(keys[new], [joined[starts[i] : ends[i]] for i in some[new].tolist()])
            at = np.searchsorted(self.keys, keys)
        return self.first[at][code], self.size[at][code]


_tokens: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    """The tokenizer of a file, one in a process."""
    if path not in _tokens:
        _tokens[path] = Tokens(path)
    return _tokens[path]


def _parts(texts: list[str], special: dict[str, int]) -> Iterator[tuple[int, str, int]]:
    """(text's index, part, id of the special token that ends it, -1: the text ends, -2: the text goes on)."""
    import re

    some = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
    for i, text in enumerate(texts):
        pieces = some.split(text) if some and any(s in text for s in special) else [text]
        for k in range(0, len(pieces), 2):
            cuts = safe_cuts(pieces[k])
            for c in cuts[:-1]:
                yield i, c, -2
            yield i, cuts[-1], special[pieces[k + 1]] if k + 1 < len(pieces) else -1


def encode(texts: list[str], path: str, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts in order and the texts' offsets into them; end: an id put behind each text.

    The ids are those of the tokenizers library with add_special_tokens=False.
    """
    own = tokens(path)
    counts = np.zeros(len(texts), dtype=np.int64)
    out: list[np.ndarray] = []

    def flush(parts: list[tuple[int, str, int]]) -> None:
        joined = "\0".join(p for _, p, _ in parts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        breaks = np.cumsum([len(p) + 1 for _, p, _ in parts]) - 1
        starts = boundaries(points, breaks)
        mark = np.searchsorted(starts, breaks)
        first, size = own.spans(joined, points, starts)
        size[mark] = 0
        begin = np.cumsum(size) - size
        ids = own.ids[np.repeat(first - begin, size) + np.arange(int(size.sum()))]
        # ids that stand at the separators: special tokens, and the end of a text
        put = np.array([s if s >= 0 else (end if s == -1 and end is not None else -1) for _, _, s in parts])
        where = begin[mark][put >= 0]
        ids = np.insert(ids, where, put[put >= 0].astype(np.uint32))
        length = np.diff(np.r_[0, begin[mark]]) + (put >= 0)
        np.add.at(counts, [i for i, _, _ in parts], length)
        out.append(ids)

    held: list[tuple[int, str, int]] = []
    chars = 0
    for part in _parts(texts, own.special):
        held.append(part)
        chars += len(part[1]) + 1
        if chars >= CHUNK:
            flush(held)
            held, chars = [], 0
    if held:
        flush(held)
    return (np.concatenate(out) if out else np.empty(0, dtype=np.uint32)), np.r_[0, np.cumsum(counts)]
