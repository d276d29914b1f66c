"""How alike two texts are when the shorter may stand anywhere in the longer.

The similarity is 1 - d / m: d is the fewest characters to put in, take out or replace so that the shorter text, of m
characters, is a part of the longer one. The longer text is gone through once, with a column of the table of distances as the
bits of two numbers. A text that lacks many of the shorter one's grams is told without that: a change spoils GRAM of them at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

GRAM = 3


class Pattern:
    """A text that is looked for: where each character stands in it, as bits, and its grams."""

    def __init__(self, text: str) -> None:
        self.text, self.size = text, len(text)
        self.bits: dict[str, int] = {}
        for i, c in enumerate(text):
            self.bits[c] = self.bits.get(c, 0) | 1 << i
        self.grams = [text[i : i + GRAM] for i in range(len(text) - GRAM + 1)]

    def least_changes(self, text: str) -> int:
        """No more than changes(): by the grams that the text lacks."""
        there = {text[i : i + GRAM] for i in range(len(text) - GRAM + 1)}
        return -(-sum(g not in there for g in self.grams) // GRAM)

    def changes(self, text: str) -> int:
        """The fewest changes that make the pattern a part of a text."""
        full, top, get = (1 << self.size) - 1, 1 << max(self.size - 1, 0), self.bits.get
        more, less = full, 0  # where the distance rises and falls down the column
        last = best = self.size
        for c in text:
            met = get(c, 0)
            across = (((met & more) + more) ^ more) | met
            rises, falls = less | (full & ~(across | more)), more & across
            if rises & top:
                last += 1
            elif falls & top:
                last -= 1
                best = min(best, last)
            rises, falls, down = (rises << 1) & full, (falls << 1) & full, met | less
            more, less = falls | (full & ~(down | rises)), rises & down
        return best


def partial_ratio(short: str, long: str) -> float:
    """The best similarity, 0 to 1, of the shorter text with any part of the longer one; 0 for an empty text."""
    if len(short) > len(long):
        short, long = long, short
    if not short:
        return 0.0
    return 1.0 if short in long else 1 - Pattern(short).changes(long) / len(short)


def most_alike(text: str, others: list[str]) -> int:
    """The place of the first of those texts that text is most alike by partial_ratio(); one that can't be is not looked at closely."""
    best, top, of = 0, 0, 1  # top / of: the best similarity so far
    own = Pattern(text)
    for k, other in enumerate(others):
        pattern, long = (own, other) if len(text) <= len(other) else (Pattern(other), text)
        if (pattern.size - pattern.least_changes(long)) * of <= top * pattern.size:
            continue
        found = pattern.size if pattern.text in long else pattern.size - pattern.changes(long)
        if found * of > top * pattern.size:
            best, top, of = k, found, pattern.size
    return best


def partial_ratio_of(a: Column, b: Column) -> Column:
    """partial_ratio() of two columns, null counting as empty; equal pairs of a batch are looked at once."""

    @F.pandas_udf("double")
    def ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for short, long in batches:
            known: dict[tuple[str, str], float] = {}
            out = []
            for pair in zip(short.fillna(""), long.fillna("")):
                if pair not in known:
                    known[pair] = partial_ratio(*pair)
                out.append(known[pair])
            yield pd.Series(out, dtype=float)

    return ratio(a, b)
