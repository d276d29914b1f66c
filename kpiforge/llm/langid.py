"""Language identification with error-correcting output codes.

Every language has a codeword. For each bit a binary n-gram classifier tells
languages whose bit is 1 from the others by the mean log-odds of the text's
byte trigrams. Decoding adds up the loss of each bit against each codeword,
weighted by how well the bit separates the languages in training, and takes
the nearest codeword; a small lead over the second is flagged as ambiguous.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import _LOWER, _pieces, lean, slices

#: Labelled rows that a fit takes, about: beyond, a share of them chosen by hash of the text.
TRAIN_ROWS = 20_000
BUCKETS, SMOOTH, PARTS, TEXTS, MARGIN = 1 << 15, 0.5, 16, 256, 0.2
UNDETERMINED = "und"
#: Log-odds below this are rounding.
ALIKE = 1e-12


def codewords(k: int) -> np.ndarray:
    """k distinct codewords of +1 and -1: exhaustive up to six languages, beyond that chosen far apart."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= 6:  # every way to divide the languages in two, once
        cols = [c for c in itertools.product((1, -1), repeat=k) if c[0] == 1 and -1 in c]
        return np.array(cols, dtype=float).T
    bits = int(np.ceil(10 * np.log2(k)))
    best, most = None, -1
    for seed in range(50):
        code = np.random.default_rng(seed).choice((-1.0, 1.0), size=(k, bits))
        apart = (bits - code @ code.T) / 2
        least = apart[~np.eye(k, dtype=bool)].min() if np.abs(code.sum(0)).max() < k else -1
        if least > most:
            best, most = code, least
    return best


def _grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[int], list[int]]]:
    """Buckets of the byte trigrams of joined chunks; index and start of each text's part, as _pieces() has them."""
    for joined, index, at in _pieces([(t or "").encode() for t in texts]):
        raw = _LOWER[np.frombuffer(b" " + joined + b"  ", dtype=np.uint8)].astype(np.uint32)  # a trigram for the end, too
        raw[(raw >= 48) & (raw <= 57)] = 48
        h = raw[:-2] * np.uint32(0x9E3779B1) + raw[1:-1] * np.uint32(0x85EBCA77) + raw[2:] * np.uint32(0xC2B2AE3D)
        yield (h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1), index, at


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter."""
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Model:
    """Languages, their codewords, and for each bit the log-odds of a trigram's bucket, scaled, and a weight."""

    languages: list[str]
    code: np.ndarray
    odds: np.ndarray
    weight: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (0 to 1) and ambiguity of each text; UNDETERMINED and 0 without a letter or a language."""
        bits = self.odds.shape[1]
        total, size = np.zeros((len(texts), bits)), np.zeros(len(texts))
        if self.languages:
            for grams, index, at in _grams(texts):
                for b in range(bits):
                    np.add.at(total[:, b], index, np.add.reduceat(self.odds[:, b][grams], at) if len(grams) else 0)
                np.add.at(size, index, np.diff(np.r_[at, len(grams)]))
        margin = total / np.maximum(size, 1)[:, None]
        loss = np.stack([(np.logaddexp(0, -3 * margin * row) * self.weight).sum(1) for row in self.code], 1) if self.languages else np.zeros((len(texts), 1))
        share = np.exp(3 * (loss.min(1, keepdims=True) - loss))
        share /= share.sum(1, keepdims=True)
        ranked = np.sort(share, 1)
        lead = ranked[:, -1] - (ranked[:, -2] if ranked.shape[1] > 1 else 0)
        best = loss.argmin(1)
        known = np.array([bool(self.languages) and has_letter(t) for t in texts], dtype=bool)
        lang = [self.languages[i] if k else UNDETERMINED for i, k in zip(best, known)]
        return lang, np.where(known, share[np.arange(len(texts)), best], 0.0), ~known | (lead < MARGIN)


def quota(sizes: list[int], total: int) -> int:
    """The most that each group may take so that all take total, or everything; at least 1."""
    left, most = total, max(sizes, default=1)
    for k, n in enumerate(sorted(sizes)):
        if n * (len(sizes) - k) > left:
            return max(left // (len(sizes) - k), 1)
        left -= n
    return max(most, 1)


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model of docs (text, lang); rows with a null in either are left out. Every language counts alike.

    A bit whose two sides have the same trigrams tells nothing and has no weight; where that is so of all bits, as with
    one text under two labels, every language scores the same, the first one is predicted and all texts are ambiguous.

    Of more than train_rows labelled rows, about so many are taken, by hash of the text: all rows of languages below
    a quota, a share of the others'. Each language keeps at least the texts of its smallest hash.
    """
    known = docs.where("text is not null and lang is not null").select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = known.groupBy("lang").agg(F.count("*").alias("n"), F.min(F.xxhash64("text")).alias("least")).collect()
    most = quota([r["n"] for r in rows], train_rows)
    shares = [(r["lang"], share, r["least"] % share) for r in rows if (share := -(-r["n"] // most)) > 1]
    if shares:
        shared = F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, share bigint, rest bigint"))
        known = known.join(shared, "lang", "left").where(F.col("share").isNull() | (F.pmod(F.xxhash64("text"), "share") == F.col("rest"))).select("text", "lang")

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for lo in range(0, batch.num_rows, TEXTS):
                texts = batch.column(0).slice(lo, TEXTS).to_pylist()
                for grams, index, at in _grams(texts):
                    for i, a, b in zip(index, at, [*at[1:], len(grams)]):
                        one = sums.setdefault(langs[lo + i], np.zeros(BUCKETS, dtype=np.int64))
                        one += np.bincount(grams[a:b], minlength=BUCKETS)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["lang", "counts"])

    counts: dict[str, np.ndarray] = {}
    for row in known.repartition(PARTS).mapInArrow(count, "lang string, counts binary").toLocalIterator():
        counts[row["lang"]] = counts.get(row["lang"], 0) + np.frombuffer(row["counts"], dtype=np.int64)
    languages = sorted(counts)
    if not languages:
        return Model([], np.ones((0, 1)), np.zeros((BUCKETS, 1), dtype=np.float32), np.ones(1))
    p = np.stack([(counts[x] + SMOOTH) / (counts[x].sum() + SMOOTH * BUCKETS) for x in languages])
    code = codewords(len(languages))
    odds = np.zeros((BUCKETS, code.shape[1]))
    weight = np.ones(code.shape[1])
    if len(languages) > 1:
        for b in range(code.shape[1]):
            odds[:, b] = np.log(p[code[:, b] > 0].mean(0)) - np.log(p[code[:, b] < 0].mean(0))
        expected = p @ odds
        scale = np.abs(expected).mean(0)
        tells = scale > ALIKE
        scale = np.where(tells, scale, 1.0)
        odds = np.where(tells, odds / scale, 0.0)
        weight = np.where(tells, np.maximum((expected * code).min(0) / scale, 0.05), 0.0)
    return Model(languages, code, odds.astype(np.float32), weight / max(weight.sum(), ALIKE))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of each row of docs (doc_id, text); other columns are not looked at.

    Null texts and texts without a letter are UNDETERMINED with score 0. Repeated rows stay; no rows give none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @lean
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, rows=TEXTS):
                lang, score, doubt = shared.value.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(doubt)], names=["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        make, "doc_id bigint, lang_pred string, score double, ambiguous boolean"
    )


def known_language(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all their columns, whose text has a language: only texts without a letter have none.

    A model without languages leaves out the same rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def language(text):
        import pandas as pd

        parts = [text.iloc[lo : lo + TEXTS].tolist() for lo in range(0, len(text), TEXTS)]
        if not shared.value.languages:
            return pd.Series(["" if has_letter(t) else UNDETERMINED for p in parts for t in p], dtype=object)
        return pd.Series([x for p in parts for x in shared.value.predict(p)[0]], dtype=object)

    return docs.where(language(F.col("text")) != UNDETERMINED)
