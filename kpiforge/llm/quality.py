"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated isotonically.

The statistics are standardised; random Fourier features approximate a
Gaussian kernel over them. Each part of the training rows sums its share of
the normal equations, and the driver solves the total, whose size is fixed.
Isotonic regression of the labels on ridge scores maps a score to a
probability; the scores are those of ridges that have not seen the row, each
fitted on all folds but the row's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import release, table
from .text import U64, lean, mix, slices, word_table

#: Labelled rows that a fit takes, about: beyond, a share of them chosen by hash of doc_id.
TRAIN_ROWS = 40_000
FEATURES, RIDGE, SEED, PARTS, TEXTS = 256, 1e-3, 7, 16, 256
#: Folds of the labelled rows for the calibration, by hash of doc_id; so many rows of label 1 stand at the least
#: score and of label 0 at the greatest, as no score is certain.
FOLDS, PRIOR = 4, 0.5

#: The statistics, in order.
STATISTICS = (
    "log_bytes", "log_words", "upper", "lower", "digit", "space", "newline", "stop", "exclaim", "pipe", "sign", "high",
    "mean_word", "word_spread", "longest_word", "short_words", "same_as_before", "distinct_words", "byte_entropy",
)
_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": (9, 11, 12, 13, 32), "newline": (10,), "stop": map(ord, ".,;:"),
    "exclaim": map(ord, "!?"), "pipe": map(ord, "|"), "sign": map(ord, "#$%&*@^~<>=_\\/{}[]+"), "high": range(128, 256),
}


def _class_matrix() -> np.ndarray:
    out = np.zeros((256, len(_CLASSES)))
    for k, members in enumerate(_CLASSES.values()):
        out[list(members), k] = 1
    return out


_MATRIX = _class_matrix()


def statistics(texts: list[str | None]) -> np.ndarray:
    """A row of STATISTICS for each text; zeros for a null or empty one."""
    words, lengths, at = word_table(texts)
    same = np.zeros(len(words) + 1)
    same[1:-1] = words[1:] == words[:-1]
    out = np.zeros((len(texts), len(STATISTICS)))
    for i, text in enumerate(texts):
        raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
        if not len(raw):
            continue
        count = np.bincount(raw, minlength=256)
        share = count / len(raw)
        some = share[share > 0]
        lo, hi = at[i], at[i + 1]
        out[i, 0], out[i, 1] = np.log1p(len(raw)), np.log1p(hi - lo)
        out[i, 2:12] = share @ _MATRIX
        if hi > lo:
            size = lengths[lo:hi]
            out[i, 12:18] = size.mean(), size.std(), np.log1p(size.max()), (size <= 3).mean(), same[lo + 1 : hi].sum() / (hi - lo), len(np.unique(words[lo:hi])) / (hi - lo)
        out[i, 18] = -(some * np.log2(some)).sum()
    return out


def statistics_table(docs: DataFrame) -> DataFrame:
    """(doc_id, stats array<float>) of each row of docs (doc_id, text)."""

    @lean
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, rows=TEXTS):
                found = statistics(part.column(1).to_pylist()).astype(np.float32)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(STATISTICS)), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), flat], names=["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(make, "doc_id bigint, stats array<float>")


@dataclass
class Model:
    """A fitted classifier; scores of rows of STATISTICS."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        d = stats.shape[1]
        omega = rng.normal(size=(d, FEATURES)) / np.sqrt(d)
        phase = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        return np.c_[np.sqrt(2 / FEATURES) * np.cos(z @ omega + phase), np.ones(len(z))]

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.ridge(stats), self.steps, self.values), 0, 1)


def isotonic(score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: scores and non-decreasing values at them."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # value, weight, first and last score
    for s, y, w in zip(score[order], label[order], weight[order]):
        blocks.append([y, w, s, s])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            y1, w1, _, hi = blocks.pop()
            y0, w0, lo, _ = blocks.pop()
            blocks.append([(y0 * w0 + y1 * w1) / (w0 + w1), w0 + w1, lo, hi])
    steps = np.array([x for b in blocks for x in (b[2], b[3])])
    values = np.repeat([b[0] for b in blocks], 2)
    return steps, values


def _sums(rows: DataFrame, make, size: int) -> np.ndarray:
    """The sum over parts of make(stats, label, fold), an array of a fixed size, from a bounded number of parts."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                fold = (mix(batch["doc_id"].to_numpy(dtype=np.int64).view(U64)) % U64(FOLDS)).astype(np.int64)
                total += make(np.stack(batch["stats"].to_numpy()).astype(float), batch["label"].to_numpy(dtype=float), fold)
        yield pd.DataFrame({"total": [total.tobytes()]})

    return sum((np.frombuffer(r["total"]) for r in rows.mapInPandas(part, "total binary").collect()), np.zeros(size))


def fit(stats: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model | None:
    """A model of labels (doc_id, label) on a statistics_table(); None without labelled rows.

    Labels are 0 or 1; others and nulls are left out, and of several for a doc_id the mean counts. Of more than
    train_rows labelled rows, about so many are taken, by hash of doc_id.
    """
    known = labels.where("label in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.avg("label").alias("label"))
    share = -(-known.count() // train_rows)
    if share > 1:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
    rows = table(stats.join(known, "doc_id").select("doc_id", "stats", "label").repartition(PARTS, "doc_id"), "labelled")
    d = len(STATISTICS)
    moments = _sums(rows, lambda x, y, fold: np.r_[len(x), x.sum(0), (x * x).sum(0), y.sum()], 2 * d + 2)
    n = moments[0]
    if not n:
        return None
    mean = moments[1 : d + 1] / n
    scale = np.sqrt(np.maximum(moments[d + 1 : 2 * d + 1] / n - mean**2, 0))
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))
    ones = min(max(moments[-1] / n, 1e-6), 1 - 1e-6)
    m = FEATURES + 1

    def equations(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        z, w, out = model.features(x), np.where(y >= 0.5, 0.5 / ones, 0.5 / (1 - ones)), []
        for k in range(FOLDS):
            a, v = z[fold == k], w[fold == k]
            out += [((a * v[:, None]).T @ a).ravel(), a.T @ (v * y[fold == k]), [len(a)]]
        return np.concatenate(out)

    def solved(total: np.ndarray) -> np.ndarray:
        return np.linalg.solve(total[: m * m].reshape(m, m) + RIDGE * max(total[-1], 1) * np.eye(m) / m, total[m * m : -1])

    total = _sums(rows, equations, FOLDS * (m * m + m + 1)).reshape(FOLDS, -1)
    model.weights = solved(total.sum(0))
    others = np.stack([solved(total.sum(0) - one) for one in total], 1)
    bins = 2000

    def histogram(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        unseen = (model.features(x) @ others)[np.arange(len(x)), fold]
        at = np.clip(((unseen + 1) / 3 * bins).astype(int), 0, bins - 1)
        return np.r_[np.bincount(at, minlength=bins), np.bincount(at, weights=y, minlength=bins)]

    hist = _sums(rows, histogram, 2 * bins)
    some = np.flatnonzero(hist[:bins])
    hist[some[[0, -1]]] += PRIOR
    hist[bins + some[0]] += PRIOR
    model.steps, model.values = isotonic((some + 0.5) / bins * 3 - 1, hist[bins:][some] / hist[:bins][some], hist[:bins][some])
    release(rows)
    return model


def score(stats: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, predicted) of each row of a statistics_table(); score 0.5 without a model."""

    @lean
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(STATISTICS)).astype(float)
            s = model(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return stats.mapInArrow(make, "doc_id bigint, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, score, predicted) of every row of docs (doc_id, text), learning from labels (doc_id, label).

    score is the probability of label 1; a null or empty text has one too. Repeated rows stay; other columns are not
    looked at; no documents give no rows.
    """
    stats = table(statistics_table(docs), "stats")
    return score(stats, fit(stats, labels, train_rows))
