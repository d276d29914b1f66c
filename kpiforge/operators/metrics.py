"""Evaluation of classifiers, answers and rule-based measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _count(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def confusion(df: DataFrame, label: Column, predicted: Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """tp, fp, fn, tn of boolean columns, for each key."""
    cells = {"tp": label & predicted, "fp": ~label & predicted, "fn": label & ~predicted, "tn": ~label & ~predicted}
    return df.groupBy(*keys).agg(*[_count(c).alias(n) for n, c in cells.items()])


def scores(counts: DataFrame) -> DataFrame:
    """accuracy, precision, recall, f1 and support of tp, fp, fn, tn; 0 where there is nothing to divide by."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns({
        "accuracy": _ratio(tp + tn, tp + fp + fn + tn), "precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn), "f1": _ratio(2 * tp, 2 * tp + fp + fn), "support": tp + fn,
    })


def span_scores(answer_start: Column, answer_end: Column, pred_start: Column, pred_end: Column) -> Column:
    """(em, f1, relaxed_f1) of token spans, ends inclusive: -1, -1 stands for no answer."""
    none = (answer_start < 0) | (pred_start < 0)
    same = (answer_start == pred_start) & (answer_end == pred_end)
    overlap = F.when(none, 0).otherwise(F.greatest(F.least(answer_end, pred_end) - F.greatest(answer_start, pred_start) + 1, F.lit(0)))
    both = (answer_end - answer_start + 1) + (pred_end - pred_start + 1)
    f1 = F.when(same, 1.0).when(none, 0.0).otherwise(2.0 * overlap / both)
    return F.struct(same.cast("double").alias("em"), f1.alias("f1"), F.when(same | (overlap > 0), 1.0).otherwise(0.0).alias("relaxed_f1"))


def fold_summary(folds: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean and population standard deviation over folds."""
    return folds.agg(*[f(m).alias(f"{n}_{m}") for m in metrics for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


def by_kpi(rows: DataFrame, keys: tuple[str, ...] = ("kpi_id",)) -> DataFrame:
    """support, em, f1, relaxed_f1 and accuracy of each KPI's answers.

    rows: (*keys, a0, a1, p0, p1), token spans of the answer and the prediction, -1 for none. accuracy: the share of rows
    where both or neither say that there is an answer.
    """
    scored = rows.withColumn("m", span_scores(F.col("a0"), F.col("a1"), F.col("p0"), F.col("p1")))
    same = ((F.col("a0") < 0) == (F.col("p0") < 0)).cast("double")
    return scored.groupBy(*keys).agg(F.count("*").alias("support"), *[F.avg(f"m.{c}").alias(c) for c in ("em", "f1", "relaxed_f1")], F.avg(same).alias("accuracy"))


def rule_scores(verdicts: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """TP, FP, FN and TN counts of joins.matched_measures(), with precision and recall; both are 0 without a true positive."""
    kinds = ("TP", "FP", "FN", "TN")
    counts = verdicts.groupBy(*keys).agg(*[_count(F.col("verdict") == k).alias(k.lower()) for k in kinds])
    return counts.withColumns({"precision": _ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": _ratio(F.col("tp"), F.col("tp") + F.col("fn"))})


def progress(annotated: DataFrame, requested: DataFrame) -> DataFrame:
    """(pdf_name, done, todo, state): how many of the requested KPIs (pdf_name, kpi_id) each report has annotations of."""
    own = annotated.groupBy("pdf_name").agg(F.collect_set("kpi_id").alias("_has"))
    want = requested.groupBy("pdf_name").agg(F.collect_set("kpi_id").alias("_want"))
    done = F.size(F.array_intersect("_want", F.coalesce("_has", F.array().cast("array<double>"))))
    out = want.join(own, "pdf_name", "left").withColumn("done", done).withColumn("todo", F.size("_want") - F.col("done"))
    return out.select("pdf_name", "done", "todo", F.when(F.col("todo") == 0, "DONE").otherwise("TODO").alias("state"))


def annotation_choices(predictions: DataFrame, pdf_name: str, kpi: str) -> DataFrame:
    """(rank, answer, page, paragraph, score): what an annotator may choose for a report's question, the best first."""
    own = predictions.where((F.col("pdf_name") == pdf_name) & (F.col("kpi") == kpi))
    order = Window.orderBy(F.desc("score"), "answer", "page0", "para_idx")  # the few answers to one question
    return own.select(F.row_number().over(order).alias("rank"), "answer", (F.col("page0") + 1).alias("page"), "paragraph", "score")


def annotation_row(answer: str, page: int | None, paragraph: str, score: float, rank: int | None) -> dict[str, object]:
    """What is kept of a choice: a score of an answer that was typed in is 100, or -100 for none, and its rank -1."""
    typed = rank is None
    pages = f"[{page}]" if page is not None else "[]"
    return {"answer": answer, "source_page": pages, "relevant_paragraphs": f'["{paragraph}"]' if paragraph else "[]", "score": (100.0 if answer else -100.0) if typed else score, "rank": -1 if typed else rank}
