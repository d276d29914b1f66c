"""Training sets for both models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.positions import answer_offsets, shifted_from_start
from ..functions.text import answer_line, clean_for_answers, clean_for_curation, page_list, paragraph_list, pdf_name, sentence_list
from ..operators.filters import category_valid, text_annotations
from ..operators.joins import closest_paragraph, elsewhere_answered, unanswerable, with_dated_question, with_question
from ..operators.paragraphs import positive_examples, zip_pages
from ..operators.ranking import group_first, keep_first
from ..operators.reshape import nest_squad, union_all
from ..operators.sampling import negatives, split


def clean_annotations(raw: DataFrame, kpis: DataFrame, excluded_companies: tuple[str, ...] = ("CEZ",)) -> DataFrame:
    """Annotations as read, made fit: no empty rows or companies to leave out, names and types trimmed, pages as numbers,
    data types that the KPI has."""
    kept = raw.na.drop("all").na.drop(subset=["kpi_id", "source_file", "source_page"])
    kept = kept.where(~F.coalesce(F.col("company").isin(*excluded_companies), F.lit(False)))
    out = kept.withColumns({"source_file": pdf_name(F.col("source_file")), "data_type": F.trim("data_type"), "source_page": page_list(F.col("source_page")), "kpi_id": F.col("kpi_id").try_cast("double")})
    return category_valid(out.where("source_page is not null"), kpis)


def relevance_examples(annotations: DataFrame, paragraphs: DataFrame, kpis: DataFrame, ratio: int = 1, seed: int = 42, min_letters: int = 30, skip_pages: int = 3) -> DataFrame:
    """question, context, label and the annotation's columns, once for each question and context.

    annotations: (ann_id, pdf_name, company, data_type, kpi_id, source_page array<int> from 1, relevant_paragraphs text).
    """
    kept = text_annotations(annotations)
    positive = positive_examples(kept.withColumn("sentences", sentence_list(F.col("relevant_paragraphs"))))
    pages = kept.select("ann_id", "pdf_name", F.transform("source_page", lambda p: p - 1).alias("pages"))
    drawn = negatives(pages, paragraphs, ratio, seed, min_letters, skip_pages).select("ann_id", "context", "label")
    negative = drawn.join(kept, "ann_id")
    both = with_question(union_all([positive, negative]), kpis).drop("add_year").where("question is not null")
    return group_first(both.withColumn("context", clean_for_curation(F.col("context"))), ["question", "context"], ["ann_id", "label"])


def answer_rows(annotations: DataFrame, kpis: DataFrame) -> DataFrame:
    """Annotations with their dated question, a tidy answer, and a row for each paragraph with its page.

    annotations: (ann_id, pdf_name, kpi_id, year, answer, source_page array<int>, relevant_paragraphs text).
    """
    asked = with_dated_question(annotations, kpis).where("question is not null")
    listed = asked.withColumns({"answer": answer_line(F.col("answer")), "relevant_paragraphs": paragraph_list(F.col("relevant_paragraphs"))})
    rows = zip_pages(listed.where("answer is not null and answer <> '' and relevant_paragraphs is not null"))
    return rows.select("ann_id", "pdf_name", "kpi_id", "question", F.col("answer"), (F.col("page") - 1).alias("page0"), "paragraph")


def answerable_rows(rows: DataFrame, paragraphs: DataFrame, more: bool = True) -> DataFrame:
    """Located answers: the full paragraph that holds the annotated one, or is most like it, or that itself, and all offsets
    of the answer there.

    more: also paragraphs on other pages that contain the answer.
    """
    clean = rows.withColumns({"paragraph": clean_for_answers(F.col("paragraph")), "answer": clean_for_answers(F.col("answer"))})
    whole = paragraphs.withColumn("text", clean_for_answers(F.col("text")))
    full = closest_paragraph(clean, whole, ["pdf_name", "page0"])
    base = full.select("pdf_name", "kpi_id", "question", "answer", "context", F.lit(0).alias("extra"))
    if more:
        extra = elsewhere_answered(clean, whole).select("pdf_name", "kpi_id", "question", "answer", F.col("text").alias("context"), F.lit(1).alias("extra"))
        base = base.unionByName(extra)
    once = keep_first(base, ["pdf_name", "question", "answer", "context"], ["extra", "kpi_id"])
    located = once.withColumn("_s", shifted_from_start(answer_offsets(F.col("answer"), F.col("context")), F.col("context")))
    return located.select("pdf_name", "kpi_id", "question", "answer", F.col("_s.paragraph").alias("context"), F.col("_s.offsets").alias("answer_starts")).where(F.size("answer_starts") > 0)


def squad(rows: DataFrame, relevant: DataFrame, annotated: DataFrame, dev_share: float, seed: int) -> DataFrame:
    """(split, pos, title, paragraphs): answerable rows and unanswerable ones from relevance results, split by paragraph."""
    none = unanswerable(relevant, annotated).select("pdf_name", "question", F.lit("").alias("answer"), F.col("text").alias("context"), F.array().cast("array<int>").alias("answer_starts"))
    both = rows.select("pdf_name", "question", "answer", "context", "answer_starts").unionByName(none)
    order = Window.partitionBy("pdf_name").orderBy("context", "question", "answer")
    numbered = both.withColumn("pos", F.row_number().over(order)).withColumnRenamed("pdf_name", "title")
    parts = split(numbered, dev_share, seed, "title", "context")
    return union_all([nest_squad(parts.where(F.col("split") == s)).withColumn("split", F.lit(s)) for s in ("train", "dev")])
