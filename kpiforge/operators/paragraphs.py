"""Pages to paragraphs, and annotations to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_for_curation, letters_when_clean
from ..schemas import NO_ANSWER


def split_pages(pages: DataFrame, separator: str = "\n\n", min_letters: int = 30, keys: tuple[str, ...] = ("pdf_name", "page0")) -> DataFrame:
    """(*keys, para_idx, text): a page's text split at separator, cleaned, with more than min_letters letters.

    para_idx counts the split parts from 0. A null text has none; pages without paragraphs give no rows.
    """
    parts = pages.select(*keys, F.posexplode(F.split("text", f"\\Q{separator}\\E", -1)).alias("para_idx", "raw"))
    # a condition on the cleaned text would clean it twice
    return parts.where(letters_when_clean(F.col("raw")) > min_letters).select(*keys, "para_idx", clean_for_curation(F.col("raw")).alias("text"))


def first_paragraphs(pages: DataFrame, separator: str = "\n\n", min_letters: int = 30, keys: tuple[str, ...] = ("pdf_name", "page0")) -> DataFrame:
    """(*keys, para_idx, text): of each row the first of split_pages(), found without cleaning the others; none gives no row."""
    parts = F.transform(F.split("text", f"\\Q{separator}\\E", -1), lambda raw, i: F.struct(i.alias("para_idx"), raw.alias("raw")))
    first = F.get(F.filter(parts, lambda x: letters_when_clean(x["raw"]) > min_letters), F.lit(0))
    found = pages.select(*keys, F.inline(F.array_compact(F.array(first))))
    return found.select(*keys, "para_idx", clean_for_curation(F.col("raw")).alias("text"))


def positive_examples(annotations: DataFrame, sentences: str = "sentences") -> DataFrame:
    """A row for each sentence of an annotation, as context with label 1; rows without sentences give none."""
    return annotations.withColumn("context", F.explode(sentences)).drop(sentences).withColumn("label", F.lit(1))


def zip_pages(annotations: DataFrame, pages: str = "source_page", paragraphs: str = "relevant_paragraphs") -> DataFrame:
    """A row for each paragraph: with one page all are on it, with several they pair up in order to the shorter list."""
    n = F.least(F.size(pages), F.size(paragraphs))
    one = F.transform(paragraphs, lambda p: F.struct(F.get(F.col(pages), F.lit(0)).alias("page"), p.alias("paragraph")))
    many = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(F.col(pages), i).alias("page"), F.get(F.col(paragraphs), i).alias("paragraph")))
    pairs = F.when(F.size(pages) == 1, one).when(n > 0, many)
    rest = [c for c in annotations.columns if c not in (pages, paragraphs)]
    return annotations.select(*rest, F.inline(pairs))


def melt_answers(predictions: DataFrame, answers: str = "answers") -> DataFrame:
    """Ranked answers as rows: rank from 1, then the fields of each answer."""
    rest = [c for c in predictions.columns if c != answers]
    rows = predictions.select(*rest, F.posexplode(answers).alias("rank", "answer"))
    return rows.select(*rest, (F.col("rank") + 1).alias("rank"), "answer.*")


def with_no_answer(answers: Column, no_ans_gap: Column, boost: float) -> Column:
    """The scores of 'no answer' in a passage: with the boost, that among the best answers or else the first one's less the
    gap; and without the boost."""
    listed = F.get(F.filter(answers, lambda a: a["answer"] == NO_ANSWER), F.lit(0))["score"]
    boosted = F.coalesce(listed, F.get(answers, F.lit(0))["score"] - no_ans_gap)
    return F.struct((boosted - boost).alias("no_ans_score"), boosted.alias("no_answer_score_plus_boost"))
