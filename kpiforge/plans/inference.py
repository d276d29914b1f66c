"""The model path as one plan: paragraphs and questions to the best answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..models import Answers, LongestWords, OverlapRelevance, Relevance, question_pairs
from ..operators.joins import with_kpi_id
from ..operators.paragraphs import with_no_answer
from ..operators.ranking import top_k
from ..schemas import NO_ANSWER, NO_ANSWER_BOOST, TOP_K


def relevant_paragraphs(paragraphs: DataFrame, questions: DataFrame, relevance: Relevance | None = None, threshold: float = 0.5, more: tuple[str, ...] = ()) -> DataFrame:
    """(pdf_name, page0, para_idx, kpi, paragraph, paragraph_relevance_score) of the pairs that the model takes for relevant.

    more: further columns of paragraphs to keep.
    """
    told = paragraphs.select("pdf_name", "page0", "para_idx", F.col("text").alias("paragraph"), *more)
    pairs = question_pairs(told, questions.select(F.col("question").alias("kpi")), relevance or OverlapRelevance(), "paragraph", "kpi")
    return pairs.where(F.col("paragraph_relevance_score") >= threshold).select("pdf_name", "page0", "para_idx", "kpi", "paragraph", "paragraph_relevance_score", *more)


def melted(pairs: DataFrame, boost: float = NO_ANSWER_BOOST) -> DataFrame:
    """A row for each span answer of a pair, and one 'no answer' for a question of a report where no pair has a span first.

    pairs: (pdf_name, kpi, page0, para_idx, ..., answers, no_ans_gap). A row has rank, answer, score, source, no_ans_score
    and no_answer_score_plus_boost; the 'no answer' row has the greatest score of the pairs' and null in all else but its
    keys. The pairs are evaluated once and shuffled once.
    """
    keys = ["pdf_name", "kpi"]
    rest = [c for c in pairs.columns if c not in (*keys, "answers", "no_ans_gap")]
    report = Window.partitionBy(*keys)
    first = F.get("answers", F.lit(0))
    # pairs without answers come last and explode to nothing: a condition on answers would have them found twice
    empty = F.coalesce(F.size("answers"), F.lit(0)) <= 0
    known = pairs.withColumns({
        "_none": F.min((first["answer"] == NO_ANSWER).cast("int")).over(report), "_best": F.max(first["score"]).over(report),
        "_one": F.row_number().over(report.orderBy(empty, "page0", "para_idx")),
        "_scores": with_no_answer(F.col("answers"), F.col("no_ans_gap"), boost),
    })
    spans = F.filter(F.transform("answers", lambda a, i: F.struct((i + 1).alias("rank"), a["answer"].alias("answer"), a["score"].alias("score"))), lambda a: a["answer"] != NO_ANSWER)
    none = F.array(F.struct(F.lit(0).alias("rank"), F.lit(NO_ANSWER).alias("answer"), F.col("_best").alias("score")))
    rows = known.withColumn("a", F.explode(F.when((F.col("_none") == 1) & (F.col("_one") == 1), F.concat(spans, none)).otherwise(spans)))
    span = F.col("a.rank") > 0
    kept = lambda c: F.when(span, F.col(c))
    return rows.select(
        *keys, *[kept(c).alias(c) for c in rest], kept("a.rank").alias("rank"), "a.answer", "a.score", F.lit("Text").alias("source"),
        *[kept(f"_scores.{c}").alias(c) for c in ("no_ans_score", "no_answer_score_plus_boost")],
    )


def extract_answers(
    paragraphs: DataFrame, kpis: DataFrame, relevance: Relevance | None = None, answers: Answers | None = None, threshold: float = 0.5, k: int = TOP_K, boost: float = NO_ANSWER_BOOST
) -> DataFrame:
    """kpi_pred: the k best answers to each question in each report, with the place and scores of their paragraphs."""
    answers = answers or LongestWords()
    ready = answers.prepared(paragraphs, "text")
    own = tuple(c for c in ready.columns if c.startswith("_"))
    relevant = relevant_paragraphs(ready, kpis, relevance, threshold, own)
    scored = relevant.withColumn("_found", answers.found("paragraph", "kpi")).select("*", "_found.answers", "_found.no_ans_gap").drop("_found", *own)
    best = top_k(melted(scored, boost), ["pdf_name", "kpi"], k, tie=("answer", "page0", "para_idx"))
    return with_kpi_id(best, kpis).select(
        "pdf_name", "kpi", "kpi_id", "answer", "page0", "para_idx", "paragraph", "source", "paragraph_relevance_score", "score", "no_ans_score", "no_answer_score_plus_boost"
    )


def single_pair(spark, paragraph: str, question: str, relevance: Relevance | None = None) -> float:
    """The relevance of one paragraph to one question."""
    told = spark.createDataFrame([(paragraph,)], "paragraph string")
    asked = spark.createDataFrame([(question,)], "question string")
    return question_pairs(told, asked, relevance or OverlapRelevance(), "paragraph", "question").first()["paragraph_relevance_score"]


def squad_predictions(squad_rows: DataFrame, answers: Answers | None = None) -> DataFrame:
    """(title, context, id, question, prediction, score) for flattened reading-comprehension rows (title, context, id, question):
    the best answer of each, 'no answer' included."""
    answers = answers or LongestWords()
    ready = answers.prepared(squad_rows, "context")
    best = F.get(F.col("_found.answers"), F.lit(0))
    return ready.withColumn("_found", answers.found("context", "question")).select("title", "context", "id", "question", best["answer"].alias("prediction"), best["score"].alias("score"))
