"""Relevance and question-answering models as pluggable scorers, and deterministic doubles of them.

A model is a Python object that is loaded once in a worker and called with
Arrow batches of pairs; the doubles are plain expressions, so a plan with them
stays in the JVM. Either kind may prepare paragraphs and questions before they
are paired, so that what depends on one side is computed once for it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import NO_ANSWER

ANSWERS = "array<struct<answer:string,score:double>>"
#: Pairs that a model gets at once.
CHUNK = 1000


class RelevanceModel(Protocol):
    """Scores pairs of a question and a paragraph: the probability that the paragraph helps."""

    def __call__(self, questions: list[str], paragraphs: list[str]) -> list[float]: ...


class AnswerModel(Protocol):
    """For each pair the best spans with scores, and the gap by which 'no answer' trails the best."""

    def __call__(self, questions: list[str], paragraphs: list[str]) -> list[tuple[list[tuple[str, float]], float]]: ...


def chunks(question: pd.Series, paragraph: pd.Series, size: int = CHUNK) -> Iterator[tuple[list[str], list[str]]]:
    """A batch in pieces of at most so many pairs."""
    for at in range(0, len(question), size):
        yield question.iloc[at : at + size].tolist(), paragraph.iloc[at : at + size].tolist()


def by_length(question: pd.Series, paragraph: pd.Series, ask: Callable[[list[str], list[str]], list], size: int = CHUNK) -> list:
    """What ask() says of each pair, in the pairs' order; pairs of like length are asked together, so that little is padded."""
    order = paragraph.str.len().fillna(0).to_numpy().argsort(kind="stable")
    told: list = [None] * len(order)
    said = (x for q, p in chunks(question.iloc[order], paragraph.iloc[order], size) for x in ask(q, p))
    for k, x in zip(order, said):
        told[k] = x
    return told


_LOADED: dict[tuple[str, str], object] = {}


def shipped(spark: SparkSession, path: str, build: Callable[[str], object]) -> Callable[[], object]:
    """A load for relevance_udf() and answer_udf(): the model that build makes of a file or folder, which Spark brings to all
    workers. A worker builds it once however many partitions it gets; a new worker fetches and builds it anew.

    The name of the file or folder tells models apart: another model of that name in the same session is an error of Spark's.
    """
    name = path.rstrip("/").rsplit("/", 1)[-1]
    spark.sparkContext.addFile(path, recursive=True)
    made = f"{build.__module__}.{build.__qualname__}"

    def load() -> object:
        from kpiforge.models import _LOADED  # the worker's own, not a copy that came with this function

        if (name, made) not in _LOADED:
            _LOADED[name, made] = build(SparkFiles.get(name))
        return _LOADED[name, made]

    return load


def relevance_udf(load: Callable[[], RelevanceModel]):
    """A column function (question, paragraph) -> probability; load runs once for each worker's partition."""

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = load()
        for question, paragraph in batches:
            yield pd.Series(by_length(question, paragraph, model), dtype=float)

    return score


def answer_udf(load: Callable[[], AnswerModel]):
    """A column function (question, paragraph) -> struct(answers, no_ans_gap)."""

    @F.pandas_udf(f"answers {ANSWERS}, no_ans_gap double")
    def answer(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        model = load()
        for question, paragraph in batches:
            out = by_length(question, paragraph, model)
            yield pd.DataFrame({"answers": [[{"answer": a, "score": s} for a, s in spans] for spans, _ in out], "no_ans_gap": [g for _, g in out]})

    return answer


def words(text: Column) -> Column:
    """Lower-cased words of letters and digits, and empty ones where other characters begin or end a text."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}]+")


def tokens(text: Column) -> Column:
    """Distinct lower-cased words of letters and digits."""
    return F.array_distinct(F.filter(words(text), lambda w: w != ""))


class Relevance:
    """A relevance scorer of pairs; this one is a column function of question and paragraph, such as relevance_udf() gives."""

    def __init__(self, score: Callable[[Column, Column], Column]) -> None:
        self._score = score

    def prepared(self, paragraphs: DataFrame, questions: DataFrame, paragraph: str, question: str) -> tuple[DataFrame, DataFrame]:
        """Both sides with whatever score() needs; columns that begin with an underscore are its own."""
        return paragraphs, questions

    def score(self, paragraph: str, question: str) -> Column:
        """The score of a pair, over the columns of both prepared sides."""
        return self._score(F.col(question), F.col(paragraph))


class OverlapRelevance(Relevance):
    """The double of a relevance model: the share of the question's words that the paragraph has.

    A paragraph is taken to words once, and only those that any question has meet the questions.
    """

    def __init__(self) -> None:
        super().__init__(lambda q, p: F.lit(None))

    def prepared(self, paragraphs: DataFrame, questions: DataFrame, paragraph: str, question: str) -> tuple[DataFrame, DataFrame]:
        asked = questions.withColumn("_words", tokens(F.col(question)))
        every = asked.agg(F.array_distinct(F.flatten(F.collect_list("_words"))).alias("_every"))  # one row
        told = paragraphs.crossJoin(F.broadcast(every)).withColumn("_told", F.array_intersect(words(F.col(paragraph)), F.col("_every"))).drop("_every")
        return told, asked

    def score(self, paragraph: str, question: str) -> Column:
        return F.size(F.array_intersect("_words", "_told")) / F.greatest(F.size("_words"), F.lit(1))


@dataclass(frozen=True)
class Answers:
    """An answer scorer of pairs: struct(answers, no_ans_gap) of question and paragraph, such as answer_udf() gives."""

    answer: Callable[[Column, Column], Column]

    def prepared(self, paragraphs: DataFrame, paragraph: str) -> DataFrame:
        """Paragraphs with whatever found() needs; columns that begin with an underscore are its own."""
        return paragraphs

    def found(self, paragraph: str, question: str) -> Column:
        return self.answer(F.col(question), F.col(paragraph))


@dataclass(frozen=True)
class LongestWords(Answers):
    """The double of an answer model: 'no answer' first unless the longest word has threshold letters; then the longest words.

    n_best answers at most; the score of a word is a hundredth of its length. Answers don't depend on the question, so
    they are found once for a paragraph.
    """

    answer: Callable[[Column, Column], Column] = lambda q, p: F.lit(None)
    n_best: int = 2
    threshold: int = 8

    def prepared(self, paragraphs: DataFrame, paragraph: str) -> DataFrame:
        return paragraphs.withColumn("_answers", longest_words(F.col(paragraph), self.n_best, self.threshold))

    def found(self, paragraph: str, question: str) -> Column:
        return F.struct(F.col("_answers").alias("answers"), F.lit(0.0).alias("no_ans_gap"))


def spoken(text: Column) -> Column:
    """Lower-cased words of letters and digits, in order and as often as they occur."""
    return F.filter(words(text), lambda w: w != "")


@dataclass(frozen=True)
class NearWords(Answers):
    """A double of an answer model that reads the question: words that stand near the question's own words in the paragraph.

    A word's score is the share of the 2 * window places around it that hold words of the question; words of the question and
    words near none of them are no answers, and a word that occurs again counts where it scores most. 'no answer' has
    threshold for a score and comes first unless the best word has as much. n_best answers at most, equal ones by alphabet.
    A null paragraph or question has 'no answer' alone.
    """

    answer: Callable[[Column, Column], Column] = lambda q, p: F.lit(None)
    n_best: int = 2
    window: int = 5
    threshold: float = 0.2

    def prepared(self, paragraphs: DataFrame, paragraph: str) -> DataFrame:
        return paragraphs.withColumn("_spoken", F.coalesce(spoken(F.col(paragraph)), F.array().cast("array<string>")))

    def found(self, paragraph: str, question: str) -> Column:
        words, wide = F.col("_spoken"), self.window
        own = F.coalesce(tokens(F.col(question)), F.array().cast("array<string>"))

        def near(hits: Column) -> Column:
            """Words by rank, equal ones by alphabet: n is less the more of the hits, places of the question's words, are near."""
            place = lambda w, i: F.struct((-F.size(F.filter(hits, lambda h: F.abs(h - i) <= wide))).alias("n"), F.when(~F.array_contains(hits, i), w).alias("answer"))
            return F.sort_array(F.filter(F.transform(words, place), lambda s: (s["n"] < 0) & s["answer"].isNotNull()))

        def best(ranked: Column) -> Column:
            """The first places of the first words: a word counts where it scores most."""
            answers = ranked["answer"]
            first = lambda a: F.get(ranked, (F.array_position(answers, a) - 1).cast("int"))
            return F.transform(F.slice(F.array_distinct(answers), 1, self.n_best), lambda a: F.struct(a.alias("answer"), (-first(a)["n"] / (2.0 * wide)).alias("score")))

        def with_none(told: Column) -> Column:
            none = F.array(F.struct(F.lit(NO_ANSWER).alias("answer"), F.lit(self.threshold).alias("score")))
            first = F.coalesce(F.get(told, F.lit(0))["score"], F.lit(0.0))
            return F.slice(F.when(first >= self.threshold, F.concat(told, none)).otherwise(F.concat(none, told)), 1, self.n_best)

        # each step's list is made once: an element of a list of one is taken through the next
        asked = lambda q: F.array_compact(F.transform(words, lambda w, i: F.when(F.array_contains(q, w), i)))
        told = F.transform(F.array(own), asked)
        for step in (near, best, with_none):
            told = F.transform(told, step)
        return F.struct(told[0].alias("answers"), F.lit(0.0).alias("no_ans_gap"))


def longest_words(paragraph: Column, n_best: int = 2, threshold: int = 8) -> Column:
    """array<struct<answer, score>> of LongestWords."""
    ranked = F.transform(F.sort_array(F.transform(tokens(paragraph), lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))), lambda s: F.struct(s["w"].alias("answer"), (F.length(s["w"]) / 100.0).alias("score")))
    best = F.slice(ranked, 1, n_best)
    none = F.array(F.struct(F.lit(NO_ANSWER).alias("answer"), F.lit(threshold / 100.0).alias("score")))

    def merged(found: Column) -> Column:
        longest = F.coalesce(F.length(F.get(found, F.lit(0))["answer"]), F.lit(0))
        return F.slice(F.when(longest >= threshold, F.concat(found, none)).otherwise(F.concat(none, found)), 1, n_best)

    # the list of the best is made once: an element of a list of one is taken through the rest
    return F.transform(F.array(best), merged)[0]


def question_pairs(paragraphs: DataFrame, questions: DataFrame, relevance: Relevance, paragraph: str, question: str) -> DataFrame:
    """Every question with every paragraph and their paragraph_relevance_score; both sides' columns, but for the scorer's own."""
    from .operators.joins import question_pairs as paired

    own = [c for c in (*paragraphs.columns, *questions.columns)]
    told, asked = relevance.prepared(paragraphs, questions, paragraph, question)
    return paired(told, asked).select(*own, relevance.score(paragraph, question).alias("paragraph_relevance_score"))
