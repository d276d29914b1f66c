"""Joins between questions, paragraphs, annotations, predictions and places on a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import most_alike
from ..functions.geometry import Rect, area, intersection_area
from ..functions.text import file_stem, with_year
from ..staging import staged
from .anchors import any_contained, containing
from .groups import each_group

#: A question list is broadcast up to so many rows.
SMALL = 100_000


def small(df: DataFrame) -> DataFrame:
    """df with a broadcast hint if it is small, which is counted."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def by_keys(df: DataFrame) -> DataFrame:
    """df with a hint that joins by equal keys shuffle it: what comes of lists that were exploded is taken for as small as the
    lists' file, and would go through the driver to all executors."""
    return df.hint("merge")


def few_or_by_keys(df: DataFrame) -> DataFrame:
    """df, which is written or kept and so cheaply counted, with the hint for a join by equal keys that its rows ask for."""
    return F.broadcast(df) if df.count() <= SMALL else by_keys(df)


def question_pairs(paragraphs: DataFrame, questions: DataFrame) -> DataFrame:
    """Every question with every paragraph; the questions are few, and the pairs stay in the stage that scans."""
    return paragraphs.crossJoin(small(questions))


def with_question(annotations: DataFrame, kpis: DataFrame) -> DataFrame:
    """Annotations with their KPI's question, null for an unknown one; ids compare as numbers."""
    known = kpis.select(F.col("kpi_id").cast("decimal(9,2)").alias("_id"), "question", "add_year")
    return annotations.withColumn("_id", F.col("kpi_id").try_cast("decimal(9,2)")).join(known, "_id", "left").drop("_id")


def with_dated_question(annotations: DataFrame, kpis: DataFrame) -> DataFrame:
    """As with_question(), and questions that ask for a year name the annotation's."""
    out = with_question(annotations, kpis)
    return out.withColumn("question", F.when(F.col("add_year"), with_year(F.col("question"), F.col("year"))).otherwise(F.col("question"))).drop("add_year")


def mapped_and_unmapped(annotations: DataFrame, kpis: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Annotations with a question, and the distinct ids of those without."""
    both = with_question(annotations, kpis)
    return both.where("question is not null"), both.where("question is null").select("kpi_id").distinct()


def with_kpi_id(predictions: DataFrame, kpis: DataFrame, question: str = "kpi") -> DataFrame:
    """Predictions with the id of the KPI that asks their question, null for none."""
    ids = kpis.select(F.col("question").alias(question), "kpi_id").dropDuplicates([question])
    return predictions.join(ids, question, "left")



def first_containing(sentences: DataFrame, paragraphs: DataFrame, keys: list[str], sentence: str, order: list[str], ignore_case: bool = False) -> DataFrame:
    """Each sentence with the first paragraph, in order, that contains it among those with equal keys; null if none does.

    sentences must be unique by (keys, sentence).
    """
    text, part = (F.lower(F.col(c)) if ignore_case else F.col(c) for c in ("text", sentence))
    s = sentences.select(*keys, sentence).distinct()
    hits = s.join(paragraphs.select(*keys, *order, "text"), keys).where(F.contains(text, part))
    rank = F.row_number().over(Window.partitionBy(*keys, sentence).orderBy(*order))
    first = hits.withColumn("_k", rank).where("_k = 1").drop("_k")
    return sentences.join(first, [*keys, sentence], "left")


def closest_paragraph(rows: DataFrame, paragraphs: DataFrame, keys: list[str], sentence: str = "paragraph", answer: str = "answer", order: tuple[str, ...] = ("para_idx",)) -> DataFrame:
    """rows with context: the first paragraph of equal keys that contains the annotated text, else the one most like it if it
    has the answer, else the annotated text itself.

    Only texts that no paragraph contains are compared, with the paragraphs of their keys.
    """
    found = first_containing(rows, paragraphs, keys, sentence, list(order)).withColumnRenamed("text", "_whole").drop(*order)
    lost = found.where("_whole is null").select(*keys, sentence).distinct().where(F.col(sentence).isNotNull())
    pairs = lost.join(paragraphs.select(*keys, *order, "text"), keys)
    types = ", ".join(f"{k} {pairs.schema[k].dataType.simpleString()}" for k in (*keys, sentence))
    # of one annotated text and the paragraphs of its page, those that can't be the most alike are told by a bound
    best = each_group(
        pairs.select(*keys, sentence, *order, F.coalesce("text", F.lit("")).alias("text")), [*keys, sentence],
        lambda key, held: [(*key, held[most_alike(key[-1], [r[-1] for r in held])][-1])], f"{types}, _best string", order,
    )
    told = found.join(best, [*keys, sentence], "left").withColumn("_best", F.when(F.contains("_best", F.col(answer)), F.col("_best")))
    return told.withColumn("context", F.coalesce("_whole", "_best", F.col(sentence))).drop("_whole", "_best").select(*rows.columns, "context")


def with_extraction(annotations: DataFrame, extractions: DataFrame) -> DataFrame:
    """Annotations (source_file, company, ...) with the extraction (file) of their report: of the same stem, else the first
    whose name contains '<stem>-<company>'; null if there is none."""
    files = staged(extractions.select("file", file_stem(F.col("file")).alias("_stem")).distinct(), "files")
    exact = files.groupBy("_stem").agg(F.min("file").alias("_exact"))
    own = annotations.withColumn("_stem", file_stem(F.col("source_file"))).join(exact, "_stem", "left")
    lost = staged(own.where("_exact is null").select("_stem", "company", F.concat_ws("-", "_stem", "company").alias("answer")).distinct(), "lost")
    every = F.lit("")  # one question: which names hold which parts
    met = containing(files.select(F.col("file").alias("row"), every.alias("by"), F.col("file").alias("text")).where("file is not null"), lost.select(every.alias("by"), "answer"))
    loose = lost.join(met, "answer").groupBy("_stem", "company").agg(F.min("row").alias("_loose"))
    same = (F.col("_stem") == F.col("_s")) & F.col("company").eqNullSafe(F.col("_c"))
    out = own.join(loose.select(F.col("_stem").alias("_s"), F.col("company").alias("_c"), "_loose"), same, "left")
    return out.withColumn("file", F.coalesce("_exact", "_loose")).drop("_stem", "_exact", "_s", "_c", "_loose")


def elsewhere_answered(annotations: DataFrame, paragraphs: DataFrame, excluded_kpis: tuple[float, ...] = (0.0, 1.0, 9.0, 11.0)) -> DataFrame:
    """Paragraphs on other pages of the same report that contain the answer, for KPIs that are not excluded."""
    asked = annotations.where(~F.col("kpi_id").cast("double").isin(*excluded_kpis)).select("pdf_name", "kpi_id", "question", "answer", F.col("page0").alias("source_page0"))
    met = asked.join(paragraphs, "pdf_name").where((F.col("page0") != F.col("source_page0")) & F.contains("text", F.col("answer")))
    return met.select("pdf_name", "kpi_id", "question", "answer", "page0", "para_idx", "text")


def unanswerable(candidates: DataFrame, annotations: DataFrame) -> DataFrame:
    """Candidate (pdf_name, page0, question, text) of annotated reports that answer nothing: not on a page annotated for
    the report, and not containing any answer to the same question.

    Texts meet answers through an index of the answers' rarest parts, see anchors.containing(). What is read of annotations
    is written once before.
    """
    annotations = staged(annotations.select("pdf_name", "page0", "question", "answer"), "asked")
    pages = annotations.select("pdf_name", "page0").distinct()
    reports = annotations.select("pdf_name").distinct()
    answers = annotations.select(F.col("question").alias("by"), "answer")
    kept = candidates.join(reports, "pdf_name", "left_semi").join(pages, ["pdf_name", "page0"], "left_anti")
    keyed = staged(kept.withColumn("_row", F.xxhash64("question", "text")), "candidates")  # what a text contains does not depend on where it stands
    told = any_contained(keyed.select(F.col("_row").alias("row"), F.col("question").alias("by"), "text").distinct(), answers).withColumnRenamed("row", "_row")
    return keyed.join(told, "_row", "left_anti").select(candidates.columns)


def overlapping(a: DataFrame, b: DataFrame, key: str, a_prefix: str = "a_", b_prefix: str = "b_") -> DataFrame:
    """Interval pairs of equal key that overlap: [begin, end) columns with a prefix each."""
    hit = (F.col(f"{a_prefix}begin") < F.col(f"{b_prefix}end")) & (F.col(f"{b_prefix}begin") < F.col(f"{a_prefix}end"))
    return a.join(b, key).where(hit)


def covered(outer: DataFrame, inner: DataFrame, key: str, outer_prefix: str = "a_", inner_prefix: str = "b_") -> DataFrame:
    """Interval pairs of equal key where the first covers the second."""
    hit = (F.col(f"{outer_prefix}begin") <= F.col(f"{inner_prefix}begin")) & (F.col(f"{inner_prefix}end") <= F.col(f"{outer_prefix}end"))
    return outer.join(inner, key).where(hit)


def items_in(rects: DataFrame, items: DataFrame, keys: list[str], share: float = 0.3, rect_prefix: str = "r_") -> DataFrame:
    """Items with more than share of their area in a rectangle of the same page."""
    r, i = Rect.of(rect_prefix), Rect.of()
    return rects.join(items, keys).where(intersection_area(r, i) > share * area(i))


def with_coordinates(results: DataFrame, items: DataFrame, words: DataFrame) -> DataFrame:
    """Results (pdf_name, page0, answer, ...) with the place of the first item, by item_id, that contains the answer: that
    of the word where it begins, as shares of the page. Null where none does.

    items: (pdf_name, page0, item_id, txt, page_width, page_height); words: (pdf_name, page0, item_id, word_idx, x0, y0).
    """
    from ..functions.positions import word_index

    keys = ["pdf_name", "page0"]
    asked = results.select(*keys, "answer").where("answer is not null and answer <> ''").distinct()
    hits = asked.join(by_keys(items.select(*keys, "item_id", "txt", "page_width", "page_height")), keys).withColumn("_at", F.instr("txt", F.col("answer"))).where("_at > 0")
    first = hits.withColumn("_k", F.row_number().over(Window.partitionBy(*keys, "answer").orderBy("item_id"))).where("_k = 1")
    placed = first.withColumn("word_idx", word_index(F.col("txt"), F.col("_at") - 1)).join(by_keys(words.select(*keys, "item_id", "word_idx", "x0", "y0")), [*keys, "item_id", "word_idx"])
    place = placed.select(*keys, "answer", (F.col("x0") / F.col("page_width")).alias("pos_x"), (F.col("y0") / F.col("page_height")).alias("pos_y"))
    return results.join(by_keys(place), [*keys, "answer"], "left")


def matched_measures(expected: DataFrame, measured: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Expected and measured values of (kpi_id, src_file, year), each side once per key, with a verdict: TP, FP, FN or TN."""
    keys = ["kpi_id", "src_file", "year"]
    e = expected.groupBy(*keys).agg(F.min("value").alias("expected"), F.lit(1).alias("_e"))
    m = measured.groupBy(*keys).agg(F.min_by("value", F.struct(-F.col("score"), "value")).alias("measured"), F.lit(1).alias("_m"))
    both = e.join(m, keys, "full_outer")
    close = F.abs(F.col("expected").try_cast("double") - F.col("measured").try_cast("double")) < tolerance
    same = F.coalesce(close, F.col("expected") == F.col("measured"), F.lit(False))
    verdict = F.when(F.col("expected").isNull() & F.col("measured").isNull(), "TN").when(F.col("expected").isNull(), "FP").when(F.col("measured").isNull(), "FN").when(same, "TP").otherwise("FP")
    return both.select(*keys, "expected", "measured", verdict.alias("verdict"))
