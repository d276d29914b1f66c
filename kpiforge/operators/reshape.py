"""Unions, nesting and flattening."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import RESULT, RESULT_TYPES


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows, columns matched by name, missing ones null."""
    if not frames:
        raise ValueError("nothing to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def as_result(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df as rows of the joined result: the columns given, and null for the others."""
    return df.select(*[columns.get(c, F.lit(None)).cast(RESULT_TYPES.get(c, "string")).alias(c) for c in RESULT])


def joined_result(rule_based: DataFrame | None, model_based: DataFrame | None) -> DataFrame:
    """Both paths' results as one relation of the result's columns; a path may be missing.

    rule_based: kpi_measure rows; model_based: kpi predictions with page0 as text or number, which become page + 1, -1 if
    it is no number, and names without '.pdf', which they get.
    """
    frames = []
    if rule_based is not None:
        frames.append(as_result(rule_based, {
            "METHOD": F.lit("KPI_EXTRACTION_RULE_BASED"), "PDF_NAME": F.col("src_file"), "KPI_ID": F.col("kpi_id"), "KPI_NAME": F.col("kpi_name"), "KPI_DESC": F.col("kpi_name"),
            "ANSWER_RAW": F.col("value"), "ANSWER": F.col("value"), "PAGE": F.col("page_num"), "PARAGRAPH": F.col("raw_txt"), "POS_X": F.col("pos_x"), "POS_Y": F.col("pos_y"),
            "KPI_SOURCE": F.lit("TABLE"), "SCORE": F.col("score"), "KPI_YEAR": F.col("year"), "UNIT_RAW": F.col("unit"), "UNIT": F.col("unit"),
        }))
    if model_based is not None:
        frames.append(as_result(model_based, {
            "METHOD": F.lit("KPI_EXTRACTION_ML"), "PDF_NAME": F.concat("pdf_name", F.lit(".pdf")), "KPI_ID": F.col("kpi_id"), "KPI_NAME": F.col("kpi"), "KPI_DESC": F.col("kpi"),
            "ANSWER_RAW": F.col("answer"), "ANSWER": F.col("answer"), "PAGE": F.coalesce(F.col("page0").cast("string").try_cast("double").cast("int") + 1, F.lit(-1)), "PARAGRAPH": F.col("paragraph"),
            "PARAGRAPH_RELEVANCE_SCORE": F.col("paragraph_relevance_score"), "KPI_SOURCE": F.col("source"), "SCORE": F.col("score"),
            "NO_ANS_SCORE": F.col("no_ans_score"), "SCORE_PLUS_BOOST": F.col("no_answer_score_plus_boost"),
        }))
    return union_all(frames)


def nest_squad(rows: DataFrame) -> DataFrame:
    """(title, paragraphs) nested as for reading comprehension, all in order of pos.

    rows: (pos, title, context, question, answer, answer_starts array<int>); without starts a question is impossible.
    """
    qas = F.struct(
        F.col("pos").cast("long").alias("id"), "question", (F.coalesce(F.size("answer_starts"), F.lit(0)) <= 0).alias("is_impossible"),
        F.coalesce(F.transform("answer_starts", lambda s: F.struct(F.col("answer").alias("text"), s.alias("answer_start"))), F.array().cast("array<struct<text:string,answer_start:int>>")).alias("answers"),
    )
    by_context = rows.groupBy("title", "context").agg(F.min("pos").alias("pos"), F.sort_array(F.collect_list(qas)).alias("qas"))
    by_title = by_context.groupBy("title").agg(F.min("pos").alias("pos"), F.sort_array(F.collect_list(F.struct("pos", "context", "qas"))).alias("p"))
    return by_title.select("pos", "title", F.transform("p", lambda p: F.struct(p["context"].alias("context"), p["qas"].alias("qas"))).alias("paragraphs"))


def squad_document(nested: DataFrame, version: str = "v2.0") -> DataFrame:
    """One JSON text with all titles. A training set's file is one document, so its rows meet in one task."""
    rows = nested.groupBy(F.lit(version).alias("version")).agg(F.sort_array(F.collect_list(F.struct("pos", "title", "paragraphs"))).alias("d"))
    return rows.select(F.to_json(F.struct("version", F.transform("d", lambda d: F.struct(d["title"].alias("title"), d["paragraphs"].alias("paragraphs"))).alias("data"))).alias("value"))


def flatten_squad(nested: DataFrame) -> DataFrame:
    """(title, context, id, question, is_impossible, answer, answer_start): a row for each answer, one for none."""
    contexts = nested.select("title", F.explode("paragraphs").alias("p")).select("title", "p.context", F.explode("p.qas").alias("q"))
    answers = contexts.select("title", "context", "q.id", "q.question", "q.is_impossible", F.explode_outer("q.answers").alias("a"))
    return answers.select("title", "context", "id", "question", "is_impossible", F.col("a.text").alias("answer"), F.col("a.answer_start").alias("answer_start"))


def slice_squad(nested: DataFrame, chosen: DataFrame) -> DataFrame:
    """Only the paragraphs at chosen (title, index) pairs, index from 0; titles without any go."""
    keep = chosen.groupBy("title").agg(F.collect_set("index").alias("_keep"))
    some = F.filter(F.transform("paragraphs", lambda p, i: F.struct(p.alias("p"), i.alias("i"))), lambda x: F.array_contains(F.col("_keep"), x["i"]))
    out = nested.join(keep, "title").withColumn("paragraphs", F.transform(some, lambda x: x["p"]))
    return out.where(F.size("paragraphs") > 0).select(nested.columns)


def answerable(nested: DataFrame, wanted: bool = True) -> DataFrame:
    """Only the questions that can, or cannot, be answered; paragraphs and titles without any go."""
    some = F.transform("paragraphs", lambda p: F.struct(p["context"].alias("context"), F.filter(p["qas"], lambda q: q["is_impossible"] != wanted).alias("qas")))
    return nested.withColumn("paragraphs", F.filter(some, lambda p: F.size(p["qas"]) > 0)).where(F.size("paragraphs") > 0)


def pages_to_json(paragraphs: DataFrame) -> DataFrame:
    """(pdf_name, value): a JSON text of each report's paragraphs by page, pages as keys from '0'."""
    pages = paragraphs.groupBy("pdf_name", "page0").agg(F.sort_array(F.collect_list(F.struct("para_idx", "text"))).alias("p"))
    entries = F.sort_array(F.collect_list(F.struct("page0", F.transform("p", lambda x: x["text"]).alias("texts"))))
    rows = pages.groupBy("pdf_name").agg(entries.alias("e"))
    return rows.select("pdf_name", F.to_json(F.map_from_entries(F.transform("e", lambda x: F.struct(x["page0"].cast("string").alias("k"), x["texts"].alias("v"))))).alias("value"))


def pages_from_json(files: DataFrame) -> DataFrame:
    """(pdf_name, page0, para_idx, text) of JSON texts (pdf_name, value)."""
    pages = files.select("pdf_name", F.explode(F.from_json("value", "map<string,array<string>>")).alias("page", "texts"))
    return pages.select("pdf_name", F.col("page").try_cast("int").alias("page0"), F.posexplode("texts").alias("para_idx", "text"))


def table_lines(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, row, line): a table's rows as CSV lines, cells by column, empty where there is none.

    Of several texts in a cell the first in order of the alphabet stands.
    """
    width = F.max("col").over(Window.partitionBy(*keys))
    rows = cells.groupBy(*keys, "row", "col").agg(F.min("txt").alias("txt")).withColumn("_w", width).groupBy(*keys, "row").agg(F.first("_w").alias("_w"), F.map_from_entries(F.collect_list(F.struct("col", "txt"))).alias("m"))
    quoted = F.transform(F.sequence(F.lit(0), F.col("_w")), lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(F.element_at("m", c), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')))
    return rows.select(*keys, "row", F.array_join(quoted, ",").alias("line"))
