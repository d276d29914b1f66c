"""python -m kpiforge.cli setup|extract|curate|infer|rules|evaluate|serve ...: the plans over folders, without services between them."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Settings
from .operators.filters import not_done, questions_for
from .operators.joins import with_coordinates
from .operators.reshape import joined_result
from .plans.curation import clean_annotations, relevance_examples
from .plans.inference import extract_answers
from .plans.rule_based import report_measures
from .rules.catalogue import ACTIVE
from .schemas import RESULT
from .sources import objects, writers
from .sources.readers import annotation_csvs, extracted_json, kpi_mapping, page_items, page_words
from .sources.writers import by_report

#: Folders of a project.
FOLDERS = ("input/pdfs/training", "input/pdfs/inference", "input/annotations", "input/kpi_mapping", "interim/extraction", "interim/pages", "interim/curation", "models", "output")


def setup(spark: SparkSession, root: str, settings: Settings | None = None) -> None:
    """A project's folders, and its settings if it has none."""
    for folder in FOLDERS:
        objects.write_bytes(spark, f"{root}/{folder}/.keep", b"")
    if not objects.exists(spark, f"{root}/settings.json"):
        objects.write_bytes(spark, f"{root}/settings.json", (settings or Settings()).dump().encode())


def positioned(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the positioned pages '<report>/<page>.html' of a folder; the report is the folder, the page the number."""
    files = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").text(folder)
    parts = F.split(F.input_file_name(), "/")
    page = F.regexp_extract(F.element_at(parts, -1), "[0-9]+", 0).try_cast("int")
    return page_words(files.select(F.element_at(parts, -2).alias("doc"), F.coalesce(page, F.lit(0)).alias("page"), F.col("value").alias("html")))


def infer(
    spark: SparkSession, extractions: str | None, kpis: str | None, out: str, sectors: list[str], skip_done: bool = True, pages: str | None = None, mode: str = "ML", settings: Settings | None = None
) -> DataFrame | None:
    """The joined result of all reports, written by report. mode: ML, RB, both or none; the rule path needs pages.

    With skip_done, reports that have a result are skipped.
    """
    settings = settings or Settings()
    done = None
    if skip_done and objects.exists(spark, out):
        done = spark.read.parquet(out).select(F.regexp_replace("PDF_NAME", r"\.pdf$", "").alias("pdf_name"))
    model = rules = None
    if mode in ("ML", "both"):
        paragraphs = extracted_json(spark, extractions)
        paragraphs = paragraphs if done is None else not_done(paragraphs, done, "pdf_name")
        model = extract_answers(paragraphs, questions_for(kpi_mapping(spark, kpis), sectors), threshold=settings.relevance.threshold, k=settings.answers.top_k, boost=settings.answers.no_ans_boost)
    if mode in ("RB", "both"):
        words = positioned(spark, pages)
        words = words if done is None else not_done(words, done.withColumnRenamed("pdf_name", "doc"), "doc")
        wanted = [r for r in ACTIVE if not settings.rules.only_kpis or r.kpi_id in settings.rules.only_kpis]
        found = report_measures(words, wanted, settings.rules.default_year, settings.rules.clusters, settings.rules.ignore_years, settings.rules.two_pages)
        rules = found.withColumn("src_file", F.concat("src_file", F.lit(".pdf")))
    if model is None and rules is None:
        return None
    result = joined_result(rules, model)
    by_report(result, out, "PDF_NAME")
    return result


def curate(spark: SparkSession, annotations: str, extractions: str, kpis: str, out: str, ratio: int, seed: int) -> DataFrame:
    """The relevance model's training set."""
    questions = kpi_mapping(spark, kpis)
    clean = clean_annotations(annotation_csvs(spark, annotations), questions)
    named = clean.withColumn("pdf_name", F.regexp_replace("source_file", r"\.pdf$", "")).withColumn("ann_id", F.xxhash64("source_file", "kpi_id", "year", "answer", "relevant_paragraphs"))
    result = relevance_examples(named, extracted_json(spark, extractions), questions, ratio, seed)
    result.write.mode("overwrite").parquet(out)
    return result


def locate(spark: SparkSession, results: str, pages: str, out: str) -> DataFrame:
    """Results with the places of their answers where they have none, from positioned pages."""
    words = positioned(spark, pages)
    named = {"doc": "pdf_name", "page": "page0"}
    rows = spark.read.parquet(results).withColumnsRenamed({"POS_X": "_x", "POS_Y": "_y", "PDF_NAME": "_file"})
    rows = rows.withColumns({"pdf_name": F.regexp_replace("_file", r"\.pdf$", ""), "page0": (F.col("PAGE") - 1).cast("int")}).withColumnRenamed("ANSWER", "answer")
    placed = with_coordinates(rows, page_items(words).withColumnsRenamed(named), words.withColumnsRenamed(named))
    own = {"PDF_NAME": F.col("_file"), "ANSWER": F.col("answer"), "POS_X": F.coalesce("_x", "pos_x"), "POS_Y": F.coalesce("_y", "pos_y")}
    result = placed.select(*[own.get(c, F.col(c)).alias(c) for c in RESULT])
    result.write.mode("overwrite").parquet(out)
    return result


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="kpiforge", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    one = sub.add_parser("infer")
    one.add_argument("--sectors", default="OG,CM,CU")
    one.add_argument("--mode", choices=("RB", "ML", "both", "none"), default="ML")
    one.add_argument("--pages")
    one.add_argument("--settings")
    two = sub.add_parser("curate")
    two.add_argument("--annotations", required=True)
    two.add_argument("--ratio", type=int, default=1)
    two.add_argument("--seed", type=int, default=42)
    for p in (one, two):
        for name in ("extractions", "kpis"):
            p.add_argument(f"--{name}", required=p is two)
        p.add_argument("--out", required=True)
    three = sub.add_parser("setup")
    three.add_argument("--root", required=True)
    four = sub.add_parser("show")
    four.add_argument("--path", required=True)
    five = sub.add_parser("serve")
    five.add_argument("--port", type=int, default=2000)
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("kpiforge").getOrCreate()
    if a.command == "infer":
        settings = Settings.load(objects.read_bytes(spark, a.settings).decode()) if a.settings else None
        infer(spark, a.extractions, a.kpis, a.out, a.sectors.split(","), pages=a.pages, mode=a.mode, settings=settings)
    elif a.command == "curate":
        curate(spark, a.annotations, a.extractions, a.kpis, a.out, a.ratio, a.seed)
    elif a.command == "setup":
        setup(spark, a.root)
    elif a.command == "show":
        print(writers.box_table(spark.read.parquet(a.path)))
    else:
        from .service import serve

        serve(spark, a.port).serve_forever()


if __name__ == "__main__":
    main()
