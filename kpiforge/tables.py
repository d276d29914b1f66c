"""The driver's tables as the relations of the engine: documents stand for reports, three lines for a page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.paragraphs import first_paragraphs, split_pages

LINES_A_PAGE = 3
#: An invented question list: id, question, sectors, whether the year is asked for, categories.
KPIS = (
    (0.0, "What is the company name?", "OG, CM", False, "TEXT"),
    (1.0, "In which year was the report written?", "OG, CM, CU", False, "TEXT"),
    (2.0, "What is the total of the reserves?", "OG", True, "TEXT, TABLE"),
    (2.1, "How are the oil and gas reserves?", "OG", True, "TEXT, TABLE"),
    (3.0, "What is the production of the plant?", "OG, CU", True, "TABLE"),
    (4.0, "Is that the aim of it?", "CM", False, "TEXT"),
    (5.0, "Was it for the people?", "CU", False, "TEXT, TABLE"),
    (6.0, "What are the emissions in scope one?", "OG, CM, CU", True, "TEXT, TABLE"),
    (7.0, "Was ist das Ziel der Firma?", "CM, CU", False, "TEXT"),
    (8.0, "Quelle est la part de la production?", "OG, CM", False, "TEXT"),
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kpis(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(KPIS, "kpi_id double, question string, sectors string, add_year boolean, kpi_category string")
    return rows.withColumns({c: F.transform(F.split(c, ","), lambda x: F.trim(x)) for c in ("sectors", "kpi_category")})


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pdf_name, page0, para_idx, text): every line of the documents, as it is."""
    docs = read(spark, sf_dir, "documents").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("pdf_name"), F.posexplode(F.split("text", "\n", -1)).alias("para_idx", "text"))
    return docs.select("pdf_name", F.floor(F.col("para_idx") / LINES_A_PAGE).cast("int").alias("page0"), "para_idx", "text")


def paragraphs(spark: SparkSession, sf_dir: str, first: bool = False) -> DataFrame:
    """(pdf_name, page0, para_idx, text): the documents' lines that are paragraphs, cleaned; first: the first of each row."""
    docs = read(spark, sf_dir, "documents").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("pdf_name"), "text")
    found = (first_paragraphs if first else split_pages)(docs, "\n", 30, ("pdf_name",))
    return found.select("pdf_name", F.floor(F.col("para_idx") / LINES_A_PAGE).cast("int").alias("page0"), "para_idx", "text")


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An invented annotation for each report: its first paragraph, whose third word is the answer to a KPI chosen by id.

    (ann_id, pdf_name, company, data_type, kpi_id text, year, source_page array<int> from 1, page0, answer, relevant_paragraphs)
    """
    docs = read(spark, sf_dir, "documents").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("pdf_name"), "doc_id", "source")
    first = paragraphs(spark, sf_dir, first=True).groupBy("pdf_name").agg(F.min_by(F.struct("page0", "text"), "para_idx").alias("p"))
    return docs.join(first, "pdf_name").select(
        F.col("doc_id").alias("ann_id"), "pdf_name", F.col("source").alias("company"), F.when(F.col("doc_id") % 5 == 4, "TABLE").otherwise("TEXT").alias("data_type"),
        (F.col("doc_id") % 12).cast("string").alias("kpi_id"), (F.col("doc_id") % 30 + 1990).cast("string").alias("year"), F.array(F.col("p.page0") + 1).alias("source_page"), F.col("p.page0").alias("page0"),
        F.get(F.split("p.text", " "), F.lit(2)).alias("answer"), F.concat(F.lit('["'), F.col("p.text"), F.lit('"]')).alias("relevant_paragraphs"),
    )
