"""Readers of reports, extracted text, annotations, question lists and positioned pages."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import file_stem
from ..operators.filters import require
from ..operators.paragraphs import split_pages
from ..operators.reshape import pages_from_json
from ..schemas import KPI_MEASURE
from .objects import exists

Decoder = Callable[[bytes], list[str]]


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """(pdf_name, path, content) of all PDF files below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("pdf_name"), "path", "content")


def decoded(files: DataFrame, decode: Decoder) -> DataFrame:
    """(pdf_name, page0, text, error): decode gives a file's pages; of a file that it cannot read one row says
    why, without a page. A file without pages has no row."""

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content in zip(batch["pdf_name"], batch["content"]):
                try:
                    rows += [(name, k, t, None) for k, t in enumerate(decode(bytes(content)))]
                except Exception as problem:  # noqa: BLE001  whatever a decoder raises, the other files go on
                    rows.append((name, None, None, f"{type(problem).__name__}: {problem}"))
            yield pd.DataFrame(rows, columns=["pdf_name", "page0", "text", "error"]).astype({"page0": "Int32"})

    return files.select("pdf_name", "content").mapInPandas(pages, "pdf_name string, page0 int, text string, error string")


def pdf_pages(files: DataFrame, decode: Decoder) -> DataFrame:
    """(pdf_name, page0, text): decode gives a file's pages; a file that it cannot read gives none."""
    return decoded(files, decode).where("error is null").drop("error")


def paragraphs_of(files: DataFrame, decode: Decoder, min_letters: int = 30) -> DataFrame:
    """Paragraphs of PDF files."""
    return split_pages(pdf_pages(files, decode), min_letters=min_letters)


def extracted_json(spark: SparkSession, folder: str) -> DataFrame:
    """Paragraphs of '<stem>.json' files of pages; files named table_meta are not read."""
    files = spark.read.option("wholetext", "true").option("pathGlobFilter", "*.json").text(folder).select(file_stem(F.input_file_name()).alias("pdf_name"), "value")
    return pages_from_json(files.where(~F.contains("pdf_name", F.lit("table_meta"))))


def kpi_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The question list of a CSV file."""
    rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
    listed = {c: F.transform(F.split(c, ","), lambda x: F.trim(x)) for c in ("sectors", "kpi_category")}
    out = rows.select(F.col("kpi_id").try_cast("double").alias("kpi_id"), "question", *[v.alias(k) for k, v in listed.items()], F.coalesce(F.upper("add_year") == "TRUE", F.lit(False)).alias("add_year"))
    return out.where("kpi_id is not null").select("kpi_id", "question", "sectors", "add_year", "kpi_category")


def annotation_csvs(spark: SparkSession, folder: str, required: tuple[str, ...] = ("company", "source_file", "source_page", "kpi_id", "year", "answer", "data_type", "relevant_paragraphs")) -> DataFrame:
    """All annotation CSVs of a folder as one: columns by name, Sector as sector, the file's name as annotator if it has none."""
    names = [r["name"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select(F.col("path").alias("name")).toLocalIterator()]
    out = None
    for name in sorted(names):  # one schema for each file; the number of annotators is small
        rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(name)
        if "Sector" in rows.columns and "sector" not in rows.columns:
            rows = rows.withColumnRenamed("Sector", "sector")
        missing = [c for c in required if c not in rows.columns]
        if missing:
            raise ValueError(f"{name}: missing columns {', '.join(missing)}")
        if "annotator" not in rows.columns:
            rows = rows.withColumn("annotator", F.lit(name.rsplit("/", 1)[-1]))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no CSV file in {folder}")
    return out


def aggregated_annotations(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """The aggregated annotations of a file if it is there, else those of a folder's CSV files, which are written to it."""
    if not exists(spark, path):
        annotation_csvs(spark, folder).write.option("header", "true").option("quoteAll", "true").option("escape", '"').csv(path)
    return spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)


#: The columns of a relevance result.
RELEVANCE = ("page", "pdf_name", "text", "text_b", "paragraph_relevance_score", "source")


def relevance_csvs(spark: SparkSession, folder: str) -> DataFrame:
    """(pdf_name, page0, para_idx, kpi, paragraph, paragraph_relevance_score) of a folder's relevance results; a file that
    lacks a column is an error. para_idx counts a report's rows in order of page and paragraph."""
    rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(folder)
    rows = require(rows, list(RELEVANCE))
    order = Window.partitionBy("pdf_name").orderBy(F.col("page").try_cast("int"), "text_b", "text")
    return rows.select(
        "pdf_name", F.col("page").try_cast("int").alias("page0"), (F.row_number().over(order) - 1).alias("para_idx"), F.col("text").alias("kpi"), F.col("text_b").alias("paragraph"),
        F.col("paragraph_relevance_score").try_cast("double").alias("paragraph_relevance_score"),
    )


def page_cache(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Words, texts and cells of pages that writers.page_cache() has kept."""
    return {name: spark.read.parquet(f"{folder}/{name}") for name in ("words", "texts", "cells")}


def rule_json(spark: SparkSession, path: str) -> DataFrame:
    """kpi_measure rows of a rule result's JSON lines."""
    return spark.read.schema(f"class string, {KPI_MEASURE}").json(path).where(F.col("class") == "KPIMeasure").drop("class")


def legacy_annotations(spark: SparkSession, path: str) -> DataFrame:
    """The older annotation CSVs, of fourteen columns with commas or twelve with semicolons, by their header."""
    head = spark.read.text(path).first()
    sep = ";" if head and head[0].count(";") > head[0].count(",") else ","
    rows = spark.read.option("header", "true").option("sep", sep).option("multiLine", "true").option("escape", '"').csv(path)
    year = F.col("year").try_cast("int")
    return rows.withColumn("year", F.when(year.isNull() | year.between(1980, 2099), year).otherwise(F.raise_error(F.concat(F.lit("no year: "), F.col("year")))))


def dummy_samples(files: DataFrame) -> DataFrame:
    """A sample for each report, names with brackets aside."""
    return files.where(~F.rlike("pdf_name", F.lit(r"[\[\]()]"))).select(F.col("pdf_name").alias("source_file"), F.lit(0.0).alias("kpi_id"), F.lit("TEXT").alias("data_type"))


def resolve_names(wanted: DataFrame, there: DataFrame) -> DataFrame:
    """wanted (source_file) with the file that is meant: the exact name, else the first of equal lower-cased stem, else null."""
    exact = there.select(F.col("pdf_name").alias("source_file"), F.col("pdf_name").alias("_exact")).distinct()
    loose = there.groupBy(F.lower(F.trim(file_stem(F.col("pdf_name")))).alias("_stem")).agg(F.min("pdf_name").alias("_loose"))
    out = wanted.withColumn("_stem", F.lower(F.trim(file_stem(F.col("source_file"))))).join(exact, "source_file", "left").join(loose, "_stem", "left")
    return out.withColumn("fixed_file", F.coalesce("_exact", "_loose")).drop("_stem", "_exact", "_loose")


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def sheet_rows(content: bytes, sheet: str | None = None) -> list[list[str | None]]:
    """The cells of a workbook's sheet, the first one unless it is named."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_NS}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        names = [s.get("name") for s in book.iter(f"{_NS}sheet")]
        if sheet is not None and sheet not in names:
            raise ValueError(f"no sheet {sheet}")
        number = names.index(sheet) + 1 if sheet is not None else 1
        rows = []
        for row in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{number}.xml")).iter(f"{_NS}row"):
            cells: dict[int, str | None] = {}
            for k, c in enumerate(row):
                letters = re.match("[A-Z]+", c.get("r") or "")
                at = k
                if letters:
                    at = 0
                    for x in letters[0]:
                        at = 26 * at + ord(x) - 64
                    at -= 1
                value = c.find(f"{_NS}v")
                inline = "".join(t.text or "" for t in c.iter(f"{_NS}t")) if c.get("t") == "inlineStr" else None
                text = value.text if value is not None else None
                cells[at] = shared[int(text)] if c.get("t") == "s" and text is not None else text if inline is None else inline
            rows.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
        return rows


class XlsxSource(DataSource):
    """spark.read.format("xlsx").option("path", file).option("sheet", name).load(): a workbook's sheet, all columns text.

    The first row has the names. The file is read with plain file access, so it must be on a path that all workers see.
    """

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _rows(self) -> list[list[str | None]]:
        with open(self.options["path"], "rb") as f:
            return sheet_rows(f.read(), self.options.get("sheet"))

    def schema(self) -> str:
        return ", ".join(f"`{c or f'c{k}'}` string" for k, c in enumerate(self._rows()[0]))

    def reader(self, schema) -> DataSourceReader:
        return _XlsxReader(self._rows(), len(schema))


class _XlsxReader(DataSourceReader):
    def __init__(self, rows: list[list[str | None]], width: int) -> None:
        self.rows, self.width = rows, width

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for row in self.rows[1:]:
            yield tuple((row + [None] * self.width)[: self.width])


def one_workbook(spark: SparkSession, folder: str) -> DataFrame:
    """The first sheet of the folder's only workbook (names with ~ or $ are lock files); several or none are an error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(folder).where(~F.rlike(F.element_at(F.split("path", "/"), -1), F.lit("^[~$]")))
    found = files.limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{'no' if not found else 'more than one'} workbook in {folder}")
    head, *rows = sheet_rows(bytes(found[0]["content"]))
    width = len(head)
    return spark.createDataFrame([tuple((r + [None] * width)[:width]) for r in rows], ", ".join(f"`{c}` string" for c in head))


# ---- positioned pages -----------------------------------------------------------------------------------------------

_FONT = re.compile(r"#f(\d+)\s*\{([^}]*)\}")
_DIV = re.compile(r'<div[^>]*class="txt"[^>]*>(.*?)</div>', re.S)
_SPAN = re.compile(r'<span[^>]*id="f(\d+)"[^>]*style="([^"]*)"[^>]*>(.*?)</span>', re.S)
_WORD = re.compile(r"<!--BBox:\(([-0-9.]+),([-0-9.]+)\)-\(([-0-9.]+),([-0-9.]+)\)-->([^<]*)")
_PAGE = re.compile(r'<img[^>]*width="(\d+)"[^>]*height="(\d+)"')
WORDS = "doc string, page int, item_id int, word_idx int, txt string, x0 double, y0 double, x1 double, y1 double, font string, font_size int, is_bold boolean, brightness double, page_width double, page_height double"


def parse_page(html: str) -> list[tuple]:
    """Words of a positioned page: item and word numbers, text, box, font, size, weight, brightness, page size."""
    size = _PAGE.search(html)
    width, height = (float(size[1]), float(size[2])) if size else (0.0, 0.0)
    bold = {f for f, rule in _FONT.findall(html) if "bold" in rule.lower()}
    out = []
    for item, div in enumerate(_DIV.findall(html)):
        k = 0
        for font, style, body in _SPAN.findall(div):
            points = re.search(r"font-size:\s*(\d+)", style)
            color = re.search(r"rgba?\((\d+),\s*(\d+),\s*(\d+)", style)
            brightness = sum(map(int, color.groups())) / 765 if color else 0.0
            for x0, y0, x1, y1, text in _WORD.findall(body):
                box = float(x0), float(y0), float(x1), float(y1)
                if text.strip() and box[2] > box[0] and box[3] > box[1]:
                    out.append((item, k, text.strip(), *box, f"f{font}", int(points[1]) if points else 0, font in bold, brightness, width, height))
                    k += 1
    return out


def page_words(pages: DataFrame) -> DataFrame:
    """The words of positioned pages (doc, page, html)."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in WORDS.split(", ")]
        for batch in batches:
            yield pd.DataFrame([(d, p, *w) for d, p, h in zip(batch["doc"], batch["page"], batch["html"]) for w in parse_page(h or "")], columns=names)

    return pages.select("doc", "page", "html").mapInPandas(parse, WORDS)


def page_items(words: DataFrame) -> DataFrame:
    """Items of words: their joined text and the box around them."""
    ordered = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("word_idx", "txt"))), lambda w: w["txt"]), " ")
    first = lambda c: F.min_by(c, "word_idx").alias(c)
    return words.groupBy("doc", "page", "item_id").agg(
        ordered.alias("txt"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), *[first(c) for c in ("font", "font_size", "is_bold", "brightness", "page_width", "page_height")]
    )


def squad_json(spark: SparkSession, path: str) -> DataFrame:
    """Titles and paragraphs of reading-comprehension files."""
    from ..schemas import SQUAD

    return spark.read.schema(SQUAD).option("multiLine", "true").json(path).select(F.posexplode("data").alias("pos", "d")).select("pos", "d.title", "d.paragraphs")


def cas_annotations(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """Annotations of a CAS XMI file with attributes begin and end, by element name."""
    return spark.read.format("xml").option("rowTag", tag).option("attributePrefix", "").load(path)
