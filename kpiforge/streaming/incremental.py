"""Reports as they come: a file stream that runs the batch plan on what is new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import file_stem
from ..operators.paragraphs import split_pages
from ..operators.reshape import pages_from_json
from ..sources.readers import Decoder, decoded
from ..sources.writers import by_report
from ..staging import staged


def new_extractions(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of (pdf_name, value) from '<stem>.json' files that appear in a folder."""
    files = spark.readStream.option("wholetext", "true").option("pathGlobFilter", "*.json").text(folder)
    return files.select(file_stem(F.input_file_name()).alias("pdf_name"), "value")


def run_on_new(spark: SparkSession, folder: str, plan: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Starts plan on the paragraphs of all files that the checkpoint has not seen; results replace their reports' rows in out.

    The same files give the same result however often a batch is repeated, since a report's rows are replaced whole.
    """

    def batch(files: DataFrame, _: int) -> None:
        by_report(plan(pages_from_json(files)), out)

    return new_extractions(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def new_pdfs(spark: SparkSession, folder: str, files_at_once: int | None = None) -> DataFrame:
    """A stream of (pdf_name, path, content) of PDF files that appear in a folder; files_at_once: at most so many in a batch."""
    reader = spark.readStream.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile").option("pathGlobFilter", "*.pdf")
    reader = reader if files_at_once is None else reader.option("maxFilesPerTrigger", files_at_once)
    return reader.load(folder).select(F.element_at(F.split("path", "/"), -1).alias("pdf_name"), "path", "content")


def run_on_new_pdfs(
    spark: SparkSession, folder: str, decode: Decoder, plan: Callable[[DataFrame], DataFrame], out: str, rejected: str, checkpoint: str, files_at_once: int | None = None, min_letters: int = 30
) -> StreamingQuery:
    """Starts plan on the paragraphs of all PDF files that the checkpoint has not seen; results replace their reports' rows in out.

    A file that decode cannot read stops nothing: it has a row (error, path) under its name in rejected. Each file is decoded
    once, and a batch that is repeated after a failure leaves the same rows in both tables. Files of one name in different
    folders are one report. Spark's file sources pass over files of no bytes, so these are in neither table.
    """

    def batch(files: DataFrame, _: int) -> None:
        pages = staged(decoded(files, decode), "pages")
        lost = pages.where("error is not null").join(files.select("pdf_name", "path"), "pdf_name")
        by_report(plan(split_pages(pages.where("error is null"), min_letters=min_letters)), out)
        by_report(lost.select("error", "path", "pdf_name"), rejected)

    stream = new_pdfs(spark, folder, files_at_once).writeStream.foreachBatch(batch)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
