"""Writers: CSV and JSON by report, training sets, tables and notes, workbooks, and replacing a report's rows."""

from __future__ import annotations

import io
import json
import uuid
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .objects import write_bytes

#: Characters that a report's name has in a database at most, and rows that a sheet holds, the header's included.
KEY_LENGTH, SHEET_ROWS = 1024, 1_048_576


def rule_csv(measures: DataFrame, path: str) -> None:
    """All cells quoted, quotes taken out, line breaks as spaces."""
    flat = measures.select(*[F.array_join(c, ",").alias(c) if t.startswith("array") else F.col(c).cast("string").alias(c) for c, t in measures.dtypes])
    plain = flat.select(*[F.translate(F.translate(c, '"', ""), "\n\r", "  ").alias(c) for c in flat.columns])
    plain.write.mode("overwrite").option("header", "true").option("quoteAll", "true").csv(path)


def by_report(df: DataFrame, path: str, key: str = "pdf_name") -> None:
    """A folder for each report; reports that are written again replace theirs and leave the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def replace_in_database(df: DataFrame, url: str, name: str, properties: dict[str, str], key: str = "PDF_NAME", numbers: tuple[str, ...] = (), post: str | None = None, run_id: str = "") -> None:
    """Puts the rows of df in the place of all rows of its reports in a table; empty texts of number columns become null.

    The executors write df to a table of its own first. Then one transaction in the database deletes the reports' old rows and
    takes over the new ones, so a run that fails at any point leaves the old rows as they were; the table of its own goes in
    either case. Rows of a null key are added. post: a command for afterwards, in which :RUN_ID stands for run_id.
    """
    clean = df.withColumns({c: F.nullif(F.col(c).cast("string"), F.lit("")).try_cast("double") for c in numbers})
    waiting = f"{name}_{uuid.uuid4().hex[:16]}"
    connect = df.sparkSession._jvm.java.sql.DriverManager.getConnection
    connection = connect(url, properties.get("user", ""), properties.get("password", ""))
    try:
        clean.write.option("createTableColumnTypes", f"{key} VARCHAR({KEY_LENGTH})").jdbc(url, waiting, properties=properties)
        quote = connection.getMetaData().getIdentifierQuoteString().strip()
        own = [f"{quote}{c}{quote}" for c in clean.columns]
        connection.setAutoCommit(False)
        command = connection.createStatement()
        try:
            command.executeUpdate(f"DELETE FROM {name} WHERE {key} IN (SELECT {quote}{key}{quote} FROM {waiting})")
            command.executeUpdate(f"INSERT INTO {name} ({', '.join(clean.columns)}) SELECT {', '.join(own)} FROM {waiting}")
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        if post:
            command.execute(post.replace(":RUN_ID", "'" + run_id.replace("'", "''") + "'"))
            connection.commit()
    finally:
        try:
            connection.setAutoCommit(True)
            if connection.getMetaData().getTables(None, None, waiting.upper(), None).next() or connection.getMetaData().getTables(None, None, waiting, None).next():
                connection.createStatement().execute(f"DROP TABLE {waiting}")
        finally:
            connection.close()


def by_report_csv(df: DataFrame, path: str, key: str = "pdf_name") -> None:
    """A CSV folder for each report, with header; line breaks inside cells are kept in quotes."""
    df.write.mode("overwrite").partitionBy(key).option("header", "true").option("quoteAll", "true").option("escape", '"').csv(path)


def training_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """A training set with a column of row numbers in front, which count within its files' order."""
    numbered = df.orderBy(*order).select(F.monotonically_increasing_id().alias("index"), *df.columns)
    numbered.write.mode("overwrite").option("header", "true").option("quoteAll", "true").option("escape", '"').csv(path)


def train_dev_csv(df: DataFrame, folder: str) -> None:
    """kpi_train_split.csv and kpi_val_split.csv of rows with split 'train' or 'dev'."""
    for part, name in (("train", "kpi_train_split.csv"), ("dev", "kpi_val_split.csv")):
        rows = df.where(F.col("split") == part).drop("split")
        rows.write.mode("overwrite").option("header", "true").option("quoteAll", "true").option("escape", '"').csv(f"{folder}/{name}")


def squad_files(nested: DataFrame, folder: str, day: str) -> list[str]:
    """kpi_<split>_<day> as one JSON text for each split of (split, pos, title, paragraphs), and reference_kpi_<split>_<day>.csv
    with a row an answer; a split without rows is not written. The names written."""
    from ..operators.reshape import flatten_squad, squad_document

    done = []
    for part in [r[0] for r in nested.select("split").distinct().orderBy("split").collect()]:
        own = nested.where(F.col("split") == part).drop("split")
        squad_document(own).write.mode("overwrite").text(f"{folder}/kpi_{part}_{day}.json")
        flatten_squad(own).write.mode("overwrite").option("header", "true").option("quoteAll", "true").option("escape", '"').csv(f"{folder}/reference_kpi_{part}_{day}.csv")
        done.append(part)
    return done


def predictions_json(predictions: DataFrame, path: str) -> None:
    """A JSON line for each title of inference.squad_predictions(): title and paragraphs, each with its context and qas (id, question,
    prediction, score), by context and id. A title's paragraphs are in one line, as in the file that asked."""
    qas = F.sort_array(F.collect_list(F.struct("id", "question", "prediction", "score"))).alias("qas")
    told = predictions.groupBy("title", "context").agg(qas).groupBy("title").agg(F.sort_array(F.collect_list(F.struct("context", "qas"))).alias("paragraphs"))
    told.write.mode("overwrite").json(path)


def page_cache(words: DataFrame, folder: str) -> None:
    """Keeps pages' words with their texts and cells, by document, so that later runs need not lay them out again."""
    from ..operators import layout

    for name, rows in (("words", words), ("texts", layout.page_texts(words)), ("cells", layout.table_cells(words))):
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")


def rule_json(measures: DataFrame, path: str) -> None:
    """kpi_measure rows as JSON lines that name their class."""
    measures.select(F.lit("KPIMeasure").alias("class"), *measures.columns).write.mode("overwrite").json(path)


def table_files(cells: DataFrame, folder: str) -> None:
    """tab_<page>_<n>: the lines of each table of layout.table_cells(), by document and table."""
    from ..operators.reshape import table_lines

    lines = table_lines(cells.where("role = 'cell'"), ["doc", "page", "table_id"])
    named = lines.select("doc", F.format_string("tab_%d_%d", "page", "table_id").alias("table"), "row", "line")
    named.repartition("doc", "table").sortWithinPartitions("doc", "table", "row").select("doc", "table", "line").write.mode("overwrite").partitionBy("doc", "table").text(folder)


def footnote_files(notes: DataFrame, folder: str) -> None:
    """footnotes_<page>: the notes of layout.footnotes(), by document and page."""
    named = notes.select("doc", F.format_string("footnotes_%d", "page").alias("page"), "n", "txt").repartition("doc", "page")
    named.sortWithinPartitions("doc", "page", "n").select("doc", "page", F.col("txt").alias("value")).write.mode("overwrite").partitionBy("doc", "page").text(folder)


def append_annotations(df: DataFrame, path: str) -> None:
    """Adds rows to those that are there."""
    df.write.mode("append").option("header", "true").option("quoteAll", "true").option("escape", '"').csv(path)


def resolved_files(resolved: DataFrame, path: str) -> None:
    """info.json: which file each wanted name stands for, from readers.resolve_names()."""
    resolved.select("source_file", "fixed_file").write.mode("overwrite").json(path)


def box_table(df: DataFrame, rows: int = 20, width: int = 100) -> str:
    """The first rows as a table in a box whose columns share the width; longer texts go on on further lines."""
    head = [list(df.columns)] + [["" if v is None else str(v).replace("\n", " ") for v in r] for r in df.limit(rows).collect()]
    longest = [max(len(r[c]) for r in head) for c in range(len(df.columns))]
    room = max(width - 3 * len(longest) - 1, 3 * len(longest))
    share = [min(n, max(3, room * n // max(sum(longest), 1))) if sum(longest) > room else n for n in longest]
    rule = "+" + "+".join("-" * (n + 2) for n in share) + "+"
    out = [rule]
    for row in head:
        cut = [[v[i : i + n] for i in range(0, len(v), n)] or [""] if n else [""] for v, n in zip(row, share)]
        for k in range(max(map(len, cut))):
            out.append("| " + " | ".join((c[k] if k < len(c) else "").ljust(n) for c, n in zip(cut, share)) + " |")
        out.append(rule)
    return "\n".join(out)


def workbook(rows: list[list[object]]) -> bytes:
    """An xlsx file with one sheet of texts and numbers; at most SHEET_ROWS rows, as the format has it."""
    if len(rows) > SHEET_ROWS:
        raise ValueError("more rows than a sheet holds")

    def cell(value: object) -> str:
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return f"<c><v>{value}</v></c>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape("" if value is None else str(value))}</t></is></c>'

    sheet = "".join(f"<row>{''.join(map(cell, row))}</row>" for row in rows)
    main, office = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="Sheet1" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{sheet}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + text)
    return out.getvalue()


def xlsx(df: DataFrame, path: str) -> None:
    """One workbook with a header row. A sheet is bounded, and so is what the driver gathers for it: more rows are an error."""
    rows = [list(r) for r in df.limit(SHEET_ROWS).toLocalIterator()]  # one more than fit below a header
    write_bytes(df.sparkSession, path, workbook([list(df.columns), *rows]))


def manifest(spark: SparkSession, path: str, **facts: object) -> None:
    """What a model is and how it did, as one JSON text."""
    write_bytes(spark, path, json.dumps(facts, indent=1, sort_keys=True, default=str).encode())


def page_json(values: DataFrame, path: str) -> None:
    """One JSON text for each report (pdf_name, value)."""
    values.write.mode("overwrite").partitionBy("pdf_name").text(path)


def semicolon_csv(df: DataFrame, path: str) -> None:
    """Semicolons between cells, all quoted, no line breaks inside."""
    flat = df.select(*[F.translate(F.col(c).cast("string"), "\n\r", "  ").alias(c) for c in df.columns])
    flat.write.mode("overwrite").option("header", "true").option("sep", ";").option("quoteAll", "true").option("escape", '"').csv(path)
