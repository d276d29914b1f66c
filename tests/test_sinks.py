"""Files, databases, workbooks, settings, commands and services."""

from __future__ import annotations

import io
import json
import threading
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from kpiforge import cli, service
from kpiforge.config import Settings
from kpiforge.models import Answers, Relevance, answer_udf, chunks, relevance_udf
from kpiforge.operators import joins, metrics, paragraphs, reshape, sampling
from kpiforge.plans import inference
from kpiforge.sources import objects, readers, writers


@pytest.fixture()
def folder(tmp_path) -> str:
    return str(tmp_path)


def test_objects(spark, folder):
    objects.write_bytes(spark, f"{folder}/a/x.bin", b"\x00\x01")
    objects.write_bytes(spark, f"{folder}/a/b/y.txt", b"yes")
    objects.write_bytes(spark, f"{folder}/a/.hidden", b"no")
    assert objects.read_bytes(spark, f"{folder}/a/x.bin") == b"\x00\x01" and objects.exists(spark, f"{folder}/a") and not objects.exists(spark, f"{folder}/z")
    assert objects.copy_folder(spark, f"{folder}/a", f"{folder}/c") == ["b/y.txt", "x.bin"] and objects.copy_folder(spark, f"{folder}/a", f"{folder}/c", overwrite=False) == []
    df = spark.createDataFrame([(1, 'a "b"\nc'), (2, None)], "n int, t string")
    for kind in objects.FORMATS:
        objects.write_frame(df, f"{folder}/{kind}", kind)
        assert sorted((str(r["n"]), r["t"]) for r in objects.read_frame(spark, f"{folder}/{kind}", kind).collect()) == [("1", 'a "b"\nc'), ("2", None)], kind
    with pytest.raises(ValueError, match="no format"):
        objects.read_frame(spark, folder, "orc2")
    objects.write_bytes(spark, f"{folder}/other", b"")
    assert objects.claim(spark, f"{folder}/lock")
    objects.free(spark, f"{folder}/lock")
    assert objects.claim(spark, f"{folder}/lock")


def test_database_rows_of_reports_are_replaced(spark):
    url, properties = "jdbc:derby:memory:kpis;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    connection.createStatement().execute("CREATE TABLE results (PDF_NAME VARCHAR(99), KPI_ID DOUBLE, ANSWER CLOB)")
    connection.createStatement().execute("INSERT INTO results VALUES ('a.pdf', 1.0, 'old'), ('b.pdf', 2.0, 'stays')")
    new = spark.createDataFrame([("a.pdf", "", "new"), ("a.pdf", "3.5", "newer"), ("c.pdf", "4", None)], "PDF_NAME string, KPI_ID string, ANSWER string")
    writers.replace_in_database(new, url, "results", properties, numbers=("KPI_ID",), post="INSERT INTO results VALUES (:RUN_ID, NULL, 'post')", run_id="run'1")
    got = sorted(((r[0], r[1], r[2]) for r in spark.read.jdbc(url, "results", properties=properties).collect()), key=repr)
    assert got == sorted([("a.pdf", None, "new"), ("a.pdf", 3.5, "newer"), ("b.pdf", 2.0, "stays"), ("c.pdf", 4.0, None), ("run'1", None, "post")], key=repr)


def test_a_failed_replacement_leaves_the_old_rows(spark):
    url, properties = "jdbc:derby:memory:failing;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    connection.createStatement().execute("CREATE TABLE results (PDF_NAME VARCHAR(99), KPI_ID DOUBLE CHECK (KPI_ID < 100), ANSWER CLOB)")
    connection.createStatement().execute("INSERT INTO results VALUES ('a.pdf', 1.0, 'old'), ('b.pdf', 2.0, 'stays')")
    bad = spark.createDataFrame([("a.pdf", 3.0, "new"), ("a.pdf", 500.0, "too large")], "PDF_NAME string, KPI_ID double, ANSWER string")
    with pytest.raises(Exception, match="constraint"):
        writers.replace_in_database(bad, url, "results", properties)
    rows = lambda: sorted((r[0], r[1], r[2]) for r in spark.read.jdbc(url, "results", properties=properties).collect())
    assert rows() == [("a.pdf", 1.0, "old"), ("b.pdf", 2.0, "stays")]
    writers.replace_in_database(bad.where("KPI_ID < 100"), url, "results", properties)
    assert rows() == [("a.pdf", 3.0, "new"), ("b.pdf", 2.0, "stays")]
    tables = connection.getMetaData().getTables(None, None, "RESULTS%", None)
    assert tables.next() and not tables.next()  # nothing is left beside the table itself


def test_more_rows_than_a_sheet_holds_are_an_error(spark, folder, monkeypatch):
    monkeypatch.setattr(writers, "SHEET_ROWS", 4)
    writers.xlsx(spark.range(3), f"{folder}/fits.xlsx")
    assert len(readers.sheet_rows(objects.read_bytes(spark, f"{folder}/fits.xlsx"))) == 4
    with pytest.raises(ValueError, match="more rows"):
        writers.xlsx(spark.range(4), f"{folder}/more.xlsx")
    assert not objects.exists(spark, f"{folder}/more.xlsx")


def test_training_files(spark, folder):
    rows = spark.createDataFrame([(f"q{k % 3}", f'context "{k}"', k % 2, ["train", "dev"][k % 2]) for k in range(8)], "question string, context string, label int, split string")
    writers.training_csv(rows.drop("split"), f"{folder}/t", ["question", "context"])
    back = spark.read.option("header", "true").option("escape", '"').csv(f"{folder}/t")
    assert back.columns == ["index", "question", "context", "label"] and back.count() == 8 and back.select("index").distinct().count() == 8
    writers.train_dev_csv(rows, folder)
    assert spark.read.option("header", "true").csv(f"{folder}/kpi_train_split.csv").count() == spark.read.option("header", "true").csv(f"{folder}/kpi_val_split.csv").count() == 4
    nested = reshape.nest_squad(spark.createDataFrame([(0, "t", "c", "q", "a", [0]), (1, "t", "d", "r", "", [])], "pos int, title string, context string, question string, answer string, answer_starts array<int>"))
    assert writers.squad_files(nested.withColumn("split", F.lit("train")), folder, "2020-01-02") == ["train"] and not objects.exists(spark, f"{folder}/kpi_dev_2020-01-02.json")
    document = json.loads(spark.read.text(f"{folder}/kpi_train_2020-01-02.json").first()[0])
    assert document["version"] == "v2.0" and [p["context"] for p in document["data"][0]["paragraphs"]] == ["c", "d"]
    assert readers.squad_json(spark, f"{folder}/kpi_train_2020-01-02.json").first()["title"] == "t"


def test_rule_results_tables_and_notes(spark, folder):
    measures = spark.createDataFrame([(6.0, "scope 1", "a", 0, [1, 2], 0.1, 0.2, 'x "y"\nz', 2019, "5", 700.0, "t", "AT.direct")], readers.KPI_MEASURE)
    writers.rule_json(measures, f"{folder}/json")
    assert readers.rule_json(spark, f"{folder}/json").collect() == measures.collect()
    writers.rule_csv(measures, f"{folder}/csv")
    assert [r[0] for r in spark.read.text(f"{folder}/csv").where("not startswith(value, '\"kpi_id')").collect()] == ['"6.0","scope 1","a","0","1,2","0.1","0.2","x y z","2019","5","700.0","t","AT.direct"']
    cells = spark.createDataFrame([("d", 1, 0, r, c, t, "cell") for r, c, t in ((0, 0, "a"), (0, 1, 'b"'), (1, 1, "c"))], "doc string, page int, table_id int, row int, col int, txt string, role string")
    writers.table_files(cells, f"{folder}/tables")
    assert [r[0] for r in spark.read.text(f"{folder}/tables/doc=d/table=tab_1_0").collect()] == ['"a","b"""', '"","c"']
    notes = spark.createDataFrame([("d", 2, 1, "2) b"), ("d", 2, 0, "1) a")], "doc string, page int, n int, txt string")
    writers.footnote_files(notes, f"{folder}/notes")
    assert [r[0] for r in spark.read.text(f"{folder}/notes/doc=d/page=footnotes_2").collect()] == ["1) a", "2) b"]
    writers.semicolon_csv(measures.select("kpi_name", "raw_txt"), f"{folder}/semi")
    assert any(r[0] == '"scope 1";"x ""y"" z"' for r in spark.read.text(f"{folder}/semi").collect())
    for _ in range(2):
        writers.append_annotations(measures.select("kpi_id", "value"), f"{folder}/added")
    assert spark.read.option("header", "true").csv(f"{folder}/added").count() == 2
    writers.by_report_csv(measures.select("src_file", "value"), f"{folder}/by", "src_file")
    assert spark.read.option("header", "true").csv(f"{folder}/by/src_file=a").first()["value"] == "5"


def test_workbooks_boxes_and_manifests(spark, folder):
    df = spark.createDataFrame([(1, "a <b> & c"), (2, None)], "n int, t string")
    writers.xlsx(df, f"{folder}/w.xlsx")
    assert readers.sheet_rows(objects.read_bytes(spark, f"{folder}/w.xlsx")) == [["n", "t"], ["1", "a <b> & c"], ["2", ""]]
    box = writers.box_table(spark.createDataFrame([("x" * 50, 1)], "long string, n int"), width=30).split("\n")
    assert len({len(line) for line in box}) == 1 and len(box[0]) <= 30 and "".join(line[2:-2] for line in box if line.startswith("| x")).count("x") == 50
    writers.manifest(spark, f"{folder}/m.json", f1=0.5, name="relevance")
    assert json.loads(objects.read_bytes(spark, f"{folder}/m.json")) == {"f1": 0.5, "name": "relevance"}
    writers.resolved_files(spark.createDataFrame([("A.pdf", "a.pdf")], "source_file string, fixed_file string"), f"{folder}/info.json")
    assert json.loads(spark.read.text(f"{folder}/info.json").first()[0]) == {"source_file": "A.pdf", "fixed_file": "a.pdf"}


def test_relevance_results_and_aggregated_annotations(spark, folder):
    rows = spark.createDataFrame([("2", "r", "q1", "para b", "0.9", "Text"), ("1", "r", "q1", "para a", "0.8", "Text")], "page string, pdf_name string, text string, text_b string, paragraph_relevance_score string, source string")
    rows.write.option("header", "true").csv(f"{folder}/rel")
    got = [(r["page0"], r["para_idx"], r["kpi"], r["paragraph"], r["paragraph_relevance_score"]) for r in readers.relevance_csvs(spark, f"{folder}/rel").orderBy("para_idx").collect()]
    assert got == [(1, 0, "q1", "para a", 0.8), (2, 1, "q1", "para b", 0.9)]
    rows.drop("source").write.option("header", "true").csv(f"{folder}/bad")
    with pytest.raises(ValueError, match="source"):
        readers.relevance_csvs(spark, f"{folder}/bad")
    head = "company,source_file,source_page,kpi_id,year,answer,data_type,relevant_paragraphs"
    objects.write_bytes(spark, f"{folder}/ann/one.csv", f'{head},Sector\nC,a.pdf,"[1]",1,2019,x,TEXT,"[""p""]",OG\n'.encode())
    objects.write_bytes(spark, f"{folder}/ann/two.csv", f'{head},annotator\nD,b.pdf,"[2]",2,2018,y,TEXT,"[""q""]",me\n'.encode())
    for _ in range(2):  # built from the folder, then read
        agg = readers.aggregated_annotations(spark, f"{folder}/agg", f"{folder}/ann")
        assert sorted((r["company"], r["sector"], r["annotator"]) for r in agg.collect()) == [("C", "OG", "one.csv"), ("D", None, "me")]
    objects.write_bytes(spark, f"{folder}/old.csv", b"Number;company;source_file;year\n1;C;a.pdf;2019\n")
    assert readers.legacy_annotations(spark, f"{folder}/old.csv").first()["year"] == 2019
    objects.write_bytes(spark, f"{folder}/worse.csv", b"Number;company;source_file;year\n1;C;a.pdf;1066\n")
    with pytest.raises(Exception, match="no year"):
        readers.legacy_annotations(spark, f"{folder}/worse.csv").collect()
    there = spark.createDataFrame([("Alpha Report.pdf",), ("beta.pdf",)], "pdf_name string")
    wanted = spark.createDataFrame([("alpha report.PDF",), ("beta.pdf",), ("none.pdf",)], "source_file string")
    assert {r["source_file"]: r["fixed_file"] for r in readers.resolve_names(wanted, there).collect()} == {"alpha report.PDF": "Alpha Report.pdf", "beta.pdf": "beta.pdf", "none.pdf": None}
    assert readers.dummy_samples(spark.createDataFrame([("a.pdf",), ("b(1).pdf",)], "pdf_name string")).count() == 1


def test_cas_files(spark, folder):
    objects.write_bytes(spark, f"{folder}/doc.xmi", b'<r><custom:Answer xmlns:custom="c" begin="3" end="9" label="x"/><custom:Answer xmlns:custom="c" begin="10" end="12" label="y"/></r>')
    rows = readers.cas_annotations(spark, f"{folder}/doc.xmi", "custom:Answer")
    assert sorted((int(r["begin"]), int(r["end"])) for r in rows.collect()) == [(3, 9), (10, 12)]


def test_closest_paragraphs(spark):
    rows = spark.createDataFrame([("r", 0, "the exact part", "part", 1), ("r", 0, "emissions were 12 tonnes in totl", "12", 2), ("r", 1, "nowhere at all", "zzz", 3)], "pdf_name string, page0 int, paragraph string, answer string, n int")
    paras = spark.createDataFrame([("r", 0, 1, "so the exact part is here"), ("r", 0, 0, "all emissions were 12 tonnes in total"), ("r", 1, 0, "quite other words")], "pdf_name string, page0 int, para_idx int, text string")
    got = {r["n"]: r["context"] for r in joins.closest_paragraph(rows, paras, ["pdf_name", "page0"]).collect()}
    assert got == {1: "so the exact part is here", 2: "all emissions were 12 tonnes in total", 3: "nowhere at all"}


def test_models_see_the_question_and_come_in_chunks(spark):
    def load_answers():
        return lambda qs, ps: [([(q.split()[0], 2.0), ("no_answer", 1.5)] if q.split()[0] in p else [("no_answer", 3.0), (p.split()[0], 1.0)], 0.25) for q, p in zip(qs, ps)]

    paras = spark.createDataFrame([("r", 0, 0, "alpha is here"), ("r", 0, 1, "beta is there")], "pdf_name string, page0 int, para_idx int, text string")
    kpis = spark.createDataFrame([(1.0, "alpha ?"), (2.0, "gamma ?")], "kpi_id double, question string")
    relevant = Relevance(relevance_udf(lambda: lambda qs, ps: [1.0] * len(qs)))
    rows = inference.extract_answers(paras, kpis, relevant, Answers(answer_udf(load_answers))).orderBy("kpi_id", F.desc("score"), "answer").collect()
    facts = [(r["kpi_id"], r["answer"], r["score"], r["no_ans_score"], r["no_answer_score_plus_boost"], r["page0"]) for r in rows]
    assert facts == [(1.0, "alpha", 2.0, 16.5, 1.5, 0), (1.0, "beta", 1.0, 18.0, 3.0, 0), (2.0, "no_answer", 3.0, None, None, None), (2.0, "alpha", 1.0, 18.0, 3.0, 0), (2.0, "beta", 1.0, 18.0, 3.0, 0)]
    import pandas as pd

    assert [len(q) for q, _ in chunks(pd.Series(["q"] * 25), pd.Series(["p"] * 25), 10)] == [10, 10, 5]
    assert inference.single_pair(spark, "the total is given", "the total") == 1.0
    squad = spark.createDataFrame([("t", "a considerable amount", 1, "q"), ("t", "so", 2, "q")], "title string, context string, id int, question string")
    assert {r["id"]: r["prediction"] for r in inference.squad_predictions(squad).collect()} == {1: "considerable", 2: "no_answer"}
    scores = spark.createDataFrame([([("x", 5.0), ("no_answer", 2.0)], 9.0), ([("x", 5.0), ("y", 1.0)], 9.0)], "answers array<struct<answer:string,score:double>>, gap double")
    both = [tuple(r[0]) for r in scores.select(paragraphs.with_no_answer(F.col("answers"), F.col("gap"), -15.0)).collect()]
    assert both == [(17.0, 2.0), (11.0, -4.0)]


def test_choices_and_samples(spark):
    predictions = spark.createDataFrame([("r", "q", "b", 0, 0, "p", 0.5), ("r", "q", "a", 1, 0, "p", 0.9), ("s", "q", "c", 0, 0, "p", 1.0)], "pdf_name string, kpi string, answer string, page0 int, para_idx int, paragraph string, score double")
    assert [(r["rank"], r["answer"], r["page"]) for r in metrics.annotation_choices(predictions, "r", "q").orderBy("rank").collect()] == [(1, "a", 2), (2, "b", 1)]
    assert metrics.annotation_row("a", 2, "p", 0.9, 1) == {"answer": "a", "source_page": "[2]", "relevant_paragraphs": '["p"]', "score": 0.9, "rank": 1}
    assert metrics.annotation_row("typed", None, "", 0.0, None)["score"] == 100.0 and metrics.annotation_row("", None, "", 0.0, None)["rank"] == -1
    part = sampling.split_exactly(spark.range(10).withColumnRenamed("id", "k"), 0.0, 1, "k")
    assert part.where("split = 'train'").count() == 10


def test_settings():
    s = Settings.load('{"project": "p", "answers": {"no_ans_boost": -10}, "rules": {"only_kpis": [6.0]}}')
    assert s.answers.no_ans_boost == -10.0 and s.rules.only_kpis == (6.0,) and s.curation.seed == 42 and Settings.load(s.dump()) == s
    for bad in ('{"nothing": 1}', '{"answers": {"no_ans_boost": "-15"}}', '{"curation": {"seed": 1.5}}'):
        with pytest.raises(ValueError):
            Settings.load(bad)


_PAGE = '<img src="a.png" width="609" height="841">'


def _html(rows) -> bytes:
    divs = []
    for text, x, y in rows:
        spans, at = [], x
        for w in text.split(" "):
            spans.append(f"<!--BBox:({at},{y})-({at + 5 * len(w)},{y + 9})-->{w}")
            at += 5 * len(w) + 4
        divs.append(f'<div class="txt" style="x"><span id="f1" style="font-size:10px; color: rgba(0,0,0,1)">{"".join(spans)}</span></div>')
    return (_PAGE + "".join(divs)).encode()


def test_command_line_modes_and_service(spark, folder):
    cli.main(["setup", "--root", f"{folder}/project"])
    assert objects.exists(spark, f"{folder}/project/interim/pages") and Settings.load(objects.read_bytes(spark, f"{folder}/project/settings.json").decode()) == Settings()
    rows = [("2018", 400.0, 100.0), ("2019", 500.0, 100.0)]
    for k, label in enumerate(("Scope 1 direct GHG emissions", "Scope 2 indirect GHG emissions", "Water use")):
        rows += [(label, 50.0, 120.0 + 20 * k), (f"{3100 + k}", 400.0, 120.0 + 20 * k), (f"{3200 + k}", 500.0, 120.0 + 20 * k)]
    objects.write_bytes(spark, f"{folder}/pages/acme/page0.html", _html([("Greenhouse gas emissions in tonnes CO2e", 50.0, 60.0), *rows]))
    objects.write_bytes(spark, f"{folder}/ex/acme.json", json.dumps({"0": ["What is the total of the reserves is considerable indeed"]}).encode())
    objects.write_bytes(spark, f"{folder}/kpis.csv", b'kpi_id,question,sectors,add_year,kpi_category\n2,What is the total of the reserves?,"OG, CM",FALSE,TEXT\n')
    server = service.serve(spark, 0)
    port = server.server_address[1]
    threading.Thread(target=server.serve_forever, daemon=True).start()

    def call(path: str, body: dict | None = None) -> tuple[int, dict]:
        request = urllib.request.Request(f"http://127.0.0.1:{port}{path}", None if body is None else json.dumps(body).encode())
        try:
            with urllib.request.urlopen(request, timeout=240) as r:
                return r.status, json.load(r)
        except urllib.error.HTTPError as e:
            return e.code, json.load(io.BytesIO(e.read()))

    try:
        assert call("/liveness") == (200, {"alive": True}) and call("/running") == (200, {"running": False}) and call("/nothing")[0] == 404
        assert call("/infer", {"wrong": 1})[0] == 500
        code, said = call("/infer", {"out": f"{folder}/out", "extractions": f"{folder}/ex", "kpis": f"{folder}/kpis.csv", "pages": f"{folder}/pages", "mode": "both"})
        assert (code, said) == (200, {"done": "/infer"})
    finally:
        server.shutdown()
    result = spark.read.parquet(f"{folder}/out")
    by = {(r["METHOD"], r["KPI_ID"], r["KPI_YEAR"]): r["ANSWER"] for r in result.where("METHOD = 'KPI_EXTRACTION_RULE_BASED'").collect()}
    assert by["KPI_EXTRACTION_RULE_BASED", 6.0, 2018] == "3100" and by["KPI_EXTRACTION_RULE_BASED", 7.0, 2019] == "3201"
    assert result.where("METHOD = 'KPI_EXTRACTION_ML' and ANSWER = 'considerable'").count() == 1 and result.select("PDF_NAME").distinct().first()[0] == "acme.pdf"
    result.withColumn("POS_X", F.lit(None).cast("double")).write.parquet(f"{folder}/unplaced")
    placed = {(r["ANSWER"], r["PAGE"]): (r["POS_X"], r["POS_Y"]) for r in cli.locate(spark, f"{folder}/unplaced", f"{folder}/pages", f"{folder}/placed").where("METHOD = 'KPI_EXTRACTION_RULE_BASED'").withColumn("PAGE", F.lit(0)).collect()}
    assert objects.exists(spark, f"{folder}/placed") and placed
    assert cli.infer(spark, None, None, f"{folder}/none", [], mode="none") is None
    again = cli.infer(spark, f"{folder}/ex", f"{folder}/kpis.csv", f"{folder}/out", ["OG"])
    assert again.count() == 0  # the report is done


def test_words_near_the_question_answer_it(spark):
    """Against plain Python, over texts with repeated words, without words, and nulls."""
    import random
    import re

    from kpiforge.models import NearWords

    def plain(question, text, wide=5, least=0.2, many=2):
        split = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
        words, asked = split(text), set(split(question))
        best = {}
        for i, w in enumerate(words):
            n = sum(words[j] in asked for j in range(max(i - wide, 0), min(i + wide + 1, len(words))))
            if w not in asked and n:
                best[w] = max(best.get(w, 0), n)
        told = [(w, n / (2 * wide)) for w, n in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:many]]
        none = [("no_answer", least)]
        return (told + none if told and told[0][1] >= least else none + told)[:many]

    rng = random.Random(5)
    words = ["scope", "one", "emissions", "were", "4200", "tonnes", "in", "2019", "and", "Water", "use", "fell,"]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(0, 30))), " ".join(rng.choices(words, k=rng.randint(0, 5)))) for k in range(80)]
    rows += [(100, None, "scope"), (101, "scope one", None), (102, "", "")]
    model = NearWords()
    ready = model.prepared(spark.createDataFrame(rows, "k int, text string, question string"), "text")
    got = {r["k"]: [(a["answer"], pytest.approx(a["score"])) for a in r["f"]["answers"]] for r in ready.withColumn("f", model.found("text", "question")).collect()}
    assert {k: plain(q, t) for k, t, q in rows} == got
    assert sum(v[0][0] != "no_answer" for v in got.values()) > 20 and got[100] == got[101] == got[102] == [("no_answer", 0.2)]


def test_models_come_with_spark_and_are_built_once_in_a_worker(spark, tmp_path):
    import pandas as pd

    from kpiforge.models import by_length, shipped

    (tmp_path / "weights").mkdir()
    (tmp_path / "weights" / "word.txt").write_text("alpha")
    (tmp_path / "built").mkdir()
    log = str(tmp_path / "built")

    def build(folder):
        import os
        import uuid
        from pathlib import Path

        Path(log, f"{os.getpid()}-{uuid.uuid4().hex}").write_text("")
        word = Path(folder, "word.txt").read_text()
        return lambda questions, paragraphs: [float(word in p) + len(p) / 1000 for p in paragraphs]

    score = relevance_udf(shipped(spark, str(tmp_path / "weights"), build))
    df = spark.createDataFrame([("q", "alpha beta"), ("q", "b"), ("q", "no such word here"), ("q", "alpha")], "q string, p string").repartition(4)
    for _ in range(2):
        assert {r["p"]: r["s"] for r in df.select("p", score("q", "p").alias("s")).collect()} == {"alpha beta": 1.01, "b": 0.001, "no such word here": 0.017, "alpha": 1.005}
    made = [n.split("-")[0] for n in __import__("os").listdir(log)]
    assert made and len(made) == len(set(made))
    seen = []
    ask = lambda q, p: seen.append([len(x) for x in p]) or [x.upper() for x in p]
    assert by_length(pd.Series(["q"] * 4, index=[7, 3, 5, 9]), pd.Series(["ccc", "a", "dddd", "bb"], index=[7, 3, 5, 9]), ask, 2) == ["CCC", "A", "DDDD", "BB"] and seen == [[1, 2], [3, 4]]


def test_predictions_are_written_as_they_were_asked(spark, tmp_path):
    from kpiforge.models import NearWords

    squad = spark.createDataFrame([("t", "scope one emissions were 4200", 2, "scope one emissions?"), ("t", "scope one emissions were 4200", 1, "water"), ("u", "so", 3, "q")], "title string, context string, id int, question string")
    writers.predictions_json(inference.squad_predictions(squad, NearWords()), str(tmp_path / "p"))
    told = {r["title"]: [(q["id"], q["prediction"]) for p in r["paragraphs"] for q in p["qas"]] for r in spark.read.json(str(tmp_path / "p")).collect()}
    assert told == {"t": [(1, "no_answer"), (2, "4200")], "u": [(3, "no_answer")]}
