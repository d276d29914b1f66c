"""Scalar functions and operators on small fixtures."""

from __future__ import annotations

import hashlib
import io
import json
import random
import re
import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kpiforge.functions import fuzzy, geometry, positions, shape, text
from kpiforge.operators import filters, joins, layout, metrics, paragraphs, ranking, reshape, sampling
from kpiforge.operators.rules import AnywhereRule, DescriptionRule, KpiRule, anywhere_scores, describe_lists
from kpiforge.plans import rule_based
from kpiforge.rules.catalogue import ACTIVE
from kpiforge.schemas import CAN_INCLUDE, MUST_EXCLUDE, MUST_INCLUDE, MUST_INCLUDE_EACH, WEIGHTED
from kpiforge.sources import readers


def _one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("value", "numeric", "year", "null_like"),
    [
        ("", False, False, True), ("-", True, False, True), ("12*", True, False, False), ("(12)", True, False, False), ("12%", True, False, False), ("%5", True, False, False), ("$5", True, False, False),
        ("1 000", True, False, False), ("1,234.5", True, False, False), ("1.234,5", True, False, False), ("1,23", True, False, False), ("WLTP", True, False, False), ("2019", True, True, False),
        ("FY2019", False, True, False), ("2018/19", False, True, False), ("31.12.2019", False, False, False), ("n/a", False, False, True), ("abc", False, False, False),
    ],
)
def test_shapes(spark, value, numeric, year, null_like):
    v = F.col("v")
    row = spark.createDataFrame([(value,)], "v string").select(shape.looks_numeric(v), shape.looks_year(v), shape.looks_null(v)).first()
    assert tuple(row) == (numeric, year, null_like)


def test_years_and_numbers(spark):
    v = F.col("v")
    assert _one(spark, "on 31.12.2019 then", shape.year_extended(v)) == 2019
    assert _one(spark, "2019/12/31", shape.year_extended(v)) == 2019
    assert _one(spark, "2018/19", shape.to_year(v)) == 2018
    assert _one(spark, "in 2018 and 2018", shape.year_in_text(v)) == 2018 and _one(spark, "2018 2019", shape.year_in_text(v)) is None
    assert _one(spark, "1.234.5 t", shape.cleanup_number(v)) == "1.2345" and _one(spark, "-7.9x", shape.to_int_number(v)) == -7
    assert _one(spark, "x", shape.to_float_number(v)) is None and _one(spark, "12.0", shape.int_or(v, -1)) == 12 and _one(spark, "", shape.number_or_null(v)) is None


def test_cleaning(spark):
    raw = "[“a”] “b”\n\tcafé\r x  y..."
    assert _one(spark, raw, text.clean_for_curation(F.col("v"))) == '["a"] b caf x y...'
    assert _one(spark, "A (b) c... D", text.clean_for_answers(F.col("v"))) == "a b c d"
    assert _one(spark, '["one", "two"]', text.paragraph_list(F.col("v"))) == ["one", "two"]
    assert _one(spark, '{"one","two"]', text.paragraph_list(F.col("v"))) == ["one", "two"]
    assert _one(spark, '["one"[', text.paragraph_list(F.col("v"))) == ["one"] and _one(spark, "plain", text.paragraph_list(F.col("v"))) is None
    assert _one(spark, "plain", text.sentence_list(F.col("v"))) == ["plain"] and _one(spark, "[broken", text.sentence_list(F.col("v"))) is None
    assert _one(spark, "[02, 5, x]", text.page_list(F.col("v"))) == [2, 5, None]
    assert _one(spark, " a,pdf", text.pdf_name(F.col("v"))) == "a.pdf" and _one(spark, "b", text.pdf_name(F.col("v"))) == "b.pdf"
    assert _one(spark, "What in year 2019?", text.question_key(F.col("v"))) == "What?" and _one(spark, "What?", text.with_year(F.col("v"), F.lit("2019.0"))) == "What in year 2019?"
    assert _one(spark, "x/y/z.q.pdf", text.file_stem(F.col("v"))) == "z.q" and _one(spark, "2.10", text.kpi_label(F.col("v"))) == "2.1"


def test_offsets(spark):
    df = spark.createDataFrame([("12", "12 and 912 and 3412 x"), ("a.b", "a.b axb a.b"), ("", "abc"), ("aa", "aaaa")], "a string, p string")
    got = [r["o"] for r in df.select(positions.answer_offsets(F.col("a"), F.col("p")).alias("o")).collect()]
    assert got == [[0, 8, 17], [0, 8], [], [0, 2]]
    assert _one(spark, "one two  three", positions.word_index(F.col("v"), F.lit(9))) == 2
    shifted = df.select(positions.shifted_from_start(positions.find_all(F.col("p"), F.col("a")), F.col("p")).alias("s")).collect()[1]["s"]
    assert shifted["offsets"] == [1, 9] and shifted["paragraph"].startswith(" a.b")


def test_geometry(spark):
    df = spark.createDataFrame([(0.0, 0.0, 10.0, 10.0, 5.0, 5.0, 15.0, 20.0), (0.0, 0.0, 1.0, 1.0, 4.0, 5.0, 6.0, 7.0)], "x0 double, y0 double, x1 double, y1 double, b_x0 double, b_y0 double, b_x1 double, b_y1 double")
    a, b = geometry.Rect.of(), geometry.Rect.of("b_")
    rows = df.select(geometry.intersection_area(a, b), geometry.gap(a, b)).collect()
    assert [tuple(r) for r in rows] == [(25.0, 0.0), (0.0, 5.0)]
    far = df.limit(1).select(geometry.weighted_distance(F.lit(0.0), F.lit(0.0), F.lit(3.0), F.lit(4.0), F.lit(0.1)), geometry.weighted_distance(F.lit(0.0), F.lit(0.0), F.lit(3.0), F.lit(4.0), F.lit(0.1), True)).first()
    assert far[0] == pytest.approx(90 * (9 + 0.0016) ** 0.5) and far[1] == -1


def test_description_rule_matches_plain_python(spark):
    nodes = ["Total Emissions here", "other", "emissions and more words", "emissions"]
    rule = DescriptionRule(".*emissions.*", 1000.0, decay=0.8, hit_decay=0.5, half_life=10, free_letters=9)
    got = spark.range(1).select(rule.match(F.array(*map(F.lit, nodes))).alias("m")).first()["m"]
    want, hits = 0.0, 0
    for i, t in enumerate(nodes):
        if re.match(rule.pattern, t.lower()):
            want += 1000 * 0.8**i * 0.5**hits * (0.5 ** (1 / 10)) ** max(len(re.sub("[^a-z ]", "", t)) - 9, 0)
            hits += 1
    assert got["ok"] and got["score"] == pytest.approx(want)
    for mode, pattern, expected in ((MUST_INCLUDE, ".*zebra.*", (False, 0.0)), (MUST_EXCLUDE, ".*other.*", (False, -1.0)), (MUST_EXCLUDE, ".*zebra.*", (True, 0.0))):
        m = spark.range(1).select(DescriptionRule(pattern, 5.0, mode).match(F.array(*map(F.lit, nodes))).alias("m")).first()["m"]
        assert (m["ok"], m["score"]) == expected


def _plain_rule(d, nodes):
    low = nodes if d.case else [t.lower() for t in nodes]
    worth = lambda t: d.score * d.letter_decay ** max(len(re.sub("[^a-z ]", "", t)) - d.free_letters, 0)
    joined = " ".join(nodes)
    one = d.joined and re.match(d.pattern, joined if d.case else joined.lower())
    score, hits = 0.0, 0
    for i, t in enumerate(low):
        if re.match(d.pattern, t):
            score += worth(nodes[i]) * d.decay**i * d.hit_decay**hits
            hits += 1
    if d.mode == MUST_EXCLUDE and hits:
        return False, -1.0
    if d.mode == MUST_INCLUDE_EACH and hits < len(nodes) and not one or d.mode == MUST_INCLUDE and not hits and not one:
        return False, 0.0
    return True, max(score, worth(joined) if one else 0.0)


def test_the_catalogue_matches_plain_python(spark):
    lists = [["Total proved and probable reserves", "Hydrocarbons"], ["Scope 1 direct GHG emissions", "Total"], ["oil production"], ["scope 2 indirect emissions (market based)"], ["nothing"], []]
    df = spark.createDataFrame([(k, n) for k, n in enumerate(lists)], "k int, nodes array<string>")
    for rule in ACTIVE:
        got = {r["k"]: tuple(r["m"]) for r in df.select("k", rule.describe(F.col("nodes")).alias("m")).collect()}
        for k, nodes in enumerate(lists):
            found = [_plain_rule(d, nodes) for d in rule.descriptions]
            bad = [s for ok, s in found if not ok]
            some = any(ok and s > 0 and d.counts and d.mode not in (CAN_INCLUDE, MUST_EXCLUDE) for (ok, s), d in zip(found, rule.descriptions))
            total = sum(s for _, s in found)
            want = (False, min([0.0, *bad])) if bad else (False, 0.0) if not some else (total >= 250, total)
            assert got[k][0] == want[0] and got[k][1] == pytest.approx(want[1], rel=1e-9), (rule.kpi_id, nodes)


def test_lists_are_described_as_rules_describe_them(spark):
    lists = [["Total proved and probable reserves", "Hydrocarbons"], ["Scope 1 direct GHG emissions", "Total"], ["oil production"], ["scope 2 indirect emissions (market based)"], ["nothing"], [], ["PRMS proved reserves", "total"]]
    df = spark.createDataFrame([(k, n) for k, n in enumerate(lists)], "list_id int, nodes array<string>")
    got = {(r["list_id"], r["kpi_id"]): (r["ok"], r["score"]) for r in describe_lists(df, list(ACTIVE)).collect()}
    for rule in ACTIVE:
        for r in df.select("list_id", rule.describe(F.col("nodes")).alias("m")).collect():
            ok, score = got.get((r["list_id"], rule.kpi_id), (False, 0.0))
            assert (ok, score) == (r["m"]["ok"], pytest.approx(r["m"]["score"], rel=1e-9)), (rule.kpi_id, r)
    assert any(ok for ok, _ in got.values())


def test_anywhere_rule(spark):
    values = spark.createDataFrame([(1, 1, 0.0, 0.0, 100.0), (1, 2, 50.0, 50.0, 100.0), (2, 1, 0.0, 0.0, 100.0)], "page int, item_id int, x double, y double, page_diag double")
    texts = spark.createDataFrame([(1, "Tonnes of CO2", 10.0, 0.0), (1, "tonnes", 50.0, 50.0)], "page int, txt string, x double, y double")
    rule = KpiRule(1.0, "k", (), anywhere=(AnywhereRule("tonnes.*", 100.0, MUST_INCLUDE, decay=0.5, hit_decay=0.5), AnywhereRule("nothing", 10.0, MUST_EXCLUDE, WEIGHTED)))
    got = {(r["page"], r["item_id"]): (r["anywhere_ok"], r["anywhere_score"]) for r in anywhere_scores(values, texts, rule, ["page"]).collect()}
    near = sorted((100 * 0.5 ** (d / 10) for d in (10.0, 50 * 2**0.5)), reverse=True)
    assert got[1, 1] == (True, pytest.approx(near[0] + 0.5 * near[1])) and got[2, 1] == (False, 0.0)


def test_direct_years(spark):
    table = [["", "2018", "2019"], ["Emissions", "", ""], ["scope one", "1,200", "1,100"], ["other", "7", "8"]]
    cells = spark.createDataFrame([("d", r, c, t) for r, row in enumerate(table) for c, t in enumerate(row) if t], "doc string, row int, col int, txt string")
    rule = KpiRule(6.0, "scope 1", (DescriptionRule(".*scope.*one.*", 600.0), DescriptionRule(".*emission.*", 200.0, decay=0.5)))
    rows = rule_based.direct_year_measures(cells, [rule], ["doc"]).orderBy("year").collect()
    assert [(r["year"], r["value"], r["score"]) for r in rows] == [(2018, "1,200", pytest.approx(1.2 * 800)), (2019, "1,100", pytest.approx(1.2 * 800))]
    assert rule_based.indirect_year_measures(cells.where("row > 0"), [rule], ["doc"], 2020).count() == 2


def test_ranks(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, None), ("a", 4, 1.0), ("b", 1, 2.0)], "k string, pos int, score double")
    assert [r["pos"] for r in ranking.top_k(df, ["k"], 2).where("k = 'a'").orderBy("pos").collect()] == [1, 2]
    m = df.withColumnRenamed("k", "kpi_name").withColumn("year", F.lit(2019))
    assert {r["pos"] for r in ranking.best_of_year(m).collect()} == {2, 1}
    runs = spark.createDataFrame([(1, i, y) for i, y in enumerate([2019, 2018, 2017, 5, 6, 7, 7, None, 8])], "k int, i int, y int")
    assert [r["run"] for r in ranking.step_runs(runs, ["k"], "i", "y").orderBy("i").collect()] == [1, 1, 1, 2, 2, 2, 3, 4, 5]
    answers = spark.createDataFrame([("q", 1, "no_answer", 3.0), ("q", 1, "no_answer", 4.0), ("r", 1, "no_answer", 1.0), ("r", 1, "x", 2.0)], "kpi string, rank int, answer string, score double")
    assert [tuple(r)[:3] for r in ranking.no_answers(answers, ["kpi"]).collect()] == [("q", "no_answer", 4.0)]
    years = spark.createDataFrame([("t", 0, 1, "2018"), ("t", 0, 2, "2019"), ("t", 0, 3, "2019"), ("t", 1, 1, "2018"), ("t", 1, 2, "77")], "t string, row int, col int, txt string")
    assert [(r["row"], r["year_cols"]) for r in ranking.year_cells(years, ["t"]).collect()] == [(0, {2018: 1, 2019: 2})]


def test_filters_and_joins(spark):
    a = spark.createDataFrame([(1, "TEXT", "CEZ", "p"), (2, "TEXT", None, "p"), (3, "TABLE", "x", "p"), (4, "TEXT", "x", None)], "id int, data_type string, company string, relevant_paragraphs string")
    assert [r["id"] for r in filters.text_annotations(a).collect()] == [2]
    with pytest.raises(ValueError, match="nope"):
        filters.require(a, ["id", "nope"])
    results = spark.createDataFrame([("d", 0, "two"), ("d", 0, "zzz")], "pdf_name string, page0 int, answer string")
    items = spark.createDataFrame([("d", 0, 7, "one two", 100.0, 200.0)], "pdf_name string, page0 int, item_id int, txt string, page_width double, page_height double")
    words = spark.createDataFrame([("d", 0, 7, 0, 10.0, 20.0), ("d", 0, 7, 1, 50.0, 20.0)], "pdf_name string, page0 int, item_id int, word_idx int, x0 double, y0 double")
    got = {r["answer"]: (r["pos_x"], r["pos_y"]) for r in joins.with_coordinates(results, items, words).collect()}
    assert got == {"two": (0.5, 0.1), "zzz": (None, None)}
    expected = spark.createDataFrame([(1.0, "f", 2019, "5"), (1.0, "f", 2018, "6"), (2.0, "f", None, None)], "kpi_id double, src_file string, year int, value string")
    measured = spark.createDataFrame([(1.0, "f", 2019, "5.00001", 1.0), (3.0, "f", 2019, "1", 1.0)], "kpi_id double, src_file string, year int, value string, score double")
    assert sorted(r["verdict"] for r in joins.matched_measures(expected, measured).collect()) == ["FN", "FP", "TN", "TP"]


def test_reshape_and_samples(spark):
    rows = spark.createDataFrame([("t", ["p", "q", "r"], [1, 2]), ("u", ["p", "q"], [5])], "id string, relevant_paragraphs array<string>, source_page array<int>")
    assert sorted(tuple(r) for r in paragraphs.zip_pages(rows).collect()) == [("t", 1, "p"), ("t", 2, "q"), ("u", 5, "p"), ("u", 5, "q")]
    qa = spark.createDataFrame([(1, "t", "c", "q1", "a", [3, 7]), (2, "t", "c", "q2", "", [])], "pos int, title string, context string, question string, answer string, answer_starts array<int>")
    nested = reshape.nest_squad(qa)
    assert sorted((r["id"], r["answer_start"], r["is_impossible"]) for r in reshape.flatten_squad(nested).collect() if r["answer_start"] is not None) == [(1, 3, False), (1, 7, False)]
    assert json.loads(reshape.squad_document(nested).first()["value"])["data"][0]["title"] == "t"
    assert reshape.flatten_squad(reshape.answerable(nested, False)).count() == 1
    parts = sampling.split(spark.range(1000), 0.3, 1, "id")
    assert 230 < parts.where("split = 'dev'").count() < 370 and parts.select("fold" if "fold" in parts.columns else "split").distinct().count() == 2
    counts = metrics.scores(spark.createDataFrame([(3, 1, 2, 4)], "tp long, fp long, fn long, tn long")).first()
    assert counts["precision"] == 0.75 and counts["recall"] == 0.6 and counts["f1"] == pytest.approx(2 / 3)
    assert reshape.joined_result(None, spark.createDataFrame([("d", "q", 1.0, "a", "x", "p", "Text", 1.0, 1.0, 0.0, -15.0)], "pdf_name string, kpi string, kpi_id double, answer string, page0 string, paragraph string, source string, paragraph_relevance_score double, score double, no_ans_score double, no_answer_score_plus_boost double")).first()["PAGE"] == -1


def _words(rows):
    out = []
    for k, (t, x, y) in enumerate(rows):
        at = x
        for j, w in enumerate(t.split(" ")):
            out.append(("d", 0, k, j, w, at, y, at + 6.0 * len(w), y + 10.0, "f1", 10, False, 0.0, 609.0, 841.0))
            at += 6.0 * len(w) + 4
    return out


def test_layout_finds_the_table(spark):
    rows = [("Results", 50.0, 60.0), ("2018", 300.0, 90.0), ("2019", 400.0, 90.0), ("Direct emissions", 50.0, 110.0), ("1,200", 300.0, 110.0), ("1,100", 400.0, 110.0), ("Indirect", 50.0, 130.0), ("70", 300.0, 130.0), ("80", 400.0, 130.0), ("12", 300.0, 820.0)]
    text_lines = [(f"This is, as it were, a line of running text with number {w} in it.", 50.0, 400.0 + 11 * k) for k, w in enumerate(["one", "two", "three"])]
    words = spark.createDataFrame(_words(rows + text_lines), readers.WORDS)
    cells = {(r["row"], r["col"]): r["txt"] for r in layout.table_cells(words).where("role = 'cell' and table_id = 0").collect()}
    assert {"2018", "1,200", "80", "Direct emissions"} <= set(cells.values()) and not any("running" in t for t in cells.values())
    by_text = {t: k for k, t in cells.items()}
    assert by_text["2018"][1] == by_text["1,200"][1] == by_text["70"][1] and by_text["Indirect"][0] == by_text["70"][0]
    kinds = {r["txt"]: r["category"] for r in layout.page_texts(words).collect()}
    assert kinds["12"] == "pagenum" and sum(c == "running" for c in kinds.values()) == 3
    assert layout.table_cells(words.limit(0)).count() == 0


def test_clusters_and_ratio(spark):
    steps = layout.linkage(np.array([[0.0, 0.0], [0.0, 1.0], [10.0, 0.0]]))
    assert steps[0] == (0, 1, 1.0) and steps[1][:2] == (3, 2) or steps[1][:2] == (2, 3)
    assert fuzzy.partial_ratio("emission", "the emission of it") == 1.0 and fuzzy.partial_ratio("", "x") == 0.0
    upper = pd.DataFrame({"y0": [1.0], "y1": [2.0], "item_id": [0], "page": [0], "page_height": [100.0]})
    assert layout.stack_pages(upper, upper.assign(page=1))["y0"].tolist() == [1.0, 101.0]


_PAGE = """<style>#f1 {font-weight: bold}</style><img src="a.png" width="609" height="841">
<div class="txt" style="x"><span id="f1" style="font-size:12px; color: rgba(0,0,0,1)"><!--BBox:(10,20)-(40,30)-->Scope<!--BBox:(45,20)-(50,30)-->1</span></div>
<div class="txt" style="x"><span id="f2" style="font-size:9px"><!--BBox:(10,40)-(10,50)-->gone</span></div>"""


def test_readers(spark, tmp_path):
    words = readers.page_words(spark.createDataFrame([("d", 0, _PAGE), ("e", 1, None)], "doc string, page int, html string"))
    item = readers.page_items(words).first()
    assert (item["txt"], item["is_bold"], item["font_size"], item["x1"]) == ("Scope 1", True, 12, 50.0)
    (tmp_path / "k.csv").write_text('kpi_id,question,sectors,add_year,kpi_category\n2.1,"What, then?","OG, CM",TRUE,"TEXT, TABLE"\n')
    assert readers.kpi_mapping(spark, str(tmp_path / "k.csv")).first().asDict() == {"kpi_id": 2.1, "question": "What, then?", "sectors": ["OG", "CM"], "add_year": True, "kpi_category": ["TEXT", "TABLE"]}
    (tmp_path / "json").mkdir()
    (tmp_path / "json" / "rep.json").write_text(json.dumps({"0": ["a", "b"], "12": ["c"]}))
    assert sorted(tuple(r) for r in readers.extracted_json(spark, str(tmp_path / "json")).collect()) == [("rep", 0, 0, "a"), ("rep", 0, 1, "b"), ("rep", 12, 0, "c")]
    (tmp_path / "pdf").mkdir()
    (tmp_path / "pdf" / "r.pdf").write_bytes(b"one page of text that is long enough to count as such\n\nshort\fsecond page")
    (tmp_path / "pdf" / "bad.pdf").write_bytes(b"\xff")
    found = readers.paragraphs_of(readers.pdf_files(spark, str(tmp_path / "pdf")), lambda b: b.decode("ascii").split("\f"))
    assert [(r["pdf_name"], r["page0"]) for r in found.collect()] == [("r.pdf", 0)]
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="data"/></sheets></workbook>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Data</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c></row><row><c r="A2"><v>10</v></c></row></sheetData></worksheet>')
    (tmp_path / "x").mkdir()
    with pytest.raises(ValueError, match="no workbook"):
        readers.one_workbook(spark, str(tmp_path / "pdf"))
    (tmp_path / "x" / "a.xlsx").write_bytes(book.getvalue())
    assert [r["Data"] for r in readers.one_workbook(spark, str(tmp_path / "x")).collect()] == ["10"]
    spark.dataSource.register(readers.XlsxSource)
    assert spark.read.format("xlsx").option("path", str(tmp_path / "x" / "a.xlsx")).option("sheet", "data").load().first()["Data"] == "10"


def test_stream_runs_only_what_is_new(spark, tmp_path):
    from kpiforge.streaming.incremental import run_on_new

    (tmp_path / "in").mkdir()
    out, seen = str(tmp_path / "out"), []

    def plan(p):
        seen.append(p.select("pdf_name").distinct().count())
        return p.groupBy("pdf_name").agg(F.count("*").alias("n"))

    for k, name in enumerate(("a", "b")):
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps({"0": ["x"] * (k + 1)}))
        run_on_new(spark, str(tmp_path / "in"), plan, out, str(tmp_path / "check")).awaitTermination()
    assert seen == [1, 1] and {r["pdf_name"]: r["n"] for r in spark.read.parquet(out).collect()} == {"a": 1, "b": 2}


def test_command_line(spark, tmp_path):
    from kpiforge import cli

    (tmp_path / "json").mkdir()
    (tmp_path / "json" / "rep.json").write_text(json.dumps({"0": ["What are the emissions of extraordinarily large plants"], "1": ["nothing"]}))
    (tmp_path / "k.csv").write_text('kpi_id,question,sectors,add_year,kpi_category\n2.0,What are the emissions?,"OG, CM",TRUE,"TEXT, TABLE"\n')
    args = ["--extractions", str(tmp_path / "json"), "--kpis", str(tmp_path / "k.csv"), "--out", str(tmp_path / "out")]
    cli.main(["infer", *args])
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r["ANSWER"] for r in rows} == {"extraordinarily", "emissions"} and {r["PDF_NAME"] for r in rows} == {"rep.pdf"}
    cli.main(["infer", *args])
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)
    (tmp_path / "ann").mkdir()
    (tmp_path / "ann" / "a.csv").write_text('company,source_file,source_page,kpi_id,year,answer,data_type,relevant_paragraphs\nX,rep,[1],2.0,2019,5,TEXT,"[""one paragraph""]"\n')
    cli.main(["curate", "--annotations", str(tmp_path / "ann"), "--extractions", str(tmp_path / "json"), "--kpis", str(tmp_path / "k.csv"), "--out", str(tmp_path / "train")])
    assert [(r["context"], r["label"]) for r in spark.read.parquet(str(tmp_path / "train")).collect()] == [("one paragraph", 1)]


def test_texts_that_contain_answers_match_brute_force(spark):
    from kpiforge.operators.anchors import containing

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 5)))
    texts = [(k, rng.choice(["p", "q"]), " ".join(word() for _ in range(rng.randint(0, 9)))) for k in range(300)] + [(900, "p", None), (901, None, "ab"), (902, "q", ""), (903, "r", "abc" * 40_000)]
    answers = [(rng.choice("pq"), " ".join(word() for _ in range(rng.randint(1, 3)))) for _ in range(200)] + [("p", "a"), ("q", ""), ("q", None), (None, "a"), ("p", "zzzz"), ("r", "bcab"), ("r", "x"), ("p", "a")]
    got = containing(spark.createDataFrame(texts, "row long, by string, text string"), spark.createDataFrame(answers, "by string, answer string")).collect()
    want = {(k, b, a) for k, b, t in texts for c, a in answers if t is not None and a is not None and b == c and b is not None and a in t}
    assert len(got) == len(want) and {tuple(r) for r in got} == want and len(want) > 500
    none = spark.createDataFrame([], "by string, answer string")
    assert containing(spark.createDataFrame(texts, "row long, by string, text string"), none).collect() == []
    assert containing(spark.createDataFrame([], "row long, by string, text string"), spark.createDataFrame(answers, "by string, answer string")).collect() == []


def test_exact_splits_cut_at_the_count(spark):
    from kpiforge.operators import sampling

    for n, share in ((1, 0.5), (17, 0.3), (5000, 0.3), (5000, 0.9999), (100, 0.0), (100, 1.0)):
        df = spark.range(n).withColumnRenamed("id", "k")
        df = df.unionByName(df.where("k < 5"))
        out = sampling.split_exactly(df, share, 9, "k").distinct()
        rows = {r["k"]: r["split"] for r in out.collect()}
        train = int((1 - share) * n)
        order = sorted(range(n), key=lambda k: hashlib.md5(f"9|{k}".encode()).hexdigest())
        assert out.count() == n and {k for k, s in rows.items() if s == "train"} == set(order[:train])
    assert sampling.split_exactly(spark.range(0).withColumnRenamed("id", "k"), 0.5, 1, "k").collect() == []
    plan = sampling.split_exactly(spark.range(50).withColumnRenamed("id", "k"), 0.3, 1, "k")._jdf.queryExecution().toString()
    assert "TakeOrdered" not in plan and "Join" not in plan


def test_partial_ratios_match_brute_force():
    def changes(a: str, b: str) -> int:
        row = [0] * (len(b) + 1)  # a part may begin and end anywhere
        for i, x in enumerate(a):
            last, row = row, [i + 1]
            for j, y in enumerate(b):
                row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
        return min(row)

    def ratio(a: str, b: str) -> float:
        a, b = sorted((a, b), key=len)
        return 1 - changes(a, b) / len(a) if a else 0.0

    rng = random.Random(4)
    skipped = 0
    for k in range(400):
        letters = "abcdefghé"[: rng.randint(1, 9)]
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 90 if k % 5 else 9))) for _ in range(4)]
        if k % 2 and len(texts[1]) > 3:  # a part of another text with some characters lost or changed
            texts[0] = "".join(c if rng.random() < 0.85 else rng.choice(["", "x"]) for c in texts[1][2:])
        assert fuzzy.partial_ratio(texts[0], texts[1]) == ratio(texts[0], texts[1])
        ratios = [ratio(texts[0], t) for t in texts[1:]]
        assert fuzzy.most_alike(texts[0], texts[1:]) == ratios.index(max(ratios))
        short, long = sorted(texts[:2], key=len)
        assert (least := fuzzy.Pattern(short).least_changes(long)) <= changes(short, long)
        skipped += least > 0
    assert skipped > 100


def test_new_pdfs_are_read_once_and_broken_ones_are_told(spark, tmp_path):
    from kpiforge.streaming.incremental import run_on_new_pdfs

    def decode(content: bytes) -> list[str]:
        if not content.startswith(b"%PDF"):
            raise ValueError("no report")
        return content.decode()[4:].split("\f")

    folder, out, lost = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "lost")
    folder.mkdir()
    calls = spark.sparkContext.accumulator(0)
    line = "Direct emissions of the whole group fell by a tenth in the year"

    def counted(content: bytes) -> list[str]:
        calls.add(1)
        return decode(content)

    def run(at_once=None):
        run_on_new_pdfs(spark, str(folder), counted, lambda p: p.select("pdf_name", "page0", "para_idx", "text"), out, lost, str(tmp_path / "check"), at_once).awaitTermination()

    (folder / "a.pdf").write_bytes(f"%PDF{line} one.\f{line} two.".encode())
    (folder / "b.pdf").write_bytes(b"broken")
    (folder / "empty.pdf").write_bytes(b"")
    (folder / "notes.txt").write_bytes(b"%PDFnot a report")
    run(1)
    assert [(r["pdf_name"], r["page0"]) for r in spark.read.parquet(out).orderBy("page0").collect()] == [("a.pdf", 0), ("a.pdf", 1)]
    told = {r["pdf_name"]: (r["error"], r["path"].rsplit("/", 1)[1]) for r in spark.read.parquet(lost).collect()}
    assert told == {"b.pdf": ("ValueError: no report", "b.pdf")} and calls.value == 2  # Spark passes over files of no bytes
    (folder / "c.pdf").write_bytes(f"%PDF{line} three.".encode())
    run()
    assert calls.value == 3 and {r["pdf_name"] for r in spark.read.parquet(out).collect()} == {"a.pdf", "c.pdf"} and spark.read.parquet(lost).count() == 1
    run()
    assert calls.value == 3


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_paragraphs_are_cleaned_once_and_firsts_alone(spark):
    """What a line holds is told before it is cleaned, so that the cleaning stands in the plan once."""
    from kpiforge.functions.text import clean_for_answers, clean_for_curation, letters, letters_when_clean
    from kpiforge.operators.paragraphs import first_paragraphs, split_pages

    odd = ["[“one”] “two” three", "a\tb\n\nc  d  e\x1cf\x00g", "ééÿāЖ中\U00010400 7", "", "\x85x   y", "[“”]..a..b(c)"]
    rows = spark.createDataFrame([(t,) for t in odd], "t string").select("t", clean_for_curation(F.col("t")).alias("c"), clean_for_answers(F.col("t")).alias("a"), letters_when_clean(F.col("t")).alias("n"))
    for r in rows.withColumn("m", letters(F.col("c"))).collect():
        plain = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xff]", "", re.sub("[“”]", "", r["t"].replace("[“", '["').replace("”]", '"]')).replace("\n", " "))
        assert r["c"] == re.sub(r"\s{2,}", " ", plain.replace("\t", " ")) and r["n"] == r["m"] == sum(c.isalpha() for c in r["c"])
        assert r["a"] == re.sub(r"\.{2,}", "", re.sub(r"[()^+*$|\\?\[\]{}]", "", re.sub(r"\s{2,}", " ", plain)).lower())
    pages = spark.createDataFrame([("a", "short\n" + "é" * 40 + "\nthe first “long” one\nthe second long one"), ("b", "short"), ("c", None), ("d", "")], "pdf_name string, text string")
    every = split_pages(pages, "\n", 8, ("pdf_name",))
    assert [tuple(r) for r in first_paragraphs(pages, "\n", 8, ("pdf_name",)).collect()] == [("a", 2, "the first long one")] == sorted(tuple(r) for r in every.collect())[:1]
    assert _plan(every).count(r"(?U)\s{2,}") == 1


def test_answers_are_found_once_and_pairs_without_any_count_for_nothing(spark):
    from kpiforge.models import Answers, NearWords
    from kpiforge.plans.inference import extract_answers, melted

    made = Answers(lambda q, p: F.struct(F.array(F.struct(F.concat(p, F.lit("<found>")).alias("answer"), F.lit(0.5).alias("score"))).alias("answers"), F.lit(0.0).alias("no_ans_gap")))
    paras = spark.createDataFrame([("a", 0, 0, "the people of it was here for all")], "pdf_name string, page0 int, para_idx int, text string")
    asked = spark.createDataFrame([(5.0, "Was it for the people?")], "kpi_id double, question string")
    found = extract_answers(paras, asked, answers=made)
    assert [r["answer"] for r in found.collect()] == ["the people of it was here for all<found>"] and _plan(found).count("<found>") == 1
    none = [("no_answer", 0.1)]
    pairs = [("a", 0, 0, []), ("a", 0, 1, none), ("a", 1, 0, [("no_answer", 0.3), ("x", 0.1)]), ("b", 0, 0, []), ("b", 0, 1, None)]
    rows = spark.createDataFrame([(d, "q", p, k, a, 0.0) for d, p, k, a in pairs], "pdf_name string, kpi string, page0 int, para_idx int, answers array<struct<answer:string,score:double>>, no_ans_gap double")
    assert sorted((r["pdf_name"], r["answer"], r["score"]) for r in melted(rows).collect()) == [("a", "no_answer", 0.3), ("a", "x", 0.1)]
    near = spark.createDataFrame([("far far away was a hill; it was for a hill",), (None,), ("",)], "p string").withColumn("q", F.lit("Was it for the people?"))
    got = NearWords().prepared(near, "p").select(NearWords().found("p", "q").alias("f")).collect()
    assert [[tuple(a) for a in r["f"]["answers"]] for r in got] == [[("a", 0.4), ("hill", 0.4)], [("no_answer", 0.2)], [("no_answer", 0.2)]]


def _random_spans(rng, columns: int) -> list:
    from kpiforge.layout.overlaps import Span

    return [[Span(float(x), float(x + rng.randint(5, 60)), rng.random() < 0.15) for x in (60 * c + rng.randint(0, 50) for _ in range(rng.randint(1, 4)))] for c in range(columns)]


def test_overlaps_of_many_tables_are_those_of_each(spark):
    """Whole tables are looked at together, across batches; each has what it has alone."""
    from kpiforge.layout.overlaps import fewest_removed

    rng = random.Random(5)
    tables = {(None if t == 7 else t): _random_spans(rng, 1 + t % 4) for t in range(150)}
    rows = [(t, k, 2 * c, s.x0, s.x1, "", s.fixed) for t, columns in tables.items() for c, column in enumerate(columns) for k, s in enumerate(column)]
    want = {}
    for t, columns in tables.items():
        gone = fewest_removed(columns)
        want |= {(t, k, 2 * c): None if gone is None else (c, k) in gone for c, column in enumerate(columns) for k in range(len(column))}
    cells = spark.createDataFrame(rows, "t int, row int, col int, x0 double, x1 double, txt string, fixed boolean")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("3", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert {(r["t"], r["row"], r["col"]): r["removed"] for r in layout.overlapping_cells(cells, ["t"]).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert None in want.values() and True in want.values() and layout.overlapping_cells(cells.limit(0), ["t"]).collect() == []


def test_chains_of_many_lines_are_those_of_each():
    from kpiforge.layout.hierarchy import chains, chains_of_many

    rng = random.Random(3)
    lines = [[(k, float(rng.choice((1, 2, 3, 4, float("nan"))))) for k in range(rng.randint(1, 30))] for _ in range(60)] + [[(k, float(-k)) for k in range(500)], [(k, float(k % 97)) for k in range(500)]]
    want, start = {}, 0
    for line in lines:
        for k, above in enumerate(chains(line)):
            want |= {(start + k, step): start + a for step, a in enumerate(above)}
        start += len(line)
    first, rank = np.array([not k for line in lines for k, _ in line]), np.array([r for line in lines for _, r in line])
    assert {(c, step): a for step, (cells, above) in enumerate(chains_of_many(first, rank)) for c, a in zip(cells.tolist(), above.tolist())} == want


def test_ancestors_of_repeated_and_unranked_cells(spark):
    from kpiforge.operators.hierarchy import cell_ancestors

    cells = [(1, 0, 0, 1.0, 1.0), (1, 1, 0, 5.0, None), (1, 1, 0, None, None), (1, 1, 0, 2.0, None), (1, 2, 0, None, 3.0), (1, 3, 0, 4.0, 1.0), (1, 3, 1, None, 2.0), (1, None, 1, 1.0, 1.0), (None, 3, 0, 9.0, 1.0), (None, 4, 0, 9.5, 1.0)]
    got = cell_ancestors(spark.createDataFrame(cells, "t long, row long, col long, up_rank double, left_rank double"), ["t"]).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, [(1, 1, 0, "up", 1, 0, 0), (1, 3, 0, "up", 1, 1, 0), (1, 3, 0, "up", 2, 0, 0), (1, 3, 1, "left", 1, 3, 0), (None, 4, 0, "up", 1, 3, 0)]))


def test_tables_are_judged_after_one_shuffle(spark):
    from kpiforge.operators.ranking import good_tables

    rng = random.Random(3)
    rows = [(t, rng.choice([None, 0, 1, 2]), rng.choice([None, 0, 1, 5]), rng.choice(["7", "2019", "a1", "word", "3,5", None]), rng.choice(["cell", "cell", "special"])) for t in [None, *range(40)] for _ in range(rng.randint(1, 14))]
    cells = spark.createDataFrame(rows, "t int, row int, col int, txt string, role string")
    assert good_tables(cells, ["t"])._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    got = {r["t"]: (r["n_rows"], r["n_cols"], r["n_cells"]) for r in good_tables(cells, ["t"]).collect()}
    own = lambda t, k: {r[k] for r in rows if r[0] == t and r[4] == "cell"} - {None}
    assert got == {t: (len(own(t, 1)), len(own(t, 2)), sum(r[0] == t and r[4] == "cell" for r in rows)) for t in [None, *range(40)]}


def test_a_misspelt_paragraph_is_another_one_that_is_more_alike_in_the_query_and_its_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry

    first = "Emissions of ammonia of the new plant were lower than those of the older one in the south-west."
    part, late, other = first[:-30], first[22:], "Nothing of this concerns the water that the company takes from the river."
    texts = [f"{first}\n{part}", f"{first}\n{late}", f"{first}\n{other}\n{part}", f"{first}\nAll {first}", f"{part}\n{first}", f"{first}\n{first}\n{other}", "ab " * 30 + f"cd\n{first}", f"{other}\n{other[:-9]}\n{other[:-20]}", first]
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    theirs = sorted(con.execute(f"select ann_id, context from ({entry.oracle_sql()['misspelt_paragraphs']})").fetchall())
    ours = sorted(map(tuple, entry.queries()["misspelt_paragraphs"](spark, str(tmp_path)).select("ann_id", "context").collect()))
    assert ours == theirs
    meant = dict(ours)
    assert meant[0] == meant[2] == hashlib.md5(part.encode()).hexdigest() and meant[8] == hashlib.md5(first.encode()).hexdigest()
    assert meant[1] not in [hashlib.md5(t.encode()).hexdigest() for t in (first, late)]  # what is most alike lacks the answer
