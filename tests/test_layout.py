"""Pages laid out by hand: what the layout finds, and what rules make of it."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiforge.layout import shapes
from kpiforge.layout.clusters import linkage
from kpiforge.layout.grid import Grid
from kpiforge.layout.items import CENTER, LEFT, RIGHT, Item, Rect, Word, items_of
from kpiforge.layout.page import Page
from kpiforge.layout.reader import Reader
from kpiforge.operators import layout
from kpiforge.operators.clusters import fewest_texts, flat_text, nearest_text
from kpiforge.operators.rules import AnywhereRule, DescriptionRule, KpiRule
from kpiforge.plans import rule_based
from kpiforge.rules.catalogue import ACTIVE
from kpiforge.schemas import EUCLID, MAY_INCLUDE, MUST_EXCLUDE, MUST_INCLUDE
from kpiforge.sources import readers

WIDTH, HEIGHT = 609.0, 841.0


def words(rows, size=10) -> list[Word]:
    """Rows of (text, x, y[, size[, bold]]): an item each, five points a letter, four a blank; a right-aligned x is negative."""
    out = []
    for k, (text, x, y, *more) in enumerate(rows):
        parts = text.split(" ")
        wide = sum(5 * len(w) for w in parts) + 4 * (len(parts) - 1)
        at = x if x >= 0 else -x - wide
        for j, w in enumerate(parts):
            out.append(Word(k, j, w, at, y, at + 5 * len(w), y + 9, "f1", more[0] if more else size, len(more) > 1 and more[1]))
            at += 5 * len(w) + 4
    return out


def page(rows) -> Page:
    return Page(words(rows), WIDTH, HEIGHT)


def table_rows(y=100.0, labels=("Scope 1 emissions", "Scope 2 emissions", "Energy use"), years=("2017", "2018", "2019"), x=(50.0, -340.0, -440.0, -540.0)):
    rows = [(t, c, y) for t, c in zip(years, x[1:])]
    for k, label in enumerate(labels):
        rows.append((label, x[0], y + 20 * (k + 1)))
        rows += [(f"{(k + 1) * 100 + j},000", c, y + 20 * (k + 1)) for j, c in enumerate(x[1:])]
    return rows


def test_numeric_table_with_years_on_top():
    (t,) = page(table_rows()).tables
    assert t.lines()[0] == ["", "2017", "2018", "2019"] and t.lines()[2] == ["Scope 2 emissions", "200,000", "201,000", "202,000"] and t.shape() == (4, 4, 15)
    assert t.alignment(1)[0] == RIGHT and t.alignment(0)[0] == LEFT and t.year_runs(0) == [(1, 3)]


def test_years_over_grouped_columns():
    rows = [("2018", 330.0, 80.0), ("Own", -300.0, 100.0), ("Leased", -380.0, 100.0), ("Total", -460.0, 100.0)]
    for k, label in enumerate(("Cars", "Trucks", "Ships")):
        rows += [(label, 50.0, 120.0 + 20 * k)] + [(str(10 * k + j + 1), c, 120.0 + 20 * k) for j, c in enumerate((-300.0, -380.0, -460.0))]
    p = page(rows)
    reader = Reader(p.tables[0], p, 2020)
    found = {(c.nodes[0], c.above[0], c.year, c.item.txt) for c in reader.indirect()}
    assert ("Trucks", "Leased", 2018, "12") in found and ("Ships", "Total", 2018, "23") in found


def test_label_on_two_lines_is_one_cell():
    rows = table_rows(labels=("Scope 1 emissions", "Energy"))
    rows += [("Emissions from all of the", 50.0, 160.0), ("company cars", 50.0, 170.0), ("7", -340.0, 170.0), ("8", -440.0, 170.0), ("9", -540.0, 170.0)]
    (t,) = page(rows).tables
    assert ["Emissions from all of the company cars", "7", "8", "9"] in t.lines()


def test_unit_among_numbers_is_special():
    rows = table_rows() + [("Waste", 50.0, 180.0), ("tonnes", -440.0, 180.0), ("5", -340.0, 180.0), ("6", -540.0, 180.0)]
    p = page(rows)
    assert [i.txt for i in p.tables[0].special] == ["tonnes"] or "tonnes" in {t for r in p.tables[0].lines() for t in r if t}
    assert p.tables[0].place(p.by_text("5"))[1] == 1


def test_two_tables_side_by_side():
    left = table_rows(x=(20.0, -150.0, -200.0, -250.0))
    right = table_rows(labels=("Water use", "Waste", "Spills"), x=(320.0, -430.0, -480.0, -530.0))
    p = page(left + right)
    subs = p.all_tables()
    labels = [{t for r in one.lines() for t in r if shapes.weak_words(t)} for one in subs]
    assert any("Water use" in x and "Scope 1 emissions" not in x for x in labels)
    water = next(one for one, x in zip(subs, labels) if "Water use" in x and "Scope 1 emissions" not in x)
    assert water.lines()[1][-3:] == ["100,000", "101,000", "102,000"]


def test_running_text_parts_columns():
    text = [(f"This is, as it were, a line of the text number {w}.", 200.0, 100.0 + 10 * k) for k, w in enumerate(("one", "two", "six", "ten"))]
    p = page(text + [("Sum", 20.0, 100.0), ("12", 120.0, 100.0)])
    assert {i.category for i in p.items if "text" in i.txt} == {"running"} and not p.tables


def test_footer_and_footnotes():
    p = page(table_rows() + [("17", 300.0, 810.0), ("1) all of the company", 50.0, 500.0)])
    kinds = {i.txt: i.category for i in p.items}
    assert kinds["17"] == "pagenum" and kinds["1) all of the company"] == "footnote" and p.footnotes() == ["1) all of the company"]


def test_overlaps_specks_and_dot_leaders():
    rows = table_rows() + [("over", 50.0, 121.0)]
    p = page(rows)
    assert "over" not in {i.txt for i in p.items}
    dots = [Word(500 + k, 0, ".", 100.0 + 3 * k, 600.0, 101.0 + 3 * k, 609.0, "f1", 10, False) for k in range(60)]
    speck = [Word(900, 0, "line", 10.0, 700.0, 300.0, 702.0, "f1", 10, False)]
    assert {i.txt for i in Page(dots + speck, WIDTH, HEIGHT).items} == set()
    assert len(Page(dots[:40], WIDTH, HEIGHT).items) == 40


def test_page_without_tables():
    assert page([("Only a title", 50.0, 50.0)]).tables == [] and page([]).tables == [] and page([]).items == []


def test_items_split_merge_and_link():
    one = items_of(words([("a long label 12 34", 10.0, 10.0)]))[0]
    two = one.split(3, 77)
    assert (one.txt, two.txt, one.right is two, two.left is one, two.ident) == ("a long label", "12 34", True, True, 77)
    assert one.row_text() == two.row_text() == "a long label 12 34"
    three = two.split(1, 78)
    assert one.row_text() == "a long label 12 34" and three.left is two
    one.merge(two)
    assert one.txt == "a long label 12" and one.right is three and three.left is one
    assert not three.mergeable(Item(5, words([("5", 0.0, 0.0)]))) and one.depth < Item(6, words([("x", 0.0, 0.0, 9)])).depth
    # a gap of two blanks is cut where other rows have the same edge
    gap = [Word(k, j, t, x, 10.0 * k, x + 5 * len(t), 10.0 * k + 9, "f", 10, False) for k in range(4) for j, (t, x) in enumerate((("name", 10.0), ("99", 37.5)))]
    assert len(Page(gap, WIDTH, HEIGHT).items) == 8 and len(Page(gap[:2], WIDTH, HEIGHT).items) == 1


def test_alignment_and_rectangles():
    p = page(table_rows())
    assert p.by_text("100,000").alignment == RIGHT and p.by_text("Energy use").alignment == LEFT
    a, b = Rect(0, 0, 10, 10), Rect(20, 5, 30, 8)
    assert a.gap(b) == (10, 0) and a.grown(b) == Rect(0, 0, 30, 10) and not a.meets(b) and a.shared(Rect(5, 5, 15, 15)) == 25 and a.center == (5, 5)
    assert Item(0, words([("abc", 10.0, 0.0)])).aligned_x(CENTER) == 17.5


def test_grid_passes():
    cell = lambda t, x, y: Item(0, words([(t, x, y)]))
    far = Grid([[cell("a", 0, 0), cell("1", 50, 0)], [cell("b", 0, 12), cell("2", 50, 12)], [cell("c", 0, 300), cell("3", 50, 300)]])
    assert [i.txt for i in far.distant_rows()] == ["c", "3"] and far.n_rows == 2
    again = Grid([[cell(t, 0, 12 * k), cell(str(k), 60, 12 * k), cell(t, 200, 12 * k)] for k, t in enumerate(("north", "south", "east side", "west side"))])
    assert len(again.repeated_cols()) == 4 and again.n_cols == 2
    two = Grid([[cell("x", 0, 0), cell("1", 100, 0), None], [cell("y", 0, 12), None, cell("2", 103, 12)]])
    two.merge_down_cols()
    assert two.lines() == [["x", "1"], ["y", "2"]]
    wide = Grid([[cell("a very wide label in here indeed", 0, 0), cell("1", 90, 0)], [cell("b", 0, 12), cell("2", 90, 12)], [cell("c", 0, 24), cell("3", 90, 24)]])
    wide.overlapping_cells()
    assert [i.txt for i in wide.special] == ["a very wide label in here indeed"]
    header = Grid([[cell("x", 0, 0), cell("1", 50, 0)], [cell("y", 0, 12), cell("2", 50, 12)], [None, cell("2019", 50, 40), cell("2020", 90, 40)][:2] + []])
    header.cells = [r + [None] * (3 - len(r)) for r in header.cells]
    header.cells[2][2] = cell("2020", 90, 40)
    assert {i.txt for i in header.rows_after_new_header()} == {"2019", "2020"}
    assert Grid([[cell("a", 0, 0), cell("1", 50, 0)], [cell("b", 0, 12), cell("2", 50, 12)]]).is_good() is False


def test_hierarchy_carries_ancestors():
    rows = table_rows(labels=("Emissions", "Scope 1", "Scope 2"), x=(50.0, -340.0, -440.0, -540.0))
    rows = [r for r in rows if not (r[2] == 120.0 and r[0] != "Emissions")]  # a label without values over two indented ones
    rows = [(t, 62.0, y) if t in ("Scope 1", "Scope 2") else (t, x, y) for t, x, y in rows]
    p = page(rows)
    reader = Reader(p.tables[0], p, 2020)
    assert reader.nodes(2, 0)[:2] == ["Scope 1", "Emissions"] or reader.nodes(3, 0)[:2] == ["Scope 2", "Emissions"]
    direct = {(c.nodes[0], c.year): c.item.txt for c in reader.direct()}
    assert direct["Scope 1", 2018] == "201,000" and all("Emissions" in c.nodes for c in reader.direct())


def test_years_are_searched_for_where_no_row_has_them():
    rows = [r for r in table_rows() if not r[0].startswith("20")] + [("as of 31.12.2016", 50.0, 60.0)]
    p = page(rows)
    reader = Reader(p.tables[0], p, 2020)
    assert {c.year for c in reader.indirect()} == {2016} and {c.year for c in Reader(p.tables[0], p, 2005).indirect()} == {2005}


def test_linkage_joins_the_closest_first():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(40, 2))
    steps = linkage(points)
    leaves = [{k} for k in range(40)]
    alive = set(range(40))
    for a, b, dist in steps:  # every join is the closest pair of clusters at that time, by the mean distance of their members
        mean = lambda x, y: np.mean([np.hypot(*(points[i] - points[j])) for i in leaves[x] for j in leaves[y]])  # noqa: B023, E731
        assert dist == pytest.approx(mean(a, b)) and dist <= min(mean(x, y) for x in alive for y in alive if x < y) + 1e-9
        leaves.append(leaves[a] | leaves[b])
        alive = alive - {a, b} | {len(leaves) - 1}
    assert linkage(points[:1]) == [] and linkage(np.array([[0.0, 0.0], [9.0, 1.0], [0.0, 3.0]]), y_only=True)[0][:2] == (0, 1)


def _frame(spark, pages):
    rows = [(doc, number, *w[:10], 0.0, WIDTH, HEIGHT) for doc, number, rows in pages for w in words(rows)]
    return spark.createDataFrame(rows, readers.WORDS)


EMISSIONS = [("Greenhouse gas emissions in tonnes CO2e", 50.0, 60.0)]


def test_rules_find_measures_of_reports(spark):
    labels = ("Scope 1 direct GHG emissions", "Scope 2 indirect GHG emissions", "Water use")
    frame = _frame(spark, [("a", 0, EMISSIONS + table_rows(labels=labels)), ("a", 1, [("No table", 50.0, 50.0)]), ("b", 0, table_rows(labels=("Cats", "Dogs", "Birds")))])
    found = rule_based.report_measures(frame, list(ACTIVE), 2019).collect()
    by = {(r["src_file"], r["kpi_id"], r["year"]): r for r in found}
    assert {(f, k, y) for f, k, y in by} >= {("a", k, y) for k in (6.0, 7.0) for y in (2017, 2018, 2019)} and not [k for k in by if k[0] == "b"]
    one = by["a", 6.0, 2018]
    assert (one["value"], one["match_type"], one["page_num"]) == ("101,000", "AT.direct", 0) and one["unit"] == "Scope 1 direct GHG emissions" and 0 < one["pos_x"] < 1 and one["score"] >= 500
    assert by["a", 7.0, 2019]["value"] == "202,000"
    assert rule_based.report_measures(frame.limit(0), list(ACTIVE)).collect() == []
    undated = rule_based.report_measures(frame, list(ACTIVE), without_years=True).collect()
    assert undated and {r["year"] for r in undated} == {None} and len({r["kpi_id"] for r in undated}) == len(undated)


def test_stacked_pages(spark):
    frame = _frame(spark, [("a", 0, [("top", 10.0, 10.0)]), ("a", 1, [("under", 10.0, 20.0)]), ("b", 3, [("alone", 10.0, 30.0)])])
    rows = {(r["doc"], r["page"], r["txt"]): (r["y0"], r["page_height"]) for r in layout.stacked(frame).collect()}
    assert rows == {("a", 0, "top"): (10.0, 2 * HEIGHT), ("a", 0, "under"): (20.0 + HEIGHT, 2 * HEIGHT), ("a", 1, "under"): (20.0, HEIGHT), ("b", 3, "alone"): (30.0, HEIGHT)}


def test_cells_texts_and_trees_as_relations(spark):
    frame = _frame(spark, [("a", 0, EMISSIONS + table_rows()), ("b", 2, [("12", 10.0, 10.0)])])
    cells = layout.table_cells(frame)
    assert cells.where("role = 'cell'").count() == 15 and cells.where("role = 'headline'").count() in (0, 1)
    texts = layout.page_texts(frame)
    assert texts.where("category = 'table'").count() == 15 and texts.count() == 17
    tree = layout.cluster_tree(texts.where("doc = 'a'"))
    assert tree.count() == 2 * 16 - 1 and tree.agg({"n": "max"}).first()[0] == 16
    assert layout.footnotes(frame).count() == 0


def test_the_fewest_cells_leave_overlapping_columns():
    import random
    from itertools import combinations

    from kpiforge.layout.overlaps import Span, clear, fewest_removed

    rng = random.Random(11)
    met = Counter()
    for _ in range(500):
        columns = [[] for _ in range(rng.randint(2, 4))]
        for _ in range(rng.randint(2, 12)):
            c = rng.randrange(len(columns))
            x = 100 * c + rng.randint(0, 60)
            columns[c].append(Span(float(x), float(x + rng.choice([20, 40, 100, 250])), rng.random() < 0.3))
        cells = [(c, k) for c, column in enumerate(columns) for k in range(len(column))]
        without = lambda gone: [[s for k, s in enumerate(column) if (c, k) not in gone] for c, column in enumerate(columns)]  # noqa: B023, E731
        free = [x for x in cells if not columns[x[0]][x[1]].fixed]
        want = None
        for n in range(len(free) + 1):
            fit = [set(g) for g in combinations(free, n) if clear(without(set(g)))]
            if fit:
                want = n, max(sum(columns[c][k].x1 - columns[c][k].x0 for c, k in g) for g in fit)
                break
        got = fewest_removed(columns)
        if want is None:
            assert got is None
        else:
            assert clear(without(set(got))) and not any(columns[c][k].fixed for c, k in got)
            assert (len(got), sum(columns[c][k].x1 - columns[c][k].x0 for c, k in got)) == pytest.approx(want)
        met[None if want is None else want[0]] += 1
    assert all(met[n] > 10 for n in (None, 0, 1, 2, 3))


def test_chains_of_ancestors_match_brute_force():
    import random

    from kpiforge.layout.hierarchy import chains

    rng = random.Random(2)
    for _ in range(200):
        line = [(3 * k, float(rng.randint(0, 5))) for k in range(rng.randint(0, 15))]
        want = []
        for k in range(len(line)):
            chain, at = [], k
            while (above := next((j for j in range(at - 1, -1, -1) if line[j][1] < line[at][1]), None)) is not None:
                chain.append(line[above][0])
                at = above
            want.append(tuple(chain))
        assert chains(line) == want


def test_ancestors_of_odd_cells(spark):
    from kpiforge.operators.hierarchy import cell_ancestors

    cells = spark.createDataFrame([("a", 0, 0, 1.0, 1.0), ("a", 1, 0, 2.0, 1.0), ("a", 1, 0, 3.0, 9.0), ("a", 2, 0, None, 0.0), ("a", 3, 0, 3.0, 1.0), ("a", 3, 2, 5.0, 2.0), (None, 0, 0, 1.0, 1.0), (None, 4, 0, 2.0, 1.0), ("a", None, 0, 0.0, 0.0)], "doc string, row int, col int, up_rank double, left_rank double")
    got = sorted(((r["doc"] or "", *tuple(r)[1:]) for r in cell_ancestors(cells, ["doc"]).collect()))
    assert got == [("", 4, 0, "up", 1, 0, 0), ("a", 1, 0, "up", 1, 0, 0), ("a", 3, 0, "up", 1, 1, 0), ("a", 3, 0, "up", 2, 0, 0), ("a", 3, 2, "left", 1, 3, 0)]
    assert cell_ancestors(cells.limit(0), ["doc"]).collect() == []


SCOPE = KpiRule(6.0, "scope 1", (DescriptionRule(".*scope 1.*", 1000.0, MUST_INCLUDE, half_life=40.0, free_letters=17),), units=(".*tonnes.*",), anywhere=(AnywhereRule(".*water.*", 1.0, MUST_EXCLUDE, EUCLID), AnywhereRule(".*climate.*", 100.0, MAY_INCLUDE, EUCLID)))
FREE = [("Our climate", 50.0, 60.0), ("Scope 1 emissions", 50.0, 100.0), ("4,200", 60.0, 120.0), ("9,100", 60.0, 160.0), ("tonnes in 2018", 50.0, 140.0), ("Long before that scope 1 was told apart from others", 50.0, 600.0), ("7", 50.0, 700.0)]


def test_clusters_give_values_outside_tables(spark):
    found = rule_based.report_measures(_frame(spark, [("a", 0, FREE), ("b", 0, [*FREE, ("Water use", 400.0, 60.0)]), ("c", 0, FREE[:4])]), [SCOPE], 2019, clusters=True).collect()
    # the page that speaks of water is ruled out, the one without a unit has nothing; of the competing texts the short one scores
    assert [(m["src_file"], m["raw_txt"], m["unit"].split()[0], m["year"], m["match_type"]) for m in found] == [("a", "4,200", "tonnes", 2018, "AC.default")]
    assert 700 < found[0]["score"] < 1100 and 1 in found[0]["item_ids"] and 5 not in found[0]["item_ids"]
    empty = _frame(spark, [("a", 0, FREE)]).limit(0)
    assert rule_based.report_measures(empty, [SCOPE], 2019, clusters=True).count() == 0 and layout.clusters(empty).count() == 0


def test_nodes_hold_each_item_once_and_the_last_all(spark):
    rows = layout.clusters(_frame(spark, [("a", 0, FREE)])).collect()
    nodes, items = [r for r in rows if r["node"] is not None], [r for r in rows if r["node"] is None]
    assert len(nodes) == 2 * len(items) - 1 and sorted(nodes[-1]["item_ids"]) == sorted(i["item_id"] for i in items)
    text = {i["item_id"]: i["txt"] for i in items}
    assert all(n["flat_text"] == " ".join(text[k] for k in n["item_ids"]) for n in nodes)


def test_texts_that_a_rule_needs_match_leaving_out_one_by_one(spark):
    """Against plain Python: the same texts in another order of patterns, repeated texts, nulls, lists without texts."""
    patterns = [("scope", 900.0, 30.0, 5), ("direct", 500.0, 20.0, 6), ("total", 300.0, 10.0, 0)]
    rule = KpiRule(1.0, "x", tuple(DescriptionRule(f".*{p}.*", s, MAY_INCLUDE if k else MUST_INCLUDE, half_life=h, free_letters=n) for k, (p, s, h, n) in enumerate(patterns)), minimum_description=10.0)

    def told(texts):
        flat = " ".join(texts)
        letters = sum(c == " " or "a" <= c <= "z" for c in flat)
        if "scope" not in flat.lower():
            return 0.0
        return sum(s * 0.5 ** (max(letters - n, 0) / h) for p, s, h, n in patterns if p in flat.lower())

    rng = np.random.default_rng(3)
    vocabulary = ["scope", "Direct scope", "total", "water", "direct", "a much longer text about nothing", "SCOPE", "12"]
    lists = [[str(t) for t in rng.choice(vocabulary, rng.integers(1, 7))] for _ in range(60)]
    rows = [(k, [(t,) for t in texts]) for k, texts in enumerate(lists)] + [(100, []), (101, None), (102, [(None,), ("scope",)])]
    got = {r["k"]: ([i["txt"] for i in r["kept"]], r["kept_score"]) for r in fewest_texts(spark.createDataFrame(rows, "k int, items array<struct<txt:string>>"), [rule]).collect()}
    for k, texts in enumerate(lists):
        kept, score = list(range(len(texts))), told(texts)
        if score < 10:
            assert k not in got
            continue
        for i in reversed(range(len(texts))):
            rest = [j for j in kept if j != i]
            if rest and told([texts[j] for j in rest]) >= max(score, 10) - 1e-9:
                kept, score = rest, told([texts[j] for j in rest])
        assert got[k][0] == [texts[j] for j in kept] and got[k][1] == pytest.approx(score)
    assert 100 not in got and 101 not in got and got[102][0] == ["scope"]


def test_nearest_text_takes_words_of_items_and_the_first_of_equals(spark):
    from pyspark.sql import functions as F

    from kpiforge.functions.shape import looks_numeric

    it = lambda k, t, x: (k, t, x, 0.0, x + 10, 10.0, [(j, w, x + 20 * j, 0.0, x + 20 * j + 10, 10.0) for j, w in enumerate(t.split(" "))])
    schema = "items array<struct<item_id:int,txt:string,x0:double,y0:double,x1:double,y1:double,words:array<struct<word_idx:int,txt:string,x0:double,y0:double,x1:double,y1:double>>>>, box struct<x0:double,y0:double,x1:double,y1:double>"
    rows = [([it(1, "5", 0.0), it(2, "6", 80.0)], (40.0, 0.0, 50.0, 10.0)), ([it(1, "2018", 0.0), it(2, "used 7 t", 100.0)], (0.0, 0.0, 10.0, 10.0)), ([it(1, "none", 0.0)], (0.0, 0.0, 1.0, 1.0)), ([], (0.0, 0.0, 1.0, 1.0))]
    df = spark.createDataFrame(rows, schema)
    got = df.select(nearest_text(F.col("items"), F.col("box"), looks_numeric).alias("n")).collect()
    assert [(r["n"]["txt"], r["n"]["item_id"], r["n"]["word_idx"]) if r["n"] else None for r in got] == [("5", 1, -1), ("7", 2, 1), None, None]
    assert df.select(flat_text(F.col("items")).alias("t")).collect()[1]["t"] == "2018 used 7 t"


def test_pages_with_clusters_are_laid_out_once(spark, monkeypatch):
    passes = []
    by_page = layout._by_page
    monkeypatch.setattr(layout, "_by_page", lambda words, schema, rows: passes.append(schema) or by_page(words, schema, rows))
    words = _frame(spark, [("a", 0, FREE), ("b", 3, table_rows())])
    assert rule_based.report_measures(words, [SCOPE], 2019, clusters=True).count() > 0 and len(passes) == 1
    both = layout.candidates_and_clusters(words, 2019)
    plain = lambda df: sorted(map(str, df.collect()))
    assert plain(both.where("kind = 'cluster'").select(*layout.CLUSTER_COLUMNS)) == plain(layout.clusters(words))
    apart = layout.candidates(words, 2019, texts=True)
    assert plain(both.where("kind <> 'cluster'").select(*apart.columns)) == plain(apart)


def test_one_text_is_described_as_a_list_of_it(spark):
    from kpiforge.schemas import MUST_INCLUDE_EACH

    made = [DescriptionRule(".*of.*", s, m, decay=0.5, hit_decay=0.5, half_life=20.0, free_letters=3, joined=j) for m in (MAY_INCLUDE, MUST_INCLUDE, MUST_INCLUDE_EACH, MUST_EXCLUDE) for s in (300.0, -5.0) for j in (False, True)]
    rules = [KpiRule(1.0, "k", (r,), minimum_description=1.0) for r in made] + [KpiRule(2.0, "k", (made[0], made[2], made[5], r), minimum_description=1.0) for r in made]
    texts = spark.createDataFrame([("one of these",), ("none",), ("",), ("OF",)], "t string")
    for row in texts.select(*[F.array(r.describe_text(F.col("t")), r.describe(F.array("t"))) for r in rules]).collect():
        assert all(one == many for one, many in row)


def test_a_rows_units_are_looked_up_once(monkeypatch):
    laid_out, asked = page(table_rows()), []
    within = Page.within
    monkeypatch.setattr(Page, "within", lambda self, *a, **k: asked.append(a) or within(self, *a, **k))
    reader = Reader(laid_out.tables[0], laid_out, 2019)
    found = list(reader.direct())
    assert len(found) == 9 and len(asked) == 3 and all(c.units == reader.units(c.row) for c in found)


def test_items_level_with_one_are_found_without_looking_at_all():
    import random

    from kpiforge.layout import items

    rng = random.Random(3)
    box = lambda flat: (lambda y: Item(0, [Word(0, 0, "w", 0.0, y, 9.0, y + (0.0 if flat and rng.random() < 0.2 else rng.choice([2.0, 9.5, 12.0, 80.0])), "f", 10, False, 0.0)]))(rng.randint(0, 300) / 2)
    for flat in (False, True):
        held = [box(flat) for _ in range(120)]
        levels = items.Levels(held)
        for one in held[:40] + [box(flat) for _ in range(40)]:
            assert [k for k, i in enumerate(held) if i.level_with(one)] == levels.places(one)
    looked = []
    rows = [Item(k, [Word(k, 0, "w", 0.0, 20.0 * k, 9.0, 20.0 * k + 12, "f", 10, False, 0.0)]) for k in range(400)]
    many = items.Levels(rows)

    class Counted(list):
        def __getitem__(self, k):
            looked.append(k)
            return super().__getitem__(k)

    many._y1 = Counted(many._y1)
    assert all(many.with_(i) == [i] for i in rows) and len(looked) < 5 * len(rows)
