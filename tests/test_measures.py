"""Measures of bare tables: what each way of dating gives, and how often cells move for it."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiforge.operators.rules import DescriptionRule, KpiRule
from kpiforge.plans import rule_based

RULE = KpiRule(6.0, "scope 1", (DescriptionRule(".*scope.*one.*", 600.0), DescriptionRule(".*emission.*", 200.0, decay=0.5)))


def test_cells_move_once_and_are_dated_both_ways(spark):
    table = [["", "2018", "2019"], ["Emissions", "", ""], ["scope one", "1,200", "1,100"], ["scope one", "2017", "8"], ["", "5", "6"], ["other", "7", "8"]]
    rows = [("d", r, c, t) for r, row in enumerate(table) for c, t in enumerate(row) if t] + [("d", 2, 1, "1,150"), ("d", 0, 2, "2016"), ("d", None, 1, "9"), (None, 2, 1, "9"), ("d", 3, None, "77")]
    cells = spark.createDataFrame(rows, "doc string, row int, col int, txt string").repartition(3, "doc")
    both = rule_based.year_measures(cells, [RULE], ["doc"], 2020)
    found = {(r["match_type"], r["row"], r["col"], r["year"], r["value"], round(r["score"], 6)) for r in both.collect()}
    direct = {(2, 1, 2018, "1,150"), (2, 2, 2016, "1,100"), (3, 2, 2016, "8")}
    assert {f[1:5] for f in found if f[0] == "AT.direct"} == direct  # of repeated cells the smallest, of repeated heads too
    assert {f[5] for f in found if f[0] == "AT.direct" and f[1] == 2} == {round(1.2 * (600 + 100 + 100), 6)}
    indirect = {(2, 1, 2020, "1,150"), (2, 1, 2020, "1,200"), (2, 2, 2020, "1,100"), (3, 2, 2017, "8"), (3, None, 2017, "77")}
    assert {f[1:5] for f in found if f[0] == "AT.indirect"} == indirect
    best = rule_based.directory_measures(both.withColumn("pos", F.struct("row", "col", "match_type")), 100.0, ("doc",))
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert {(r["year"], r["value"]) for r in best.collect()} == {(2018, "1,150"), (2016, "1,100")}
    assert plan.count("Exchange") == 1 and "Join" not in plan
