"""What plans look like where a wrong one fails on large tables only, and results that must not hang on it."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from kpiforge.functions import positions
from kpiforge.layout.items import Item, Word
from kpiforge.layout.page import Page
from kpiforge.operators.rules import anywhere_matches
from kpiforge.queries import QUERIES
from kpiforge.rules.catalogue import ACTIVE

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_items_and_words_of_pages_are_not_broadcast(spark):
    assert "BroadcastHashJoin" not in _plan(QUERIES["answer_coordinates"](spark, SF))


def test_what_texts_of_pages_say_is_not_broadcast(spark):
    page = spark.range(3).select(F.lit("a").alias("doc"), F.col("id").cast("int").alias("page"), F.lit(1).alias("item_id"), F.lit("emissions").alias("txt"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    values = page.drop("txt").withColumns({"kpi_id": F.lit(float(ACTIVE[0].kpi_id)), "page_diag": F.lit(1.0)})
    assert "BroadcastHashJoin" not in _plan(anywhere_matches(values, page, list(ACTIVE), ["doc", "page"]))


def test_rows_of_a_page_are_not_found_by_comparing_all_items(monkeypatch):
    asked = []
    level = Item.level_with
    monkeypatch.setattr(Item, "level_with", lambda a, b: asked.append(1) or level(a, b))
    word = lambda k, t, x, y: Word(k, 0, t, x, y, x + 6.0 * len(t), y + 12, "f", 10, False)
    words = [word(10 * r + c, "label" if c == 0 else f"{r}.{c}", 50.0 + 100 * c, 20.0 * r) for r in range(64) for c in range(4)]
    found = Page(words, 609.0, 2600.0).tables
    assert [t.shape() for t in found] == [(64, 4, 256)] and len(asked) < 100 * len(words)


def test_offsets_of_a_long_text_do_not_copy_all_before_each(spark):
    text = spark.range(1).select(F.repeat(F.lit("an a "), 200_000).alias("t"))
    began = time.perf_counter()
    found = text.select(positions.find_all(F.col("t"), F.lit("a")).alias("o")).select(F.size("o").alias("n"), F.get("o", F.lit(399_999)).alias("last"), F.get("o", F.lit(2)).alias("third")).first()
    assert tuple(found) == (400_000, 999_998, 5) and time.perf_counter() - began < 60
