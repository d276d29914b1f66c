"""Texts of a cluster that a KPI needs, and what stands nearest to them, as column expressions over arrays of items.

An item is a struct with item_id, txt, x0, y0, x1, y1 and words, an array of struct(word_idx, txt, x0, y0, x1, y1).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.shape import without_years
from .rules import KpiRule, describe_nodes


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use() names it."""
    return F.transform(F.array(value), use)[0]


def flat_text(items: Column) -> Column:
    """The items' texts as one; null texts are left out."""
    return F.array_join(F.transform(items, lambda i: i["txt"]), " ")


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed here alone: what is asked of them later is neither moved below nor does it repeat them."""
    own = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return df.select("*", own.alias("_settled")).select(*[F.col(c) for c in df.columns if c not in columns], "_settled.*")


def by_kpi(rules: list[KpiRule], use: Callable[[KpiRule], Column]) -> Column:
    """use() of the rule of the row's kpi_id; only that one is computed."""
    return F.coalesce(*[F.when(F.col("kpi_id") == F.lit(float(r.kpi_id)), use(r)) for r in rules])


def fewest_texts(lists: DataFrame, rules: list[KpiRule], column: str = "items") -> DataFrame:
    """lists with a row for each KPI whose description their texts satisfy as one text: kpi_id, kpi_name, base_score, and in
    kept and kept_score the items that are left, in order, and what they score.

    From the last item to the first, an item leaves if the others still satisfy the KPI and score no less without it; one
    always stays. Of texts that do each other's work the first one stays. Lists that are null or empty have no row, equal
    lists a row each.
    """
    ready = lists.where(F.size(column) > 0).withColumn("_flat", flat_text(F.col(column)))
    met = describe_nodes(ready, rules, "_flat").drop("_flat").withColumnRenamed("desc_score", "base_score").withColumn("kpi_id", F.col("kpi_id").cast("double"))
    item = lambda i: F.get(F.col(column), i)

    def search(rule: KpiRule) -> Column:
        def step(state: Column, i: Column) -> Column:
            def tried(rest: Column) -> Column:
                told = once(F.array_join(F.transform(rest, lambda k: item(k)["txt"]), " "), rule.describe_text)
                better = lambda m: F.when(m["ok"] & (F.size(rest) > 0) & (m["score"] >= state["score"]), F.struct(rest.alias("kept"), m["score"].alias("score"))).otherwise(state)
                return once(told, better)

            return once(F.array_remove(state["kept"], i), tried)

        places = F.sequence(F.lit(0), F.size(column) - 1)
        return F.aggregate(F.reverse(places), F.struct(places.alias("kept"), F.col("base_score").alias("score")), step)

    found = settled(met, _found=by_kpi(rules, search))
    return settled(found, kept=F.transform("_found.kept", item), kept_score=F.col("_found.score")).drop("_found")


def around(items: Column) -> Column:
    """struct(x0, y0, x1, y1): the box around items."""
    least, most = (lambda c: F.array_min(F.transform(items, lambda i: i[c]))), (lambda c: F.array_max(F.transform(items, lambda i: i[c])))
    return F.struct(least("x0").alias("x0"), least("y0").alias("y0"), most("x1").alias("x1"), most("y1").alias("y1"))


def nearest_text(items: Column, box: Column, fits: Callable[[Column], Column], years: bool = False, among: Callable[[Column], Column] | None = None) -> Column:
    """struct(far, at, word_idx, item_id, txt, x0, y0): the fitting item, or word of an item that doesn't fit itself, whose centre
    is nearest to that of the box; of equals the first. Null if none fits. years: texts that are a year may fit, too; among: which items may."""
    shown = (lambda t: t) if years else without_years
    suits = lambda t: once(shown(t), lambda s: (F.length(s) > 0) & fits(s))
    middle = lambda b, c: (b[f"{c}0"] + b[f"{c}1"]) / 2

    def spot(at: Column, word: Column, item: Column, b: Column) -> Column:
        far = F.sqrt((middle(b, "x") - middle(box, "x")) ** 2 + (middle(b, "y") - middle(box, "y")) ** 2)
        return F.struct(far.alias("far"), at.alias("at"), word.alias("word_idx"), item["item_id"].alias("item_id"), b["txt"].alias("txt"), b["x0"].alias("x0"), b["y0"].alias("y0"))

    def spots(item: Column, at: Column) -> Column:
        words = F.transform(F.filter(item["words"], lambda w: suits(w["txt"])), lambda w: spot(at, w["word_idx"], item, w))
        found = F.when(suits(item["txt"]), F.array(spot(at, F.lit(-1), item, item))).otherwise(words)
        return found if among is None else F.when(among(item), found).otherwise(F.filter(words, lambda w: F.lit(False)))

    return F.array_min(F.flatten(F.transform(items, spots)))


def inside(items: Column, box: Column, share: float = 0.3) -> Column:
    """The items with more than a share of their area in a box."""
    side = lambda i, c: F.greatest(F.least(i[f"{c}1"], box[f"{c}1"]) - F.greatest(i[f"{c}0"], box[f"{c}0"]), F.lit(0.0))
    return F.filter(items, lambda i: side(i, "x") * side(i, "y") > share * (i["x1"] - i["x0"]) * (i["y1"] - i["y0"]))
