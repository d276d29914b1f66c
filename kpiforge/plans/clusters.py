"""The cluster path: measures among texts that stand together, tables or not.

Every node of a page's cluster tree whose texts satisfy a KPI is searched for
the few of them that the KPI needs; value, unit and year are those nearest to
them, and what stands between all of these is scored again. Numbers within the
texts themselves, such as that of a scope, are values only if there is no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import page_relative
from ..functions.shape import looks_year, to_year
from ..operators.clusters import around, by_kpi, fewest_texts, flat_text, inside, nearest_text, once, settled
from ..operators.rules import KpiRule, anywhere_matches, describe_nodes
from ..staging import staged

PAGE = ["doc", "page"]


def node_items(nodes: DataFrame, items: DataFrame, rules: list[KpiRule]) -> DataFrame:
    """nodes (doc, page, node, item_ids, flat_text) that satisfy any rule, with their items in reading order.

    The items of all other nodes are not looked up: a page's nodes have its items many times over.
    """
    some = describe_nodes(nodes, rules, "flat_text")
    wanted = some.select(*PAGE, "node", "item_ids").dropDuplicates([*PAGE, "node"])
    item = F.struct("item_id", "txt", "x0", "y0", "x1", "y1", "words")
    met = wanted.select(*PAGE, "node", F.explode("item_ids").alias("item_id")).join(items, [*PAGE, "item_id"])
    return met.groupBy(*PAGE, "node").agg(F.sort_array(F.collect_list(item)).alias("items"), F.first("page_width").alias("page_width"), F.first("page_height").alias("page_height"))


def cluster_measures(laid_out: DataFrame, texts: DataFrame, rules: list[KpiRule]) -> DataFrame:
    """kpi_measure of the clusters of pages, with pos, before a report's best are chosen.

    laid_out: layout.clusters(); texts: (doc, page, txt, x, y) of the same pages. A measure without a year has none; a page
    with a text that rules a KPI out has no measure of it. Its items are those between its texts, value, unit and year.
    """
    nodes, items = laid_out.where("node is not null"), laid_out.where("node is null").drop("node", "item_ids", "flat_text")
    few = fewest_texts(node_items(nodes, items, rules), rules)
    few = settled(few, _box=around(F.col("kept")))
    all_items, box = F.col("items"), F.col("_box")
    beside = lambda i: ~F.exists("kept", lambda k: k["item_id"] == i["item_id"])
    near = settled(
        few,
        _value=by_kpi(rules, lambda r: nearest_text(all_items, box, r.value_ok, r.year, beside)),
        _own=by_kpi(rules, lambda r: nearest_text(F.col("kept"), box, r.value_ok, r.year)),
        _unit=by_kpi(rules, lambda r: nearest_text(all_items, box, r.unit_ok) if r.units else F.lit(None)),
        _year=nearest_text(all_items, box, looks_year, True),
        _united=by_kpi(rules, lambda r: F.lit(not r.units)),
    )
    place = lambda at: F.array_position(F.transform(all_items, lambda i: i["item_id"]), at).cast("int") - 1
    near = settled(near, _value=F.coalesce("_value", F.col("_own").withField("at", place(F.col("_own.item_id")))))
    found = near.where("_value is not null and (_united or _unit is not null)")
    places = F.array_compact(F.array("_value.at", "_unit.at", "_year.at"))
    between = settled(found, _box=around(F.concat("kept", F.transform(places, lambda k: F.get(all_items, k)))))
    within = settled(between, _in=inside(all_items, box))
    told = settled(within, _m=by_kpi(rules, lambda r: once(flat_text(F.col("_in")), r.describe_text))).where("_m.ok")
    told = staged(told.drop("items", "kept"), "cluster_texts")  # few, and read twice by each step of choosing a report's best
    told = told.withColumn("page_diag", F.sqrt(F.col("page_width") ** 2 + F.col("page_height") ** 2))
    each = told.select(*PAGE, "node", "kpi_id", "page_diag", F.explode("_in").alias("i")).select(*PAGE, "node", "kpi_id", "page_diag", "i.item_id", F.col("i.x0").alias("x"), F.col("i.y0").alias("y"))
    asked = each.drop("node").distinct()
    seen = anywhere_matches(asked, texts.select(*PAGE, "txt", "x", "y"), rules, PAGE).select(*PAGE, "kpi_id", "item_id", "anywhere_ok", "anywhere_score")
    by_node = each.join(seen, [*PAGE, "kpi_id", "item_id"]).groupBy(*PAGE, "node", "kpi_id").agg(F.bool_and("anywhere_ok").alias("_ok"), F.min("anywhere_score").alias("_more"))
    by_node = by_node.withColumn("_page_ok", F.bool_and("_ok").over(Window.partitionBy(*PAGE, "kpi_id"))).where("_page_ok")
    scored = told.join(by_node, [*PAGE, "node", "kpi_id"]).withColumn("score", F.col("_m.score") + F.col("_more"))
    pos_x, pos_y = page_relative(F.col("_value.x0"), F.col("_value.y0"), F.col("page_width"), F.col("page_height"))
    return scored.where(F.col("score") >= by_kpi(rules, lambda r: F.lit(float(r.minimum_score)))).select(
        "kpi_id", "kpi_name", F.col("doc").alias("src_file"), F.col("page").alias("page_num"), F.transform("_in", lambda i: i["item_id"]).alias("item_ids"), pos_x.alias("pos_x"), pos_y.alias("pos_y"),
        F.col("_value.txt").alias("raw_txt"), to_year(F.col("_year.txt")).alias("year"), F.trim("_value.txt").alias("value"), "score", F.coalesce("_unit.txt", F.lit("")).alias("unit"), F.lit("AC.default").alias("match_type"),
        F.struct("page", F.lit(-1).alias("table_id"), F.lit("cluster").alias("kind"), F.col("node").alias("row"), F.lit(0).alias("col")).alias("pos"),
    )
