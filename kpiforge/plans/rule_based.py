"""The rule path over reconstructed tables: labels and years to measures."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import page_relative
from ..functions.shape import looks_numeric, looks_year, to_year
from ..operators import layout
from ..operators.filters import ignore_years
from ..operators.joins import by_keys, few_or_by_keys
from ..operators.ranking import best_of_year
from ..operators.rules import KpiRule, anywhere_matches, describe_lists, describe_nodes
from ..staging import staged
from .clusters import cluster_measures

BONUS = 100.0
#: The share of its KPI's best score that a measure needs.
NEAR = 0.75


def labelled_cells(cells: DataFrame, keys: list[str]) -> DataFrame:
    """cells with what the rows of their tables say: _value and _year, a number or a year that a cell is; has_value and years, of the
    cell's row; and nodes, the texts of the row's label cells, nearest first, then, if it has values, those of the last row above
    that has labels but no numbers (its ancestors)."""
    text, year = F.col("txt"), looks_year(F.col("txt"))
    marked = cells.select(
        *keys, "row", "col", "txt", (looks_numeric(text) & ~year).alias("_value"), (~looks_numeric(text) & ~year).alias("_label"), F.when(year, to_year(text)).alias("_year")
    )
    row = Window.partitionBy(*keys, "row").orderBy("col", "txt").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = marked.withColumns({
        "has_value": F.max("_value").over(row), "label": F.array_join(F.collect_list(F.when(F.col("_label"), F.col("txt"))).over(row), " "),
        "years": F.collect_list(F.when(F.col("_year").isNotNull(), F.struct("col", F.col("_year").alias("year")))).over(row),
    })
    # a row with values has none of its own to add, so the frame may end with it
    above = F.last(F.when(~F.col("has_value") & (F.col("label") != ""), F.col("label")), ignorenulls=True).over(Window.partitionBy(*keys).orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("_above", above).withColumn("nodes", F.array_compact(F.array("label", "_above"))).drop("_above", "_label")


def year_measures(cells: DataFrame, rules: list[KpiRule], keys: list[str], default_year: int) -> DataFrame:
    """Measures of tables: a row's label is scored, its values are dated in two ways, each of which gives a measure.

    AT.direct: by the years that head columns; the year row of a value is the last one at or above it. AT.indirect: by the
    nearest year in the row, else the default. kpi_measure's columns but for the place: (*keys, kpi_id, kpi_name, row, col,
    raw_txt, year, value, score, match_type). Of repeated cells the smallest has a direct year. A table's cells meet in windows
    and aren't joined; where they come partitioned by keys, nothing is shuffled.
    """
    known = " and ".join(f"{k} is not null" for k in (*keys, "row"))
    met = labelled_cells(cells, keys).where(known).where((F.col("_value") & (F.col("label") != "")) | (F.col("_year").isNotNull() & ~F.col("has_value")))
    # a row of years has no values, so what a value finds in its column at or above its row is above it
    column = Window.partitionBy(*keys, "col").orderBy("row", F.desc("_year"), "txt")
    before = lambda c: F.lag(c).over(column)
    placed = met.withColumns({
        "_over": F.last("_year", ignorenulls=True).over(column.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "_again": F.coalesce(before("row") == F.col("row"), F.lit(False)),
        "_same": F.coalesce(before("txt") == F.col("txt"), F.lit(False)),
    })
    near = F.when(F.size("years") > 0, F.array_min(F.transform("years", lambda y: F.struct(F.abs(y["col"] - F.col("col")), y["col"], y["year"])))["year"])
    dated = placed.where("_value and not (_again and _same)").select(
        *keys, "row", "col", "nodes", F.col("txt").alias("value"), F.when(~F.col("_again") & F.col("col").isNotNull(), F.col("_over")).alias("_direct"), F.coalesce(near, F.lit(default_year)).alias("_indirect")
    )
    valued = F.coalesce(*[F.when(F.col("kpi_id") == r.kpi_id, r.value_ok(F.col("value"))) for r in rules], F.lit(False))
    # several years in a row speak for it
    more = F.greatest(F.size(F.collect_set("_direct").over(Window.partitionBy(*keys, "row", "kpi_id"))) - 1, F.lit(0))
    told = describe_nodes(dated, rules).where(valued).withColumn("_more", more)
    measure = lambda year, score, kind: F.struct(F.col(year).alias("year"), score.alias("score"), F.lit(kind).alias("match_type"))
    direct = measure("_direct", (F.col("desc_score") + BONUS) * F.pow(F.lit(1.2), F.col("_more")), "AT.direct")
    ways = F.array(measure("_indirect", F.col("desc_score"), "AT.indirect"), F.when(F.col("_direct").isNotNull(), direct))
    both = told.select(*keys, "kpi_id", "kpi_name", "row", "col", F.array_join("nodes", " < ").alias("raw_txt"), "value", F.explode(ways).alias("m")).where("m is not null")
    return both.select(*keys, "kpi_id", "kpi_name", "row", "col", "raw_txt", "m.year", "value", "m.score", "m.match_type")


def direct_year_measures(cells: DataFrame, rules: list[KpiRule], keys: list[str]) -> DataFrame:
    """The measures of tables whose columns are headed by years, see year_measures()."""
    return year_measures(cells, rules, keys, layout.DEFAULT_YEAR).where("match_type = 'AT.direct'")


def indirect_year_measures(cells: DataFrame, rules: list[KpiRule], keys: list[str], default_year: int) -> DataFrame:
    """The measures of tables without year columns, see year_measures()."""
    return year_measures(cells, rules, keys, default_year).where("match_type = 'AT.indirect'")


def directory_measures(measures: DataFrame, minimum: float | None = 500.0, within: tuple[str, ...] = ()) -> DataFrame:
    """The measures of a report's pages made one list: the best of each KPI and year, near its KPI's best, dated ones
    before undated. within: the report's keys, if there are several. measures must have pos, by which the later of equals
    stays; minimum None: scores were looked at before. Only one measure of a KPI and year is left when a KPI's years are
    compared, so these are few."""
    of_kpi = Window.partitionBy(*within, "kpi_name")
    best = best_of_year(measures, within=within).withColumn("_best", F.max("score").over(of_kpi))
    near = best.where((F.col("score") >= (float("-inf") if minimum is None else minimum)) & (F.col("score") >= NEAR * F.col("_best")))
    dated = near.withColumn("_dated", F.max(F.col("year").isNotNull()).over(of_kpi))
    return dated.where(F.col("year").isNotNull() | ~F.col("_dated")).drop("_best", "_dated")


#: What a table's headline counts for, by kind of candidate.
HEADLINE_SHARE = {"direct": 0.5, "indirect": 0.1}


def page_measures(candidates: DataFrame, texts: DataFrame, rules: list[KpiRule]) -> DataFrame:
    """The measures that rules find among the candidates of layout.candidates(), with all of kpi_measure's columns and pos.

    texts: (doc, page, txt, x, y) of the same pages. A candidate's row and column texts are described, its values must have
    the rule's shape, the first fitting text is its unit, its table's headline and all texts of its page add to its score;
    a table whose headline or page excludes a rule has no measure of it. The best of a table's year stays. Candidates that
    fit are kept by the executors (and computed again where one is lost) until the measures are written, see staging.
    """
    by = lambda f: F.coalesce(*[F.when(F.col("kpi_id") == F.lit(float(r.kpi_id)), f(r)) for r in rules])
    keyed = candidates.withColumn("_all", F.concat("nodes", "above")).withColumns({"_list": F.xxhash64("_all"), "_over": F.xxhash64("headline")})
    lists = keyed.select(F.explode(F.array(F.struct(F.col("_list").alias("list_id"), F.col("_all").alias("nodes")), F.struct(F.col("_over").alias("list_id"), F.col("headline").alias("nodes")))).alias("x")).select("x.*")
    told = staged(describe_lists(lists.dropDuplicates(["list_id"]), rules), "lists")
    named = keyed.join(few_or_by_keys(told.where("ok").select(F.col("list_id").alias("_list"), "kpi_id", "kpi_name", F.col("score").alias("desc_score"))), "_list")
    heads = told.select(F.col("list_id").alias("_over"), "kpi_id", F.col("score").alias("_head"))
    named = named.join(few_or_by_keys(heads), ["_over", "kpi_id"], "left").withColumn("_head", F.coalesce("_head", F.lit(0.0)))
    share = F.coalesce(*[F.when(F.col("kind") == k, F.lit(x)) for k, x in HEADLINE_SHARE.items()])
    known = named.withColumns({
        "_fits": by(lambda r: F.forall("values", r.value_ok)), "unit": by(lambda r: F.get(F.filter("units", r.unit_ok), F.lit(0))),
        "_least": by(lambda r: F.lit(float(r.minimum_score))), "page_diag": F.sqrt(F.col("page_width") ** 2 + F.col("page_height") ** 2),
    })
    # few candidates fit any rule; they are read three times from here on
    judged = known.where("_head >= 0 and _fits and unit is not null").persist(StorageLevel.MEMORY_AND_DISK)
    page = ["doc", "page"]
    asked = judged.select(*page, "kpi_id", "item_id", "x", "y", "page_diag").distinct()
    found = anywhere_matches(asked, texts.select(*page, "txt", "x", "y"), rules, page).select(*page, "kpi_id", "item_id", "anywhere_ok", "anywhere_score")
    table = [*page, "table_id", "kind", "kpi_id"]
    met = judged.join(by_keys(found), [*page, "kpi_id", "item_id"]).withColumn("_page_ok", F.min("anywhere_ok").over(Window.partitionBy(*table))).where("_page_ok")
    total = F.col("desc_score") + share * F.col("_head") + F.col("anywhere_score") + F.when(F.col("kind") == "direct", BONUS).otherwise(0.0)
    scored = met.withColumn("score", total).where(F.col("score") >= F.col("_least"))
    ranked = scored.withColumn("pos", F.struct("page", "table_id", "kind", "row", "col"))
    best = best_of_year(ranked, within=(*page, "table_id", "kind"))
    # several years in a row speak for it: a direct row counts its values, an indirect one the years that stayed
    rows = best.withColumn("_years", F.size(F.collect_set("year").over(Window.partitionBy(*table, "row"))))
    more = F.when(F.col("kind") == "direct", F.size("values")).otherwise(F.col("_years")) - 1
    pos_x, pos_y = page_relative(F.col("x"), F.col("y"), F.col("page_width"), F.col("page_height"))
    measures = rows.select(
        "kpi_id", "kpi_name", F.col("doc").alias("src_file"), F.col("page").alias("page_num"), F.array("item_id").alias("item_ids"), pos_x.alias("pos_x"), pos_y.alias("pos_y"), F.col("txt").alias("raw_txt"),
        "year", F.trim("txt").alias("value"), (F.col("score") * F.pow(F.lit(1.2), F.greatest(more, F.lit(0)))).alias("score"), "unit", F.concat(F.lit("AT."), F.col("kind")).alias("match_type"), "pos",
    )
    written = staged(measures, "measures")
    judged.unpersist()
    return written


def report_measures(words: DataFrame, rules: list[KpiRule], default_year: int = layout.DEFAULT_YEAR, clusters: bool = False, without_years: bool = False, two_pages: bool = False) -> DataFrame:
    """kpi_measure of all reports: from positioned words (see readers.WORDS) to each report's best measures.

    clusters: also values among texts that stand together outside tables; without_years: all years unknown; two_pages: tables may go on on the next page.
    What pages give is kept by the executors as well, since candidates and texts are read apart, until the best are written; with
    clusters, which are larger, it is written, so that pages are laid out once for all.
    """
    pages = layout.stacked(words) if two_pages else words
    if clusters:
        laid_out = staged(layout.candidates_and_clusters(pages, default_year), "pages")
    else:
        laid_out = layout.candidates(pages, default_year, texts=True).persist(StorageLevel.MEMORY_AND_DISK)
    texts = laid_out.where("kind = 'text'")
    found = page_measures(laid_out.where("kind not in ('text', 'cluster')"), texts, rules)
    if clusters:
        found = found.unionByName(cluster_measures(laid_out.where("kind = 'cluster'").select(*layout.CLUSTER_COLUMNS), texts, rules))
    found = ignore_years(found) if without_years else found
    best = directory_measures(found, None, ("src_file",)).drop("pos")
    laid_out.unpersist()
    return best
