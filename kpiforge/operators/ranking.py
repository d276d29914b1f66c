"""Aggregates, ranks, top-k and neighbours, with explicit keys for ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import NO_ANSWER


def group_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key: the first non-null value of every other column, in order."""
    place = F.struct(*order)
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in rest])


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key, in order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_k", rank).where("_k = 1").drop("_k")


def top_k(df: DataFrame, keys: list[str], k: int, score: str = "score", tie: tuple[str, ...] = ("pos",)) -> DataFrame:
    """The k best scores of each key; null scores do not count, ties go to the smaller tie columns."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), *tie))
    return df.where(F.col(score).isNotNull()).withColumn("_k", rank).where(F.col("_k") <= k).drop("_k")


def best_of_year(measures: DataFrame, pos: str = "pos", within: tuple[str, ...] = ()) -> DataFrame:
    """The best measure of each (kpi_name, year), within further keys; of equal scores the later one."""
    return keep_first(measures, [*within, "kpi_name", "year"], [F.desc("score"), F.desc(pos)])


def no_answers(answers: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose first-ranked answers are all 'no answer', with the greatest of their scores as theirs.

    answers: (*keys, rank from 1, answer, score).
    """
    first = F.col("rank") == 1
    agg = answers.where(first).groupBy(*keys).agg(F.bool_and(F.col("answer") == NO_ANSWER).alias("_none"), F.max("score").alias("score"))
    return agg.where("_none").select(*keys, F.lit(NO_ANSWER).alias("answer"), "score", F.lit("Text").alias("source"))


def nearest(df: DataFrame, keys: list[str], distance: Column, tie: str) -> DataFrame:
    """The row of each key with the smallest distance; ties go to the smaller tie column."""
    return keep_first(df.withColumn("_d", distance), keys, ["_d", tie]).drop("_d")


def last_at_or_before(rows: DataFrame, marks: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """As-of join: each row with the value of the last mark of its key that is not behind it; null if there is none.

    marks must be unique by (keys, at).
    """
    all_rows = rows.select(*keys, at, F.lit(1).alias("_side"), F.lit(None).cast(marks.schema[value].dataType).alias("_v"), *[c for c in rows.columns if c not in (*keys, at)])
    both = all_rows.unionByName(marks.select(*keys, at, F.lit(0).alias("_side"), F.col(value).alias("_v")), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn(value, F.last("_v", ignorenulls=True).over(w)).where("_side = 1").drop("_side", "_v")


def step_runs(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Gaps and islands: run numbers of consecutive values that change by +1 all along, or by -1; null values break runs."""
    w = Window.partitionBy(*keys).orderBy(order)
    step = F.col(value) - F.lag(value).over(w)
    stepped = df.withColumn("_s", F.when(step.isin(1, -1), step))
    broken = F.col("_s").isNull() | ((F.lag("_s").over(w) != F.col("_s")) & F.lag("_s").over(w).isNotNull())
    return stepped.withColumn("run", F.sum(broken.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_s")


def header_gaps(rows: DataFrame, keys: list[str], order: str, y: str) -> DataFrame:
    """Rows whose gap to the row before is clearly larger than the gap before that: a new header may begin there."""
    w = Window.partitionBy(*keys).orderBy(order)
    gapped = rows.withColumn("gap", F.col(y) - F.lag(y).over(w)).withColumn("gap_before", F.lag("gap").over(w))
    return gapped.withColumn("new_header", F.coalesce(F.col("gap") > 1.05 * F.col("gap_before") + 2, F.lit(False)))


def year_multiplier(measures: DataFrame, keys: list[str]) -> DataFrame:
    """Scores times 1.2 for every further distinct year that a row of a table has."""
    years = measures.groupBy(*keys).agg(F.size(F.collect_set("year")).alias("_n"))
    return measures.join(years, keys).withColumn("score", F.col("score") * F.pow(F.lit(1.2), F.greatest(F.col("_n") - 1, F.lit(0)))).drop("_n")


def max_line_gap(lines: DataFrame, keys: list[str], gap: str, factor: float = 1.1) -> DataFrame:
    """The greatest gap between two lines of a column: the median gap and a little more."""
    return lines.groupBy(*keys).agg((F.expr(f"percentile({gap}, 0.5)") * factor).alias("max_gap"))


def column_alignment(items: DataFrame, keys: list[str]) -> DataFrame:
    """The alignment (0 left, 1 right, 2 centre) that most items of a column have; ties go left, then right; and its mean x."""
    n = [F.sum((F.col("alignment") == a).cast("int")) for a in range(3)]
    x = [F.avg(F.when(F.col("alignment") == a, c)) for a, c in enumerate((F.col("x0"), F.col("x1"), (F.col("x0") + F.col("x1")) / 2))]
    agg = items.groupBy(*keys).agg(*[c.alias(f"n{a}") for a, c in enumerate(n)], *[c.alias(f"m{a}") for a, c in enumerate(x)])
    pick = F.when((F.col("n0") >= F.col("n1")) & (F.col("n0") >= F.col("n2")), 0).when(F.col("n1") >= F.col("n2"), 1).otherwise(2)
    return agg.withColumn("alignment", pick).select(*keys, "alignment", F.coalesce(F.when(F.col("alignment") == 0, F.col("m0")).when(F.col("alignment") == 1, F.col("m1")).otherwise(F.col("m2")), F.lit(-1.0)).alias("mean_x"))


def paragraph_columns(items: DataFrame, keys: list[str], more_than: int = 5) -> DataFrame:
    """The x where so many running texts and headlines begin that a column of paragraphs starts there."""
    return items.groupBy(*keys, "x0").agg(F.count("*").alias("n")).where(F.col("n") > more_than)


def good_tables(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, columns, density and numeric cells of tables, and whether they look like tables at all.

    Fixed values: so many cells, so dense, and so many numbers make a table; more special texts (role 'special', where
    cells have roles) than a third of a large table unmake it.
    """
    from ..functions.shape import looks_numeric, looks_weak_numeric, looks_year

    text = F.col("txt")
    is_cell = F.col("role") == "cell" if "role" in cells.columns else F.lit(True)
    number = is_cell & looks_numeric(text) & ~looks_year(text)
    count = lambda c: F.sum(c.cast("int"))
    # cells are shuffled once, without their texts: where a table is whole, the first cell of each row and of each column is counted
    rows = cells.select(*keys, F.when(is_cell, F.col("row")).alias("row"), F.when(is_cell, F.col("col")).alias("col"), is_cell.alias("_cell"), number.alias("_number"), (number | (is_cell & looks_weak_numeric(text))).alias("_weak"))
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number: tables' cells are small as bytes but are sorted
    whole = rows.repartition(parts, *keys).groupBy(*keys, "row", "col").agg(
        count(F.col("_cell")).alias("n_cells"), count(F.col("_number")).alias("n_numeric"), count(F.col("_weak")).alias("n_weak"), count(~F.col("_cell")).alias("_special")
    )
    first = lambda a, b: F.col(a).isNotNull() & (F.row_number().over(Window.partitionBy(*keys, a).orderBy(b)) == 1)
    marked = whole.withColumns({"_row": first("row", "col"), "_col": first("col", "row")})
    agg = marked.groupBy(*keys).agg(count(F.col("_row")).alias("n_rows"), count(F.col("_col")).alias("n_cols"), *[F.sum(c).alias(c) for c in ("n_cells", "n_numeric", "n_weak", "_special")])
    n, numbers, weak, density = (F.col(c) for c in ("n_cells", "n_numeric", "n_weak", "density"))
    dense = ((numbers > 3) & (density > 0.6)) | ((numbers > 7) & (density > 0.4)) | (numbers > 10) | ((weak > 3) & (n > 5) & (density > 0.4))
    fit = (F.col("n_rows") >= 2) & (F.col("n_cols") >= 2) & (n >= 4) & (density >= 0.2) & ~((F.col("_special") > 0.33 * n) & (n > 50))
    return agg.withColumn("density", F.try_divide(n, F.col("n_rows") * F.col("n_cols"))).withColumn("good", fit & dense).drop("_special")


def year_cells(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a table that are year rows, with a map from year to the first column that shows it.

    A row with any number that is no year is none.
    """
    from ..functions.shape import looks_numeric, looks_year, to_year

    year = F.when(looks_year(F.col("txt")), to_year(F.col("txt")))
    marked = cells.select(*keys, "row", "col", year.alias("year"), (looks_numeric(F.col("txt")) & ~looks_year(F.col("txt"))).alias("other"))
    clean = marked.withColumn("void", F.max("other").over(Window.partitionBy(*keys, "row"))).where(F.col("year").isNotNull() & ~F.col("void"))
    firsts = clean.groupBy(*keys, "row", "year").agg(F.min("col").alias("col"))
    return firsts.groupBy(*keys, "row").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("year", "col")))).alias("year_cols"))
