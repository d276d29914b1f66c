"""Queries of functions and small operators over the driver's tables, and their SQL. They register beside those of queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geometry, positions, shape, text
from .operators import filters, joins, metrics, ranking
from .queries import ANN_SQL, _CELL_SQL, _RECT_SQL, _SQL_LETTERS, _SQL_NUMERALS, _WORD_SQL, _items, _words, query
from .tables import annotations, paragraphs, read

_DAY, _YEAR_FIRST = (p.replace(r"\\/", r"\/") for p in (shape.DAY_FIRST, shape.YEAR_FIRST))
_L, _N = _SQL_LETTERS.format("w"), _SQL_NUMERALS.format("w")
_WHOLE = r"regexp_extract(replace(w, ' ', ''), '{0}', 1)"
_KEPT = r"regexp_replace(w, '[^0-9\-.]', '', 'g')"
_NUMBER = f"CASE WHEN strpos({_KEPT}, '.') = 0 THEN {_KEPT} ELSE substr({_KEPT}, 1, strpos({_KEPT}, '.')) || replace(substr({_KEPT}, strpos({_KEPT}, '.') + 1), '.', '') END"


@query(rf"""WITH {_WORD_SQL} SELECT w, n, len(w) > 0 AND regexp_full_match(translate(w, ' ()$%', ''), '(?:{shape.NUMBER})+') AS several_numbers,
  {_L} > 0 AND {_L} > {_N} AND ((len(w) - {_N} > 1 AND {_N} < 2 * (len(w) - {_N}) + 1) OR len(w) - {_N} > {_N}) AS weak_non_numeric,
  coalesce(TRY_CAST(nullif({_WHOLE.format(_DAY)}, '') AS INTEGER), TRY_CAST(nullif({_WHOLE.format(_YEAR_FIRST)}, '') AS INTEGER),
    CASE WHEN regexp_full_match(replace(w, ' ', ''), '{shape.YEAR[1:-1]}') THEN TRY_CAST(nullif(regexp_extract(regexp_replace(w, '[^0-9]', '', 'g'), '^[0-9]{{4}}'), '') AS INTEGER) END) AS any_year,
  CAST(trunc(TRY_CAST({_NUMBER} AS DOUBLE)) AS BIGINT) AS whole, CASE WHEN regexp_full_match(w, '{shape.YEAR[1:-1]}') THEN '' ELSE w END AS no_year FROM distinct_words WHERE len({_KEPT}) < 16""")  # fmt: skip
def word_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of numbers, prevailing letters, years within dates, and whole numbers of every distinct word."""
    w = F.col("w")
    short = _words(spark, sf_dir).where(F.length(F.regexp_replace("w", r"[^0-9\-.]", "")) < 16)
    return short.select(
        "w", "n", shape.looks_numeric_multiple(w).alias("several_numbers"), shape.looks_weak_non_numeric(w).alias("weak_non_numeric"), shape.year_extended(w).alias("any_year"), shape.to_int_number(w).alias("whole"), shape.without_years(w).alias("no_year")
    )


@query("""WITH p AS (SELECT doc_id, 'reports/' || coalesce(source, 'none') || '/doc[' || doc_id || '].pdf' AS path FROM documents)
  SELECT doc_id, split_part(path, '/', 2) AS company, translate(path, '[]()', '____') AS safe, regexp_replace(path || '/', '/$', '') AS bare, 'doc[' || doc_id || ']' AS stem,
    'Total of ' || doc_id || '?' AS question, CAST(doc_id AS VARCHAR) AS kpi, CAST(doc_id // 3 AS INTEGER) AS number FROM p""")
def names_and_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of paths, safe names, questions without their year, labels of KPIs."""
    d = read(spark, sf_dir, "documents")
    ident = F.col("doc_id").cast("string")
    path = F.concat(F.lit("reports/"), F.coalesce("source", F.lit("none")), F.lit("/doc["), ident, F.lit("].pdf"))
    asked = F.concat(F.lit("Total of "), ident, F.lit(" in year 2019?"))
    return d.select(
        "doc_id", text.company_of(path).alias("company"), text.safe_file_name(path).alias("safe"), text.without_trailing_slash(F.concat(path, F.lit("/"))).alias("bare"), text.file_stem(path).alias("stem"),
        text.question_key(asked).alias("question"), text.kpi_label(F.col("doc_id").cast("double")).alias("kpi"), shape.int_or(F.floor(F.col("doc_id") / 3).cast("string"), 0).alias("number"),
    )


_FLAT = "CASE WHEN abs(bx - ax) > abs(by_ - ay) THEN sqrt(power(abs(bx - ax) * 0.01, 2) + power(abs(by_ - ay), 2)) ELSE sqrt(power(abs(bx - ax), 2) + power(abs(by_ - ay) * 0.01, 2)) END"


@query(f"""WITH {_RECT_SQL}, p AS (SELECT *, x0 AS ax, y0 AS ay, 25.0 AS bx, 30.0 AS by_, item % 3 AS al FROM i)
  SELECT page, item, round(sqrt(power(bx - ax, 2) + power(by_ - ay, 2)), 6) AS straight,
    round(CASE WHEN ax < bx - 2 AND ay < by_ - 2 THEN 90 WHEN ax < bx - 2 OR ay < by_ - 2 THEN 50 ELSE 1 END * {_FLAT}, 6) AS weighted,
    round(CASE WHEN ay < by_ THEN -1 ELSE CASE WHEN ax < bx - 2 THEN 50 ELSE 1 END * {_FLAT} END, 6) AS up_only,
    round(CASE al WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE (x0 + x1) * 0.5 END, 6) AS aligned, round(x0 / 50, 6) AS rel_x, round(CASE WHEN y0 > 40 THEN y0 - 40 ELSE y0 END / 40, 6) AS rel_y,
    CAST(-(item * 10) - CASE WHEN item % 2 = 0 THEN 5 ELSE 0 END + 0.5 AS DOUBLE) AS depth, 'f|' || item || '|' || CAST(item % 2 = 0 AS INTEGER) || '|0.50' AS font FROM p""")  # fmt: skip
def places_on_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances, aligned places, shares of the page, ranks and identities of type."""
    i = _items(spark, sf_dir)
    x, y, bx, by = F.col("x0"), F.col("y0"), F.lit(25.0), F.lit(30.0)
    bold = F.col("item") % 2 == 0
    rel_x, rel_y = geometry.page_relative(x, y, F.lit(50.0), F.lit(40.0))
    r = lambda c, n: F.round(c, 6).alias(n)
    return i.select(
        "page", "item", r(geometry.point_distance(x, y, bx, by), "straight"), r(geometry.weighted_distance(x, y, bx, by, F.lit(2.0)), "weighted"), r(geometry.weighted_distance(x, y, bx, by, F.lit(2.0), True), "up_only"),
        r(geometry.aligned_x(geometry.Rect.of(), F.col("item") % 3), "aligned"), r(rel_x, "rel_x"), r(rel_y, "rel_y"), geometry.depth(F.col("item"), bold, F.lit(0.5)).cast("double").alias("depth"),
        geometry.font_id(F.lit("f"), F.col("item"), bold, F.lit(0.5)).alias("font"),
    )


@query("""SELECT l_orderkey AS o, l_linenumber AS l, l_quantity AS q, CAST(CASE WHEN CAST(l_quantity AS BIGINT) % 12 >= l_linenumber THEN 1 ELSE 0 END + CASE WHEN CAST(l_quantity AS BIGINT) % 12 >= l_linenumber + 3 THEN 1 ELSE 0 END
  + CASE WHEN CAST(l_quantity AS BIGINT) % 12 >= l_linenumber + 8 THEN 1 ELSE 0 END AS INTEGER) AS chunk FROM lineitem""")
def glyph_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which chunk of glyphs holds a character."""
    li = read(spark, sf_dir, "lineitem")
    widths = F.array(F.col("l_linenumber").cast("int"), F.lit(3), F.lit(5))
    return li.select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l"), F.col("l_quantity").alias("q"), positions.glyph_at(widths, F.col("l_quantity").cast("long") % 12).cast("int").alias("chunk"))


@query("""WITH g AS (SELECT user_id, event_id, value, value - lag(value) OVER w AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
  b AS (SELECT *, lag(gap) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM g) SELECT user_id, event_id, coalesce(gap > 1.05 * before + 2, false) AS new_header FROM b""")
def header_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that stand clearly further off than the one before did."""
    rows = read(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return ranking.header_gaps(rows, ["user_id"], "event_id", "value").select("user_id", "event_id", "new_header")


@query(f"""WITH {_RECT_SQL}, c AS (SELECT page, count(*) FILTER (item % 3 = 0) AS n0, count(*) FILTER (item % 3 = 1) AS n1, count(*) FILTER (item % 3 = 2) AS n2, avg(x0) FILTER (item % 3 = 0) AS m0,
    avg(x1) FILTER (item % 3 = 1) AS m1, avg((x0 + x1) / 2) FILTER (item % 3 = 2) AS m2 FROM i GROUP BY page), a AS (SELECT *, CASE WHEN n0 >= n1 AND n0 >= n2 THEN 0 WHEN n1 >= n2 THEN 1 ELSE 2 END AS alignment FROM c)
  SELECT page, alignment, round(coalesce(CASE alignment WHEN 0 THEN m0 WHEN 1 THEN m1 ELSE m2 END, -1), 6) AS mean_x FROM a""")  # fmt: skip
def column_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignment that most items of a page have, and their mean place."""
    items = _items(spark, sf_dir).withColumn("alignment", (F.col("item") % 3).cast("int"))
    return ranking.column_alignment(items, ["page"]).select("page", "alignment", F.round("mean_x", 6).alias("mean_x"))


@query(f"WITH {_RECT_SQL} SELECT page, x0, count(*) AS n FROM i GROUP BY page, x0 HAVING count(*) > 1")
def paragraph_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where several items of a page begin."""
    return ranking.paragraph_columns(_items(spark, sf_dir), ["page"], 1)


_YEAR_CELL_SQL = _CELL_SQL.replace("[l_linestatus, CAST(l_quantity AS VARCHAR),", "[l_linestatus, CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_quantity AS VARCHAR) ELSE CAST(year(l_shipdate) + l_linenumber % 2 AS VARCHAR) END,").replace("l_linenumber = 1 THEN", "l_linenumber % 3 > 0 THEN")


@query(f"WITH {_YEAR_CELL_SQL}, c AS (SELECT t, row, col, min(txt) AS txt FROM cells GROUP BY ALL) SELECT t, row, CAST(txt AS INTEGER) AS year, min(col) AS col FROM c WHERE row % 3 > 0 AND col > 0 GROUP BY ALL")
def year_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of years, with the first column of each."""
    year = F.year("l_shipdate")
    is_year = F.col("l_linenumber") % 3 > 0
    texts = F.array("l_linestatus", F.when(is_year, (year + F.col("l_linenumber") % 2).cast("string")).otherwise(F.col("l_quantity").cast("string")), F.when(is_year, year.cast("string")).otherwise(F.col("l_tax").cast("string")))
    cells = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("t"), F.col("l_linenumber").alias("row"), F.posexplode(texts).alias("col", "txt"))
    rows = ranking.year_cells(cells.groupBy("t", "row", "col").agg(F.min("txt").alias("txt")), ["t"])
    return rows.select("t", "row", F.explode("year_cols").alias("year", "col"))


@query("""WITH t AS (SELECT l_orderkey AS o, l_linenumber AS l, l_suppkey % 50 AS b, l_suppkey % 50 + CAST(l_quantity AS BIGINT) AS e FROM lineitem)
  SELECT a.o, a.l AS a, b.l AS b FROM t a JOIN t b ON a.o = b.o AND a.l <> b.l AND a.b <= b.b AND b.e <= a.e""")
def covered_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals that another one covers."""
    begin = F.col("l_suppkey") % 50
    li = read(spark, sf_dir, "lineitem")
    side = lambda p: li.select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias(p), begin.alias(f"{p}_begin"), (begin + F.col("l_quantity").cast("long")).alias(f"{p}_end"))
    return joins.covered(side("a"), side("b"), "o").where("a <> b").select("o", "a", "b")


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'doc' || doc_id || '.json' WHEN 1 THEN CASE WHEN source IS NOT NULL THEN 'x-doc' || doc_id || '-' || source || '.json' END END AS file FROM documents""")
def extraction_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations with the extraction of their report: of its name, or of a name with the company's."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("stem"), F.col("source").alias("company"))
    file = F.when(F.col("doc_id") % 3 == 0, F.concat("stem", F.lit(".json"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("x-"), "stem", F.lit("-"), "company", F.lit(".json")))
    files = d.select(file.alias("file")).where("file is not null")
    asked = d.select("doc_id", F.concat("stem", F.lit(".pdf")).alias("source_file"), "company")
    return joins.with_extraction(asked, files).select("doc_id", "file")


@query("SELECT l_orderkey AS o, l_linenumber AS l, l_quantity AS q FROM lineitem WHERE l_quantity <= 1.75 * l_linenumber * 5 AND l_linenumber * 5 <= 1.75 * l_quantity AND l_returnflag IN ('A', 'R')")
def compatible_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples by lists of wanted values whose sizes of type go together."""
    li = filters.samples(read(spark, sf_dir, "lineitem"), l_returnflag=["A", "R"], l_linestatus=None)
    return li.where(filters.sizes_compatible(F.col("l_quantity"), F.col("l_linenumber") * 5)).select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l"), F.col("l_quantity").alias("q"))


@query("""WITH e AS (SELECT o_custkey AS kpi_id, o_orderpriority AS src_file, year(o_orderdate) AS year, min(CAST(o_totalprice AS VARCHAR)) AS v FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY ALL),
  m AS (SELECT o_custkey AS kpi_id, o_orderpriority AS src_file, year(o_orderdate) AS year, max(o_totalprice) AS v FROM orders WHERE o_orderkey % 3 <> 1 GROUP BY ALL),
  v AS (SELECT src_file, CASE WHEN e.v IS NULL THEN 'FP' WHEN m.v IS NULL THEN 'FN' WHEN abs(CAST(e.v AS DOUBLE) - m.v) < 0.0001 THEN 'TP' ELSE 'FP' END AS verdict FROM e FULL JOIN m USING (kpi_id, src_file, year)),
  c AS (SELECT src_file, count(*) FILTER (verdict = 'TP') AS tp, count(*) FILTER (verdict = 'FP') AS fp, count(*) FILTER (verdict = 'FN') AS fn, count(*) FILTER (verdict = 'TN') AS tn FROM v GROUP BY src_file)
  SELECT src_file, tp, fp, fn, tn, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS "precision", round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall FROM c""")  # fmt: skip
def rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, precision and recall of measures by file."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("kpi_id"), F.col("o_orderpriority").alias("src_file"), F.year("o_orderdate").alias("year"), F.col("o_totalprice").cast("string").alias("value"), F.col("o_totalprice").alias("score"))
    out = metrics.rule_scores(joins.matched_measures(o.where("o_orderkey % 3 <> 0"), o.where("o_orderkey % 3 <> 1")), ("src_file",))
    return out.select("src_file", "tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("precision", "recall")])


@query("SELECT doc_id, md5(text) AS own, CAST(1 AS DOUBLE) AS ratio FROM documents WHERE text IS NOT NULL AND len(text) > 40")
def contained_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How alike a text is to a part of itself: wholly."""
    from .functions.fuzzy import partial_ratio_of

    d = read(spark, sf_dir, "documents").where("text is not null and length(text) > 40")
    return d.select("doc_id", F.md5("text").alias("own"), partial_ratio_of(F.substring("text", 10, 20), F.col("text")).alias("ratio"))


_OVERLAP_CELL_SQL = """c AS (SELECT t, unnest([0, 1, 2]) AS col, unnest([CAST(s % 30 AS DOUBLE), 150.0 + p % 40, 300.0 + s % 50]) AS x0, unnest([s % 30 + 60 + q * 3, 190.0 + p % 40 + l * 30, 420.0]) AS x1, unnest([false, r = 'R', f = 'F']) AS fixed
    FROM (SELECT l_orderkey AS t, l_linenumber AS l, l_suppkey AS s, l_partkey AS p, CAST(l_quantity AS BIGINT) AS q, l_returnflag AS r, l_linestatus AS f FROM lineitem))"""


@query(f"""WITH {_OVERLAP_CELL_SQL}, e AS (SELECT *, x0 + 0.99 * (x1 - x0) AS e FROM c), cut AS (SELECT DISTINCT t, e AS x FROM e UNION SELECT DISTINCT t, -1 FROM e),
  pair AS (SELECT a.t, a.x AS p, b.x AS q FROM cut a JOIN cut b ON a.t = b.t AND a.x <= b.x),
  gone AS (SELECT p.t, p.p, p.q, x1 - x0 AS w, fixed, CASE col WHEN 0 THEN e > p WHEN 1 THEN x0 < p OR e > q ELSE x0 < q END AS g FROM pair p JOIN e USING (t)),
  tried AS (SELECT t, p, q, count(*) FILTER (g) AS n, coalesce(sum(w) FILTER (g), 0) AS w FROM gone GROUP BY ALL HAVING NOT bool_or(g AND fixed)),
  best AS (SELECT t, n, w FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY n, w DESC) AS k FROM tried) WHERE k = 1)
  SELECT a.t, best.n AS n_removed, CAST(best.w AS DOUBLE) AS width FROM (SELECT DISTINCT t FROM c) a LEFT JOIN best USING (t)""")  # fmt: skip
def overlapping_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many cells must leave each table, and how wide they are in sum, so that its three columns stand clear of each other."""
    from .operators.layout import overlapping_cells as removed

    s, p, q, line = F.col("l_suppkey"), F.col("l_partkey"), F.col("l_quantity").cast("long"), F.col("l_linenumber")
    cell = lambda col, x0, x1, fixed: F.struct(F.lit(col).alias("col"), x0.cast("double").alias("x0"), x1.cast("double").alias("x1"), fixed.alias("fixed"))
    made = F.array(cell(0, s % 30, s % 30 + 60 + q * 3, F.lit(False)), cell(1, 150 + p % 40, 190 + p % 40 + line * 30, F.col("l_returnflag") == "R"), cell(2, 300 + s % 50, F.lit(420), F.col("l_linestatus") == "F"))
    cells = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("t"), line.alias("row"), F.explode(made).alias("c")).select("t", "row", "c.*", F.lit("").alias("txt"))
    gone = F.col("removed")
    width = F.coalesce(F.sum(F.when(gone, F.col("x1") - F.col("x0"))), F.lit(0.0))
    out = removed(cells, ["t"]).groupBy("t").agg(F.count(F.when(gone, 1)).alias("n"), width.alias("w"), F.count("removed").alias("known"))
    return out.select("t", F.when(F.col("known") > 0, F.col("n")).alias("n_removed"), F.when(F.col("known") > 0, F.col("w")).alias("width"))


_RANK_SQL = """c AS (SELECT t, row, col, min(up) AS up, min(l) AS l FROM (SELECT l_orderkey AS t, l_linenumber AS row, unnest([0, 1, 2, 3]) AS col,
    unnest([l_suppkey % 5, l_partkey % 4, CAST(l_quantity AS BIGINT) % 6, l_linenumber]) AS up, unnest([l_partkey % 3, l_suppkey % 4, l_partkey % 5, CAST(l_quantity AS BIGINT) % 7]) AS l FROM lineitem) GROUP BY ALL)"""


@query(f"""WITH RECURSIVE {_RANK_SQL}, parent AS (
    SELECT a.t, a.row, a.col, 'up' AS side, max(b.row) AS r, a.col AS c FROM c a JOIN c b ON a.t = b.t AND a.col = b.col AND b.row < a.row AND b.up < a.up GROUP BY ALL
    UNION ALL SELECT a.t, a.row, a.col, 'left', a.row, max(b.col) FROM c a JOIN c b ON a.t = b.t AND a.row = b.row AND b.col < a.col AND b.l < a.l GROUP BY ALL),
  found AS (SELECT t, row, col, side, 1 AS step, r, c FROM parent UNION ALL SELECT f.t, f.row, f.col, f.side, f.step + 1, p.r, p.c FROM found f JOIN parent p ON p.t = f.t AND p.side = f.side AND p.row = f.r AND p.col = f.c)
  SELECT t, CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, side, CAST(step AS INTEGER) AS step, CAST(r AS INTEGER) AS ancestor_row, CAST(c AS INTEGER) AS ancestor_col FROM found""")  # fmt: skip
def cell_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ancestor of every cell of tables of order lines, upwards and to the left."""
    from .operators.hierarchy import cell_ancestors as ancestors

    s, p, q, line = F.col("l_suppkey"), F.col("l_partkey"), F.col("l_quantity").cast("long"), F.col("l_linenumber")
    ranks = F.array(*[F.struct(F.lit(k).alias("col"), up.cast("double").alias("up_rank"), left.cast("double").alias("left_rank")) for k, (up, left) in enumerate(((s % 5, p % 3), (p % 4, s % 4), (q % 6, p % 5), (line, q % 7)))])
    cells = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("t"), line.alias("row"), F.explode(ranks).alias("c")).select("t", "row", "c.*")
    return ancestors(cells, ["t"])


#: The annotated paragraph is the page's first and is as alike as a change for each character left out, so another one must be more
#: alike. Pieces that stand beside each other and aren't in the longer text take a change each, and a change spoils three
#: grams; where these are too many, no table of distances is made.
@query(rf"""WITH RECURSIVE {ANN_SQL}, asked AS MATERIALIZED (SELECT *, regexp_replace(first_text, '([^\n]{{9}})[^\n]', '\1', 'g') AS part FROM anns WHERE answer IS NOT NULL AND answer <> ''),
  near AS MATERIALIZED (SELECT DISTINCT a.ann_id, a.part, a.first_text, (len(a.part) - 1) // 9 AS most, p.para_idx, p.text FROM asked a JOIN paras p USING (pdf_name, page0)),
  whole AS (SELECT ann_id, arg_min(text, para_idx) AS text FROM near WHERE contains(text, part) GROUP BY ann_id),
  sides AS (SELECT *, CASE WHEN len(part) <= len(text) THEN part ELSE text END AS s, CASE WHEN len(part) <= len(text) THEN text ELSE part END AS l FROM near ANTI JOIN whole USING (ann_id)),
  cut AS (SELECT *, CASE WHEN len(part) <= len(text) THEN list_transform(range(1, most + 2), lambda k: substr(s, 9 * k - 3, 9)) ELSE list_transform(range(len(s) // 6), lambda k: substr(s, 6 * k + 1, 6)) END AS pieces FROM sides),
  able AS MATERIALIZED (SELECT * FROM cut WHERE text = first_text OR (len(s) - greatest(len(list_filter(pieces, lambda x: NOT contains(l, x))), ceil(len(list_filter(range(1, len(s) - 1), lambda k: NOT contains(l, substr(s, k, 3)))) / 3))) * len(part) > (len(part) - most) * len(s)),
  several AS (SELECT ann_id FROM able GROUP BY ann_id HAVING count(DISTINCT text) > 1), pair AS MATERIALIZED (SELECT *, row_number() OVER () AS id FROM (SELECT DISTINCT s, l FROM able SEMI JOIN several USING (ann_id))),
  cell AS (SELECT id, 0 AS i, unnest(range(len(l) + 1)) AS j, unnest(list_transform(range(len(l) + 1), lambda j: substr(l, j, 1))) AS c, 0 AS d FROM pair UNION ALL SELECT id, i + 1, j, c, CAST(j + min(w - j) OVER (PARTITION BY id ORDER BY j) AS INTEGER) FROM (
    SELECT id, i, j, c, least(d + 1, coalesce(lag(d) OVER (PARTITION BY id ORDER BY j) + CASE WHEN substr(s, i + 1, 1) = c THEN 0 ELSE 1 END, d + 1)) AS w FROM cell JOIN pair USING (id) WHERE i < len(s))),
  ratio AS (SELECT s, l, 1 - min(d) / len(s) AS r FROM cell JOIN pair USING (id) WHERE i = len(s) GROUP BY s, l),
  best AS (SELECT ann_id, text FROM (SELECT ann_id, text, row_number() OVER (PARTITION BY ann_id ORDER BY r DESC, para_idx) AS k FROM able JOIN ratio USING (s, l)) WHERE k = 1)
  SELECT ann_id, md5(coalesce(w.text, CASE WHEN b.ann_id IS NULL THEN first_text WHEN contains(b.text, answer) THEN b.text END, part)) AS context FROM asked LEFT JOIN whole w USING (ann_id) LEFT JOIN best b USING (ann_id)""")  # fmt: skip
def misspelt_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paragraph that is meant where the annotated text lacks every tenth character, so that no paragraph contains it."""
    asked = annotations(spark, sf_dir).where("answer <> ''")
    whole = F.expr("substring(relevant_paragraphs, 3, length(relevant_paragraphs) - 4)")
    rows = asked.select("ann_id", "pdf_name", "page0", "answer", F.regexp_replace(whole, r"([^\n]{9})[^\n]", "$1").alias("paragraph"))
    return joins.closest_paragraph(rows, paragraphs(spark, sf_dir), ["pdf_name", "page0"]).select("ann_id", F.md5("context").alias("context"))


#: What a KPI of conversations asks for: patterns with scores, half-lives of letters, letters that are free.
_TOLD = ((".*tion.*", 1000, 300.0, 20), (".*(?:le|the) .*", 700, 400.0, 30), (".*ung.*", 900, 200.0, 10))
_TOLD_SQL = " + ".join(f"CASE WHEN regexp_matches(lower({{0}}), '^(?:{p})') THEN {s} * pow(pow(0.5, 1.0 / {h}), greatest(len(regexp_replace({{0}}, '[^a-z ]', '', 'g')) - {n}, 0)) ELSE 0 END" for p, s, h, n in _TOLD)
_TOLD_OK = f"regexp_matches(lower({{0}}), '^(?:{_TOLD[0][0]})')"
_REST = "array_to_string(list_transform({0}, lambda x: x.t), ' ')"


@query(f"""WITH RECURSIVE c AS (SELECT conv_id, list({{'k': turn, 't': replace(text, chr(10), ' ')}} ORDER BY turn, replace(text, chr(10), ' ')) AS l FROM conversations WHERE text IS NOT NULL GROUP BY 1),
  n AS (SELECT conv_id, list_transform(l, lambda x, i: {{'i': i, 't': x.t}}) AS l FROM c),
  b AS (SELECT *, {_TOLD_SQL.format(_REST.format('l'))} AS score FROM n WHERE {_TOLD_OK.format(_REST.format('l'))}),
  s AS (SELECT conv_id, len(l) AS i, l, score AS base, score FROM b WHERE score >= 20
    UNION ALL SELECT conv_id, i - 1, CASE WHEN better THEN rest ELSE l END, base, CASE WHEN better THEN told ELSE score END
      FROM (SELECT *, len(rest) > 0 AND {_TOLD_OK.format('flat')} AND told >= 20 AND told >= score AS better
        FROM (SELECT *, {_TOLD_SQL.format('flat')} AS told FROM (SELECT *, {_REST.format('rest')} AS flat FROM (SELECT *, list_filter(l, lambda x: x.i <> s.i) AS rest FROM s WHERE i > 0)))))
  SELECT conv_id, CAST(len(l) AS INTEGER) AS n_kept, md5({_REST.format('l')}) AS kept, round(base, 6) AS base_score, round(score, 6) AS kept_score FROM s WHERE i = 0""")  # fmt: skip
def needed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of each conversation that a KPI's description needs, found by leaving out one after the other."""
    from .operators.clusters import fewest_texts, flat_text
    from .operators.rules import DescriptionRule, KpiRule
    from .schemas import MAY_INCLUDE, MUST_INCLUDE

    rule = KpiRule(1.0, "told", tuple(DescriptionRule(p, s, MAY_INCLUDE if k else MUST_INCLUDE, half_life=h, free_letters=n) for k, (p, s, h, n) in enumerate(_TOLD)), minimum_description=20.0)
    turns = read(spark, sf_dir, "conversations").where("text is not null").select("conv_id", F.struct("turn", F.translate("text", "\n", " ").alias("txt")).alias("item"))
    lists = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = fewest_texts(lists, [rule])
    return found.select("conv_id", F.size("kept").alias("n_kept"), F.md5(flat_text(F.col("kept"))).alias("kept"), F.round("base_score", 6).alias("base_score"), F.round("kept_score", 6).alias("kept_score"))


_BALANCE_SQL = """c AS (SELECT DISTINCT c_custkey AS k, c_nationkey AS n, lower(c_mktsegment) AS s FROM customer),
  g AS (SELECT k, 0 AS part, 'account balance of ' || s AS label, 2010 + k % 5 AS year, 20 + k % 5 * 3 AS up, 20 + n % 4 * 3 AS down FROM c
    UNION ALL SELECT k, 1, 'account balance told by nation ' || repeat('x', n), 2010 + n % 5, 20 + n % 3 * 3, 20 + k % 7 * 2 FROM c),
  m AS (SELECT *, 1000 * pow(0.5, (len(regexp_replace(label, '[^a-z ]', '', 'g')) + 3 - 14) / 40.0) AS score, CASE WHEN up <= down THEN 3000 ELSE 5000 END + part * 1000 + k % 1000 AS value FROM g),
  y AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, year ORDER BY score DESC, part) AS r, max(score) OVER (PARTITION BY k) AS best FROM m WHERE score >= 500) WHERE r = 1)"""


@query(f"WITH {_BALANCE_SQL} SELECT 'customer' || k AS src_file, CAST(year AS INTEGER) AS year, CAST(value AS VARCHAR) AS value, 'EUR' AS unit, round(score, 6) AS score, 'AC.default' AS match_type FROM y WHERE score >= 0.75 * best")
def cluster_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of pages without tables: two texts of each customer's page compete, each with two numbers, a unit and a year."""
    from .operators.rules import DescriptionRule, KpiRule
    from .plans.rule_based import report_measures
    from .queries import _as_words, _placed
    from .schemas import MUST_INCLUDE

    k, n = F.col("c_custkey"), F.col("c_nationkey")
    words = []

    def part(number: int, top: int, label, tail, year, up, down) -> None:
        at = lambda item, txt, x, y: words.append(_placed(10 * number + item, txt, F.lit(float(x)), y.cast("double")))
        for w in label.split(" "):
            at(0, F.lit(w), 50 + 6 * label.index(w), F.lit(top))
        at(0, tail, 56 + 6 * len(label), F.lit(top))
        at(1, F.lit("EUR"), 420, F.lit(top))
        at(1, year.cast("string"), 442, F.lit(top))
        for item, (value, y) in enumerate(((3000, top - up), (5000, top + down))):
            at(2 + item, (value + 1000 * number + k % 1000).cast("string"), 120, y)

    part(0, 150, "account balance of", F.lower("c_mktsegment"), 2010 + k % 5, 20 + k % 5 * 3, 20 + n % 4 * 3)
    part(1, 600, "account balance told by nation", F.repeat(F.lit("x"), n), 2010 + n % 5, 20 + n % 3 * 3, 20 + k % 7 * 2)
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment").distinct()
    pages = customers.select(F.concat(F.lit("customer"), k.cast("string")).alias("doc"), F.lit(0).alias("page"), F.array(*words).alias("words"))
    rule = KpiRule(1.0, "account balance", (DescriptionRule(".*account balance.*", 1000.0, MUST_INCLUDE, half_life=40.0, free_letters=14),), units=(".*eur.*",))
    found = report_measures(_as_words(pages, 841.0), [rule], 2019, clusters=True)
    return found.select("src_file", "year", "value", "unit", F.round("score", 6).alias("score"), "match_type")


_HEAD = "greenhouse gas emission told in tonnes"
_SCORED = "({0} * pow(0.5, greatest(len(regexp_replace({1}, '[^a-z ]', '', 'g')) - {2}, 0) / {3}))"
_DESC_SQL = lambda c: f"{_SCORED.format(1000, c, 10, 40.0)} + CASE WHEN {c} LIKE '%of%' THEN {_SCORED.format(300, c, 12, 20.0)} ELSE 0 END"


@query(f"""WITH c AS (SELECT DISTINCT c_custkey AS k, c_nationkey AS n, 'emission of ' || lower(c_mktsegment) AS label FROM customer), v AS (SELECT *, unnest([0, 1, 2]) AS j FROM c),
  s AS (SELECT *, sqrt(pow(320 + 100 * j - (50 + 10 * n), 2) + pow(400 + k % 50 - 120, 2)) / (0.1 * sqrt(609 * 609 + 841 * 841)) AS d FROM v)
  SELECT 'customer' || k AS src_file, CAST(2017 + j AS INTEGER) AS year, CAST(3000 + k * 7 % 1500 + j AS VARCHAR) AS value, '{_HEAD}' AS unit, 'AT.direct' AS match_type,
    round(({_DESC_SQL('label')} + 0.5 * ({_DESC_SQL(f"'{_HEAD}'")}) + 200 * pow(0.9, d) + 100) * 1.44, 6) AS score FROM s""")
def scored_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a measure's score is made of: the row's label with its letters, the table's headline, a text elsewhere on the page with
    its distance, the years in the row; and its unit."""
    from .operators.rules import AnywhereRule, DescriptionRule, KpiRule
    from .plans.rule_based import report_measures
    from .queries import _as_words, _placed
    from .schemas import EUCLID, MAY_INCLUDE, MUST_INCLUDE

    k, n = F.col("c_custkey"), F.col("c_nationkey")
    words = []

    def line(item: int, text: str, x, y, *more) -> None:
        for j, w in enumerate(text.split(" ")):
            words.append(_placed(item, F.lit(w), x + 6 * len(" ".join([*text.split(" ")[:j], ""])), y))
        for w in more:
            words.append(_placed(item, w, x + 6 * (len(text) + 1), y))

    at = lambda v: F.lit(float(v))
    line(0, _HEAD, at(50), at(60))
    for j in range(3):
        line(1 + j, str(2017 + j), at(320 + 100 * j), at(100))
    for row, (label, more) in enumerate((("emission of", (F.lower("c_mktsegment"),)), ("water use", ()), ("staff", ()))):
        line(10 + 10 * row, label, at(50), at(120 + 20 * row), *more)
        for j in range(3):
            words.append(_placed(11 + 10 * row + j, (3000 + k * (7 + row) % 1500 + j).cast("string"), at(320 + 100 * j), at(120 + 20 * row)))
    line(50, "climate", 50 + 10 * n, (400 + k % 50).cast("double"))
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment").distinct()
    pages = customers.select(F.concat(F.lit("customer"), k.cast("string")).alias("doc"), F.lit(0).alias("page"), F.array(*words).alias("words"))
    rule = KpiRule(
        1.0, "emission", (DescriptionRule(".*emission.*", 1000.0, MUST_INCLUDE, decay=0.8, half_life=40.0, free_letters=10), DescriptionRule(".*of.*", 300.0, MAY_INCLUDE, decay=0.5, half_life=20.0, free_letters=12)),
        units=(".*tonnes.*",), anywhere=(AnywhereRule(".*climate.*", 200.0, MAY_INCLUDE, EUCLID, decay=0.9),),
    )
    found = report_measures(_as_words(pages, 841.0), [rule], 2019)
    return found.select("src_file", "year", "value", "unit", "match_type", F.round("score", 6).alias("score"))
