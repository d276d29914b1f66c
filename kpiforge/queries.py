"""The queries of the reference's operators over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import geometry, positions, shape, text
from .models import LongestWords, NearWords, OverlapRelevance, question_pairs
from .operators import filters, joins, layout, metrics, paragraphs, ranking, reshape, sampling
from .operators.rules import DescriptionRule, KpiRule
from .plans import curation, inference, rule_based
from .rules.catalogue import ACTIVE
from .tables import KPIS, LINES_A_PAGE, annotations, kpis, lines, read
from .tables import paragraphs as paragraph_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, with its SQL if there is any."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _sql_kpis() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    listed = lambda x: "[" + ", ".join(quoted(p.strip()) for p in x.split(",")) + "]"
    rows = ", ".join(f"(CAST({i} AS DOUBLE), {quoted(q)}, {listed(s)}, {str(y).lower()}, {listed(c)})" for i, q, s, y, c in KPIS)
    return f"kpis AS (SELECT * FROM (VALUES {rows}) AS k(kpi_id, question, sectors, add_year, kpi_category))"


KPI_SQL = _sql_kpis()
LINE_SQL = f"""lines AS (SELECT pdf_name, CAST(para_idx // {LINES_A_PAGE} AS INTEGER) AS page0, CAST(para_idx AS INTEGER) AS para_idx, text FROM (
  SELECT 'doc' || doc_id AS pdf_name, unnest(string_split(text, chr(10))) AS text, unnest(range(len(string_split(text, chr(10))))) AS para_idx FROM documents))"""
_SPACES = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]{2,}"


def _cleaned(column: str, breaks: str) -> str:
    quotes = f"replace(replace({column}, '[“', '[\"'), '”]', '\"]')"
    return rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace({quotes}, '“|”', '', 'g'), '{breaks}', ' ', 'g'), '[\x{{00}}-\x{{08}}\x{{0b}}\x{{0c}}\x{{0e}}-\x{{1f}}\x{{7f}}-\x{{ff}}]', '', 'g'), '{_SPACES}', ' ', 'g')"


CURATED = _cleaned("text", r"\n|\t")
ANSWERED = rf"regexp_replace(lower(translate({_cleaned('text', chr(92) + 'n')}, '()^+*$|\?[]{{}}', '')), '\.{{2,}}', '', 'g')"
PARA_SQL = LINE_SQL + rf""", paras AS (SELECT * FROM (SELECT pdf_name, page0, para_idx, {CURATED} AS text FROM lines) WHERE len(regexp_replace(text, '[^\p{{L}}]', '', 'g')) > 30)"""
ANN_SQL = PARA_SQL + """, anns AS (
  SELECT d.doc_id AS ann_id, p.pdf_name, d.source AS company, CASE WHEN d.doc_id % 5 = 4 THEN 'TABLE' ELSE 'TEXT' END AS data_type,
    CAST(d.doc_id % 12 AS VARCHAR) AS kpi_id, CAST(d.doc_id % 30 + 1990 AS VARCHAR) AS year, [p.page0 + 1] AS source_page, p.page0, string_split(p.text, ' ')[3] AS answer,
    '["' || p.text || '"]' AS relevant_paragraphs, p.text AS first_text
  FROM documents d JOIN (SELECT pdf_name, arg_min(page0, para_idx) AS page0, arg_min(text, para_idx) AS text FROM paras GROUP BY pdf_name) p ON p.pdf_name = 'doc' || d.doc_id)"""
TOKENS = lambda c: f"list_distinct(list_filter(regexp_split_to_array(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))"

# ---- text and shape -------------------------------------------------------------------------------------------------


@query(f"WITH {PARA_SQL} SELECT * FROM paras")
def paragraph_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents that are paragraphs."""
    return paragraph_table(spark, sf_dir)


@query(f"SELECT doc_id, md5({CURATED}) AS cleaned, len({CURATED}) AS n FROM documents")
def clean_text_curation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents cleaned as for curation."""
    c = text.clean_for_curation(F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(c).alias("cleaned"), F.length(c).cast("long").alias("n"))


@query(f"SELECT doc_id, md5({ANSWERED}) AS cleaned, len({ANSWERED}) AS n FROM documents")
def clean_text_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents cleaned as for question answering."""
    c = text.clean_for_answers(F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(c).alias("cleaned"), F.length(c).cast("long").alias("n"))


_WORD_SQL = "words AS (SELECT doc_id, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS w FROM documents), distinct_words AS (SELECT w, count(*) AS n FROM words GROUP BY w)"
_SQL_BARE = "translate(w, ' ()$%', '')"
_SQL_LETTERS = r"len(regexp_replace({0}, '[^\p{{L}}]', '', 'g'))"
_SQL_NUMERALS = r"len(regexp_replace({0}, '[^\p{{N}}]', '', 'g'))"
_SQL_NUMERIC = rf"(len({_SQL_BARE}) > 0 AND regexp_full_match(replace({_SQL_BARE}, 'WLTP', ''), '{shape.NUMBER}\**'))"
_SQL_YEAR = f"regexp_full_match(replace(w, ' ', ''), '{shape.YEAR[1:-1]}')"
_SQL_WORDS = f"({_SQL_LETTERS.format('w')} > 5)"


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = read(spark, sf_dir, "documents").select(F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ", -1)).alias("w"))
    return split.groupBy("w").agg(F.count("*").alias("n"))


@query(rf"""WITH {_WORD_SQL} SELECT w, n, {_SQL_NUMERIC} AS is_numeric, {_SQL_NUMERALS.format('w')} > 0 AS weak_numeric, {_SQL_NUMERALS.format('w')} > 0 AND contains(w, '%') AS percentage,
  {_SQL_YEAR} AS is_year, {_SQL_WORDS} AS is_words, {_SQL_LETTERS.format('w')} > 2 AND {_SQL_LETTERS.format('w')} > {_SQL_NUMERALS.format('w')} AS weak_words,
  regexp_full_match(lower(w), '{shape.NULL_LIKE[1:-1]}') AS is_null_like, len(w) < 4 AND NOT {_SQL_WORDS} AND NOT {_SQL_NUMERIC} AS special_item,
  regexp_full_match(w, '[0-9]{{1,3}}') AND w <> '0' AS pagenum, regexp_matches(w, '^[0-9]+\)') AS footnote FROM distinct_words""")  # fmt: skip
def word_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every distinct word of the documents looks like."""
    w = F.col("w")
    flags = {
        "is_numeric": shape.looks_numeric, "weak_numeric": shape.looks_weak_numeric, "percentage": shape.looks_percentage, "is_year": shape.looks_year, "is_words": shape.looks_words,
        "weak_words": shape.looks_weak_words, "is_null_like": shape.looks_null, "special_item": shape.looks_other_special_item, "pagenum": shape.looks_pagenum, "footnote": shape.looks_footnote,
    }
    return _words(spark, sf_dir).select("w", "n", *[f(w).alias(k) for k, f in flags.items()])


@query(rf"""WITH {_WORD_SQL}, k AS (SELECT w, n, regexp_replace(w, '[^0-9\-.]', '', 'g') AS s FROM distinct_words WHERE regexp_matches(w, '[0-9]')),
  c AS (SELECT w, n, CASE WHEN strpos(s, '.') = 0 THEN s ELSE substr(s, 1, strpos(s, '.')) || replace(substr(s, strpos(s, '.') + 1), '.', '') END AS number FROM k)
  SELECT w, n, number, TRY_CAST(number AS DOUBLE) AS value, TRY_CAST(nullif(regexp_extract(regexp_replace(w, '[^0-9]', '', 'g'), '^[0-9]{{4}}'), '') AS INTEGER) AS first_year,
    CASE WHEN len(list_distinct(regexp_extract_all(w, '{shape.YEAR_INSIDE}'))) = 1 THEN CAST(regexp_extract(w, '{shape.YEAR_INSIDE}') AS INTEGER) END AS only_year FROM c""")  # fmt: skip
def word_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and years in every distinct word that has a digit."""
    w = F.col("w")
    return _words(spark, sf_dir).where(F.rlike("w", F.lit("[0-9]"))).select(
        "w", "n", shape.cleanup_number(w).alias("number"), shape.to_float_number(w).alias("value"), shape.to_year(w).alias("first_year"), shape.year_in_text(w).alias("only_year")
    )


_T = r"regexp_replace(text, '^[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+|[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+$', '', 'g')"
_N = lambda c: f"(len(t) - len(replace(t, '{c}', '')))"


@query(rf"""WITH {LINE_SQL}, x AS (SELECT pdf_name, para_idx, {_T} AS t FROM lines), y AS (SELECT *, {_SQL_LETTERS.format('t')} AS a, {_N('.')} AS s, {_N(',')} AS c, {_N(' ')} AS b, greatest(len(t), 1) AS l FROM x)
  SELECT pdf_name, para_idx, a >= 20 AND a / l >= 0.5 AND b >= 5 AND NOT (c / l < 0.004 AND s / l < 0.002) AND (t LIKE '%.' OR ((s > 2 OR (s > 1 AND c > 1)) AND a > 30 AND b > 10)) AS running FROM y""")  # fmt: skip
def running_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines read like running text."""
    return lines(spark, sf_dir).select("pdf_name", "para_idx", shape.looks_running_text(F.col("text")).alias("running"))


# ---- questions and joins --------------------------------------------------------------------------------------------


@query(f"WITH {KPI_SQL} SELECT kpi_id, question FROM kpis WHERE list_has_any(sectors, ['OG', 'CU']) AND list_contains(kpi_category, 'TEXT')")
def question_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions of two sectors that are asked of texts."""
    return filters.questions_for(kpis(spark), ["OG", "CU"]).select("kpi_id", "question")


_SCORE = f"len(list_intersect({TOKENS('question')}, {TOKENS('text')})) / greatest(len({TOKENS('question')}), 1)"


@query(f"WITH {KPI_SQL}, {PARA_SQL} SELECT pdf_name, kpi_id, count(*) AS pairs, round(sum({_SCORE}), 6) AS total, round(max({_SCORE}), 6) AS best FROM paras, kpis GROUP BY ALL")
def question_paragraph_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every question with every paragraph of a report, and how they score."""
    pairs = question_pairs(paragraph_table(spark, sf_dir), kpis(spark), OverlapRelevance(), "text", "question").withColumnRenamed("paragraph_relevance_score", "s")
    return pairs.groupBy("pdf_name", "kpi_id").agg(F.count("*").alias("pairs"), F.round(F.sum("s"), 6).alias("total"), F.round(F.max("s"), 6).alias("best"))


@query(f"WITH {KPI_SQL}, {PARA_SQL} SELECT pdf_name, page0, para_idx, question AS kpi, round({_SCORE}, 6) AS score FROM paras, kpis WHERE {_SCORE} >= 0.5")
def relevant_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs that the relevance scorer takes for relevant to a question."""
    out = inference.relevant_paragraphs(paragraph_table(spark, sf_dir), kpis(spark))
    return out.select("pdf_name", "page0", "para_idx", "kpi", F.round("paragraph_relevance_score", 6).alias("score"))


_ANSWERS_SQL = f"""WITH {KPI_SQL}, {PARA_SQL}, asked AS MATERIALIZED (SELECT question, kpi_id, {TOKENS('question')} AS q FROM kpis), told AS MATERIALIZED (SELECT *, {TOKENS('text')} AS t FROM paras),
rel AS MATERIALIZED (SELECT * FROM (SELECT pdf_name, page0, para_idx, question AS kpi, kpi_id, text AS paragraph, t, len(list_intersect(q, t)) / greatest(len(q), 1) AS rel FROM told, asked) WHERE rel >= 0.5),
ranked AS (SELECT *, list_transform(list_sort(list_transform(t, lambda w: {{'n': -len(w), 'w': w}})), lambda s: {{'answer': s.w, 'score': len(s.w) / 100}}) AS r FROM rel),
pair AS MATERIALIZED (SELECT *, CASE WHEN coalesce(len(r[1].answer), 0) >= 8 THEN list_concat(r, [{{'answer': 'no_answer', 'score': 0.08}}]) ELSE list_concat([{{'answer': 'no_answer', 'score': 0.08}}], r) END[1:2] AS a FROM ranked),
melted AS MATERIALIZED (SELECT pdf_name, kpi, kpi_id, page0, para_idx, paragraph, rel, unnest(a).answer AS answer, CAST(unnest(a).score AS DOUBLE) AS score, unnest(range(1, len(a) + 1)) AS rank FROM pair),
none AS (SELECT pdf_name, kpi, kpi_id, max(score) AS score FROM melted WHERE rank = 1 GROUP BY ALL HAVING bool_and(answer = 'no_answer')),
rows AS (SELECT pdf_name, kpi, kpi_id, page0, para_idx, paragraph, rel, answer, score FROM melted WHERE answer <> 'no_answer'
  UNION ALL SELECT pdf_name, kpi, kpi_id, NULL, NULL, NULL, NULL, 'no_answer', score FROM none),
top AS (SELECT *, rank() OVER (PARTITION BY pdf_name, kpi ORDER BY score DESC) AS k, row_number() OVER (PARTITION BY pdf_name, kpi ORDER BY score DESC, answer) AS n FROM rows)"""


@query(_ANSWERS_SQL + " SELECT pdf_name, kpi, kpi_id, answer, round(score, 6) AS score, count(*) AS n FROM top WHERE n <= 4 GROUP BY ALL")
def answer_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best answers to each question in each report: melt, no-answer aggregate, top-k and lookup of the KPI."""
    out = inference.extract_answers(paragraph_table(spark, sf_dir), kpis(spark))
    return out.groupBy("pdf_name", "kpi", "kpi_id", "answer", F.round("score", 6).alias("score")).agg(F.count("*").alias("n"))


_NEAR_SQL = f"""WITH {KPI_SQL}, {PARA_SQL}, asked AS MATERIALIZED (SELECT question, kpi_id, {TOKENS('question')} AS q FROM kpis),
told AS MATERIALIZED (SELECT *, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS t FROM paras),
rel AS MATERIALIZED (SELECT row_number() OVER () AS id, pdf_name, page0, para_idx, question AS kpi, kpi_id, t, q, list_transform(t, lambda w: list_contains(q, w)) AS hit FROM told, asked WHERE len(list_intersect(q, list_distinct(t))) / greatest(len(q), 1) >= 0.5),
place AS (SELECT id, unnest(range(1, len(t) + 1)) AS i, unnest(t) AS w, unnest(hit) AS h FROM rel),
near AS (SELECT a.id, a.w, a.i, count(*) AS n FROM place a JOIN place b ON a.id = b.id AND b.i BETWEEN a.i - 5 AND a.i + 5 AND b.h WHERE NOT a.h GROUP BY ALL),
word AS (SELECT id, w, max(n) AS n, row_number() OVER (PARTITION BY id ORDER BY max(n) DESC, w) AS k FROM near GROUP BY id, w),
peak AS (SELECT id, max(n) / 10 AS most FROM word GROUP BY id),
entry AS (SELECT id, w AS answer, n / 10 AS score, k + CASE WHEN most >= 0.2 THEN 0 ELSE 1 END AS rank FROM word JOIN peak USING (id)
  UNION ALL SELECT rel.id, 'no_answer', 0.2, CASE WHEN coalesce(most, 0) >= 0.2 THEN least((SELECT count(*) FROM word x WHERE x.id = rel.id AND k <= 2), 2) + 1 ELSE 1 END FROM rel LEFT JOIN peak USING (id)),
melted AS MATERIALIZED (SELECT pdf_name, kpi, kpi_id, answer, CAST(score AS DOUBLE) AS score, rank FROM entry JOIN rel USING (id) WHERE rank <= 2),
rows AS (SELECT pdf_name, kpi, kpi_id, answer, score FROM melted WHERE answer <> 'no_answer'
  UNION ALL SELECT pdf_name, kpi, kpi_id, 'no_answer', max(score) FROM melted WHERE rank = 1 GROUP BY ALL HAVING bool_and(answer = 'no_answer')),
top AS (SELECT *, row_number() OVER (PARTITION BY pdf_name, kpi ORDER BY score DESC, answer) AS n FROM rows)"""


@query(_NEAR_SQL + " SELECT pdf_name, kpi, kpi_id, answer, round(score, 6) AS score, count(*) AS n FROM top WHERE n <= 4 GROUP BY ALL")
def question_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best answers of a model that reads the question: words near the question's own words."""
    out = inference.extract_answers(paragraph_table(spark, sf_dir), kpis(spark), answers=NearWords())
    return out.groupBy("pdf_name", "kpi", "kpi_id", "answer", F.round("score", 6).alias("score")).agg(F.count("*").alias("n"))


@query(_ANSWERS_SQL + " SELECT pdf_name, kpi, round(score, 6) AS score FROM none")
def no_answer_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions that no paragraph of a report answers."""
    ready = LongestWords().prepared(paragraph_table(spark, sf_dir), "text").withColumnRenamed("_answers", "answers")
    rows = paragraphs.melt_answers(inference.relevant_paragraphs(ready, kpis(spark), more=("answers",)))
    return ranking.no_answers(rows, ["pdf_name", "kpi"]).select("pdf_name", "kpi", F.round("score", 6).alias("score"))


@query(f"WITH {LINE_SQL} SELECT pdf_name, item_id, para_idx FROM (SELECT l.pdf_name, b.item_id, l.para_idx, row_number() OVER (PARTITION BY l.pdf_name, b.item_id ORDER BY l.para_idx) AS k FROM lines l JOIN benchmark b ON contains(l.text, string_split(b.text, chr(10))[1])) WHERE k = 1")
def first_containing_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of each report that contains the first line of a passage."""
    passages = joins.small(read(spark, sf_dir, "benchmark").select("item_id", F.split("text", "\n")[0].alias("part")))
    hits = lines(spark, sf_dir).join(passages, F.contains("text", F.col("part")))
    return ranking.keep_first(hits, ["pdf_name", "item_id"], ["para_idx"]).select("pdf_name", "item_id", "para_idx")


@query(f"WITH {KPI_SQL}, {ANN_SQL} SELECT a.ann_id, a.kpi_id, CASE WHEN k.add_year THEN string_split(k.question, '?')[1] || ' in year ' || a.year || '?' ELSE k.question END AS question FROM anns a LEFT JOIN kpis k ON TRY_CAST(a.kpi_id AS DOUBLE) = k.kpi_id")
def kpi_question_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations with their question, which names the year if it asks for one."""
    return joins.with_dated_question(annotations(spark, sf_dir), kpis(spark)).select("ann_id", "kpi_id", "question")


@query(f"WITH {KPI_SQL}, {ANN_SQL} SELECT DISTINCT a.kpi_id FROM anns a LEFT JOIN kpis k ON TRY_CAST(a.kpi_id AS DOUBLE) = k.kpi_id WHERE k.question IS NULL")
def unmapped_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs of annotations that no question asks for."""
    return joins.mapped_and_unmapped(annotations(spark, sf_dir), kpis(spark))[1]


@query(f"WITH {KPI_SQL}, {ANN_SQL} SELECT a.ann_id FROM anns a LEFT JOIN kpis k ON TRY_CAST(a.kpi_id AS DOUBLE) = k.kpi_id WHERE k.kpi_id IS NULL OR list_contains(k.kpi_category, a.data_type)")
def category_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations whose data type their KPI has."""
    return filters.category_valid(annotations(spark, sf_dir).withColumn("kpi_id", F.col("kpi_id").cast("double")), kpis(spark)).select("ann_id")


@query(f"WITH {ANN_SQL} SELECT ann_id FROM anns WHERE data_type = 'TEXT' AND company <> 'src0'")
def company_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text annotations of companies that are not left out."""
    return filters.text_annotations(annotations(spark, sf_dir), ("src0",)).select("ann_id")


@query("SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS annotated FROM documents")
def annotated_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports with annotations (semi-join) and without (anti-join)."""
    docs, known = read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels").select("doc_id")
    return docs.join(known, "doc_id", "left_semi").withColumn("annotated", F.lit(True)).unionByName(docs.join(known, "doc_id", "left_anti").withColumn("annotated", F.lit(False)))


@query(f"WITH {KPI_SQL}, {ANN_SQL} SELECT a.pdf_name, k.kpi_id, a.answer, p.page0, p.para_idx FROM anns a JOIN kpis k ON CAST(a.kpi_id AS DOUBLE) = k.kpi_id JOIN paras p ON p.pdf_name = a.pdf_name AND p.page0 <> a.page0 AND contains(p.text, a.answer) WHERE k.kpi_id NOT IN (0, 1, 9, 11)")
def elsewhere_answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs on other pages that contain a report's answer."""
    a = joins.with_question(annotations(spark, sf_dir), kpis(spark)).where("question is not null").withColumn("kpi_id", F.col("kpi_id").cast("double"))
    return joins.elsewhere_answered(a, paragraph_table(spark, sf_dir)).select("pdf_name", "kpi_id", "answer", "page0", "para_idx")


@query(f"""WITH {KPI_SQL}, {ANN_SQL}, rel AS (SELECT pdf_name, page0, para_idx, question, text FROM paras, kpis WHERE {_SCORE} >= 0.5), asked AS (SELECT a.*, k.question FROM anns a JOIN kpis k ON CAST(a.kpi_id AS DOUBLE) = k.kpi_id)
  SELECT r.pdf_name, r.page0, r.para_idx, r.question FROM rel r WHERE r.pdf_name IN (SELECT pdf_name FROM asked) AND NOT EXISTS (SELECT 1 FROM asked a WHERE a.pdf_name = r.pdf_name AND a.page0 = r.page0)
    AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT question, answer FROM asked WHERE answer IS NOT NULL) b WHERE b.question = r.question AND contains(r.text, b.answer))""")  # fmt: skip
def unanswerable_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevant paragraphs that answer nothing: anti-joins by page and by contained answer."""
    rel = inference.relevant_paragraphs(paragraph_table(spark, sf_dir), kpis(spark)).select("pdf_name", "page0", "para_idx", F.col("kpi").alias("question"), F.col("paragraph").alias("text"))
    asked = joins.with_question(annotations(spark, sf_dir), kpis(spark)).where("question is not null")
    return joins.unanswerable(rel, asked).select("pdf_name", "page0", "para_idx", "question")


# ---- positions ------------------------------------------------------------------------------------------------------


@query(rf"""WITH {ANN_SQL}, x AS (SELECT ann_id, answer, first_text AS t, unnest(range(len(first_text))) AS i FROM anns WHERE answer <> ''),
  h AS (SELECT ann_id, i FROM x WHERE substr(t, i + 1, len(answer)) = answer AND (NOT regexp_full_match(answer, '\p{{N}}+')
    OR (i > 0 AND regexp_full_match(substr(t, i, 1), '[^0-9]')) OR regexp_full_match(substr(t, i + 1 + len(answer), 1), '[^0-9]'))) SELECT ann_id, min(i) AS first_offset FROM h GROUP BY ann_id""")  # fmt: skip
def answer_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each answer first stands in its paragraph; a number not within a longer one."""
    a = annotations(spark, sf_dir).where("answer <> ''").withColumn("p", text.paragraph_list(F.col("relevant_paragraphs")))
    found = positions.answer_offsets(F.col("answer"), F.array_join("p", '", "'))
    return a.select("ann_id", found.alias("found")).where(F.size("found") > 0).select("ann_id", F.get("found", F.lit(0)).cast("long").alias("first_offset"))


@query("SELECT doc_id, len(list_filter(string_split(text, ' '), lambda w: true)) - 1 AS n_spaces, CAST(len(text) - len(replace(text, 'the', '')) AS BIGINT) // 3 AS n_the FROM documents")
def all_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a blank and a word stand in whole documents, by all their offsets."""
    found = lambda part: F.size(positions.find_all(F.col("text"), F.lit(part))).cast("long")
    return read(spark, sf_dir, "documents").select("doc_id", found(" ").alias("n_spaces"), found("the").alias("n_the"))


# ---- ranks and aggregates -------------------------------------------------------------------------------------------

_MEASURE_SQL = "m AS (SELECT l_orderkey AS pos1, l_linenumber AS pos2, 'kpi' || (l_partkey % 50) AS kpi_name, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 1990 + l_suppkey % 30 END AS year, l_extendedprice AS score, l_quantity AS q FROM lineitem)"


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    year = F.when(F.col("l_linenumber") % 3 != 0, 1990 + F.col("l_suppkey") % 30)
    return li.select(
        F.col("l_orderkey").alias("pos1"), F.col("l_linenumber").alias("pos2"), F.concat(F.lit("kpi"), (F.col("l_partkey") % 50).cast("string")).alias("kpi_name"),
        year.alias("year"), F.col("l_extendedprice").alias("score"), F.col("l_quantity").alias("q"), F.struct("l_orderkey", "l_linenumber").alias("pos"),
    )


@query(f"WITH {_MEASURE_SQL} SELECT kpi_name, pos1, pos2, score FROM (SELECT *, row_number() OVER (PARTITION BY kpi_name ORDER BY score DESC, pos1, pos2) AS k FROM m) WHERE k <= 4")
def top_k_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best measures of each KPI."""
    return ranking.top_k(_measures(spark, sf_dir), ["kpi_name"], 4).select("kpi_name", "pos1", "pos2", "score")


@query(f"WITH {_MEASURE_SQL} SELECT kpi_name, CAST(year AS BIGINT) AS year, pos1, pos2, score FROM (SELECT *, row_number() OVER (PARTITION BY kpi_name, year ORDER BY score DESC, pos1 DESC, pos2 DESC) AS k FROM m) WHERE k = 1")
def best_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best measure of each KPI and year; of equals the later one."""
    return ranking.best_of_year(_measures(spark, sf_dir)).select("kpi_name", F.col("year").cast("long").alias("year"), "pos1", "pos2", "score")


@query(f"WITH {_MEASURE_SQL} SELECT kpi_name, count(*) AS n, round(sum(score), 2) AS total FROM (SELECT *, max(score) OVER (PARTITION BY kpi_name) AS b FROM m) WHERE score >= 500 AND score >= 0.75 * b GROUP BY kpi_name")
def score_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures that come near their KPI's best."""
    return filters.score_thresholds(_measures(spark, sf_dir), F.lit(500.0)).groupBy("kpi_name").agg(F.count("*").alias("n"), F.round(F.sum("score"), 2).alias("total"))


@query(f"WITH {_MEASURE_SQL}, d AS (SELECT *, bool_or(year IS NOT NULL) OVER (PARTITION BY kpi_name) AS dated FROM m) SELECT kpi_name, count(*) AS n, count(year) AS n_dated FROM d WHERE year IS NOT NULL OR NOT dated GROUP BY kpi_name")
def year_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undated measures give way to dated ones of their KPI."""
    return filters.prefer_dated(_measures(spark, sf_dir)).groupBy("kpi_name").agg(F.count("*").alias("n"), F.count("year").alias("n_dated"))


@query(f"""WITH {_MEASURE_SQL} SELECT kpi_name, q, (SELECT year FROM m x WHERE x.kpi_name = g.kpi_name AND x.q = g.q AND x.year IS NOT NULL ORDER BY x.pos1, x.pos2 LIMIT 1) AS year,
  (SELECT score FROM m x WHERE x.kpi_name = g.kpi_name AND x.q = g.q ORDER BY x.pos1, x.pos2 LIMIT 1) AS score FROM (SELECT DISTINCT kpi_name, q FROM m) g""")  # fmt: skip
def group_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each KPI and quantity: the first value of each column that is not null."""
    return ranking.group_first(_measures(spark, sf_dir).select("kpi_name", "q", "year", "score", "pos"), ["kpi_name", "q"], ["pos"]).drop("pos")


@query(f"WITH {_MEASURE_SQL}, n AS (SELECT pos1, count(DISTINCT year) AS k FROM m GROUP BY pos1) SELECT pos1, round(sum(score * power(1.2, greatest(k - 1, 0))), 4) AS total FROM m JOIN n USING (pos1) GROUP BY pos1")
def year_multiplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of orders raised for every further year that they have."""
    return ranking.year_multiplier(_measures(spark, sf_dir), ["pos1"]).groupBy("pos1").agg(F.round(F.sum("score"), 4).alias("total"))


@query("""SELECT e.event_id, (SELECT p.event_id FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts <= e.ts ORDER BY p.ts DESC, p.event_id DESC LIMIT 1) AS last_purchase FROM events e""")
def asof_last_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As-of join: each event with its user's last purchase."""
    events = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    marks = events.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("event_id").alias("last_purchase"))
    return ranking.last_at_or_before(events, marks, ["user_id"], "ts", "last_purchase").select("event_id", "last_purchase")


@query("""WITH d AS (SELECT user_id, event_id, CAST(floor(value) AS BIGINT) % 3 AS v FROM events), s AS (SELECT *, v - lag(v) OVER w AS t FROM d WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
  c AS (SELECT *, CASE WHEN t IN (1, -1) THEN t END AS st FROM s), b AS (SELECT *, lag(st) OVER (PARTITION BY user_id ORDER BY event_id) AS ls FROM c)
  SELECT user_id, event_id, v, CAST(sum(CASE WHEN st IS NULL OR (ls IS NOT NULL AND ls <> st) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM b""")  # fmt: skip
def consecutive_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps and islands over each user's values."""
    d = read(spark, sf_dir, "events").select("user_id", "event_id", (F.floor("value") % 3).alias("v"))
    return ranking.step_runs(d, ["user_id"], "event_id", "v").select("user_id", "event_id", "v", "run")


@query("SELECT user_id, round(median(value) * 1.1, 6) AS max_gap FROM events GROUP BY user_id")
def median_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greatest gap that still belongs to a column: the median and a tenth."""
    return ranking.max_line_gap(read(spark, sf_dir, "events"), ["user_id"], "value").select("user_id", F.round("max_gap", 6).alias("max_gap"))


# ---- reshape --------------------------------------------------------------------------------------------------------


@query(f"WITH {ANN_SQL} SELECT ann_id, page, md5(paragraph) AS paragraph FROM (SELECT ann_id, unnest(source_page) AS page, first_text AS paragraph FROM anns)")
def zip_explode_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated paragraphs with their pages. A paragraph with the list's own delimiter in it would be two."""
    a = annotations(spark, sf_dir).withColumn("relevant_paragraphs", text.paragraph_list(F.col("relevant_paragraphs")))
    return paragraphs.zip_pages(a).select("ann_id", "page", F.md5("paragraph").alias("paragraph"))


@query("""SELECT doc_id, metric, CAST(value AS BIGINT) AS value FROM (SELECT doc_id, quality, toxic FROM labels) UNPIVOT (value FOR metric IN (quality, toxic))""")
def melt_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as rows."""
    return read(spark, sf_dir, "labels").unpivot("doc_id", ["quality", "toxic"], "metric", "value").withColumn("value", F.col("value").cast("long"))


@query(f"""WITH {KPI_SQL}, {PARA_SQL}, rel AS (SELECT pdf_name, question AS kpi, kpi_id, page0, para_idx, text, {_SCORE} AS s FROM paras, kpis WHERE {_SCORE} >= 0.5), {_MEASURE_SQL}
  SELECT 'KPI_EXTRACTION_ML' AS "METHOD", pdf_name || '.pdf' AS "PDF_NAME", kpi_id AS "KPI_ID", kpi AS "KPI_NAME", page0 + 1 AS "PAGE", round(s, 6) AS "SCORE" FROM rel
  UNION ALL SELECT 'KPI_EXTRACTION_RULE_BASED', 'order' || pos1, CAST(pos2 AS DOUBLE), kpi_name, CAST(pos2 AS INTEGER), round(score, 6) FROM m""")  # fmt: skip
def union_of_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both paths' rows as one relation of nineteen columns, of which six are kept here."""
    null = F.lit(None)
    ml = inference.relevant_paragraphs(paragraph_table(spark, sf_dir), kpis(spark))
    ml = joins.with_kpi_id(ml, kpis(spark)).withColumns({"answer": null.cast("string"), "source": F.lit("Text"), "score": F.col("paragraph_relevance_score"), "no_ans_score": null.cast("double"), "no_answer_score_plus_boost": null.cast("double")})
    rb = _measures(spark, sf_dir).select(
        F.col("pos2").cast("double").alias("kpi_id"), "kpi_name", F.concat(F.lit("order"), F.col("pos1").cast("string")).alias("src_file"), F.col("pos2").cast("int").alias("page_num"),
        F.col("q").cast("string").alias("value"), null.cast("string").alias("raw_txt"), null.cast("double").alias("pos_x"), null.cast("double").alias("pos_y"), "score", "year", null.cast("string").alias("unit"),
    )
    return reshape.joined_result(rb, ml).select("METHOD", "PDF_NAME", "KPI_ID", "KPI_NAME", "PAGE", F.round("SCORE", 6).alias("SCORE"))


_SQUAD_SQL = "SELECT 'conv' || conv_id AS title, md5(text) AS context, turn AS id, role AS question, role = 'user' AS is_impossible, CASE WHEN role <> 'user' THEN md5(text) END AS answer FROM conversations"


def _squad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = F.when(F.col("role") != "user", F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    c = read(spark, sf_dir, "conversations")
    return c.select(F.col("turn").alias("pos"), F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("title"), F.md5("text").alias("context"), F.col("role").alias("question"), F.md5("text").alias("answer"), starts.alias("answer_starts"))


@query(_SQUAD_SQL)
def squad_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows nested as for reading comprehension and flattened again."""
    return reshape.flatten_squad(reshape.nest_squad(_squad_rows(spark, sf_dir))).select("title", "context", "id", "question", "is_impossible", "answer")


@query(f"SELECT title, count(*) AS n FROM ({_SQUAD_SQL}) WHERE NOT is_impossible GROUP BY title")
def squad_answerable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions that can be answered, by title."""
    return reshape.flatten_squad(reshape.answerable(reshape.nest_squad(_squad_rows(spark, sf_dir)))).groupBy("title").agg(F.count("*").alias("n"))


@query(f"WITH {PARA_SQL} SELECT pdf_name, page0, count(*) AS n, md5(string_agg(text, '|' ORDER BY para_idx)) AS texts FROM paras GROUP BY ALL")
def page_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs written as one JSON text for each report and read again."""
    back = reshape.pages_from_json(reshape.pages_to_json(paragraph_table(spark, sf_dir)))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("para_idx", "text"))), lambda x: x["text"])
    return back.groupBy("pdf_name", "page0").agg(F.count("*").alias("n"), F.md5(F.array_join(texts, "|")).alias("texts"))


# ---- samples --------------------------------------------------------------------------------------------------------

_BUCKET = lambda n, seed, key: f"CAST('0x' || substr(md5('{seed}|' || {key}), 1, 8) AS BIGINT) % {n}"


@query(f"SELECT doc_id, CASE WHEN {_BUCKET(1000000, 7, 'doc_id')} < 200000 THEN 'dev' ELSE 'train' END AS split, CAST({_BUCKET(5, 11, 'doc_id')} AS INTEGER) AS fold FROM documents")
def split_and_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the documents for development, and five folds."""
    docs = read(spark, sf_dir, "documents").select("doc_id")
    return sampling.fold(sampling.split(docs, 0.2, 7, "doc_id"), 5, 11, "doc_id")


@query(f"""WITH {ANN_SQL}, c AS (SELECT a.ann_id, p.page0, p.para_idx, row_number() OVER (PARTITION BY a.ann_id ORDER BY md5('42|' || a.ann_id || '|' || p.page0 || '|' || p.para_idx), p.page0, p.para_idx) AS k
  FROM anns a JOIN paras p ON p.pdf_name = a.pdf_name AND p.page0 >= 1 AND p.page0 + 1 <> a.source_page[1]) SELECT ann_id, page0, para_idx FROM c WHERE k <= 2""")  # fmt: skip
def negative_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two paragraphs on other pages for each annotation."""
    a = annotations(spark, sf_dir).select("ann_id", "pdf_name", F.transform("source_page", lambda p: p - 1).alias("pages"))
    return sampling.negatives(a, paragraph_table(spark, sf_dir), 2, 42, 0, 1).select("ann_id", "page0", "para_idx")


# ---- evaluation -----------------------------------------------------------------------------------------------------

_CONF = "count(*) FILTER (quality = 1 AND toxic = 0) AS tp, count(*) FILTER (quality = 0 AND toxic = 0) AS fp, count(*) FILTER (quality = 1 AND toxic = 1) AS fn, count(*) FILTER (quality = 0 AND toxic = 1) AS tn"


@query(f"""WITH c AS (SELECT d.lang, {_CONF} FROM labels l JOIN documents d USING (doc_id) GROUP BY d.lang) SELECT lang, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS "precision", round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall, round(CASE WHEN tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1, tp + fn AS support FROM c""")  # fmt: skip
def classification_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion counts and scores by language, clean text taken as the prediction of quality."""
    rows = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    out = metrics.scores(metrics.confusion(rows, F.col("quality") == 1, F.col("toxic") == 0, ("lang",)))
    return out.select("lang", "tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")], "support")


_SPAN_SQL = "s AS (SELECT l_orderkey AS o, l_linenumber AS l, CASE WHEN l_suppkey % 7 = 0 THEN -1 ELSE l_suppkey % 10 END AS a0, CASE WHEN l_partkey % 5 = 0 THEN -1 ELSE l_partkey % 10 END AS p0, CAST(l_quantity AS BIGINT) % 4 AS n FROM lineitem)"


@query(f"""WITH {_SPAN_SQL}, e AS (SELECT *, CASE WHEN a0 < 0 THEN -1 ELSE a0 + n END AS a1, CASE WHEN p0 < 0 THEN -1 ELSE p0 + n END AS p1 FROM s),
  v AS (SELECT *, CASE WHEN a0 < 0 OR p0 < 0 THEN 0 ELSE greatest(least(a1, p1) - greatest(a0, p0) + 1, 0) END AS ov, a0 = p0 AND a1 = p1 AS same FROM e)
  SELECT n, count(*) AS rows, round(avg(CAST(same AS INT)), 6) AS em, round(avg(CASE WHEN same THEN 1.0 WHEN a0 < 0 OR p0 < 0 THEN 0.0 ELSE 2.0 * ov / (a1 - a0 + 1 + p1 - p0 + 1) END), 6) AS f1, round(avg(CASE WHEN same OR ov > 0 THEN 1.0 ELSE 0.0 END), 6) AS relaxed_f1 FROM v GROUP BY n""")  # fmt: skip
def span_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact match, F1 and relaxed F1 of token spans."""
    li = read(spark, sf_dir, "lineitem")
    a0 = F.when(F.col("l_suppkey") % 7 == 0, -1).otherwise(F.col("l_suppkey") % 10)
    p0 = F.when(F.col("l_partkey") % 5 == 0, -1).otherwise(F.col("l_partkey") % 10)
    s = li.select(a0.alias("a0"), p0.alias("p0"), (F.col("l_quantity").cast("long") % 4).alias("n"))
    end = lambda c: F.when(F.col(c) < 0, -1).otherwise(F.col(c) + F.col("n"))
    v = s.select("n", metrics.span_scores(F.col("a0"), end("a0"), F.col("p0"), end("p0")).alias("m"))
    return v.groupBy("n").agg(F.count("*").alias("rows"), *[F.round(F.avg(f"m.{c}"), 6).alias(c) for c in ("em", "f1", "relaxed_f1")])


@query("""WITH f AS (SELECT l_linenumber % 5 AS fold, avg(l_discount) AS f1, avg(l_tax) AS em FROM lineitem GROUP BY 1)
  SELECT round(avg(f1), 6) AS mean_f1, round(stddev_pop(f1), 6) AS std_f1, round(avg(em), 6) AS mean_em, round(stddev_pop(em), 6) AS std_em FROM f""")
def fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and standard deviation over folds."""
    folds = read(spark, sf_dir, "lineitem").groupBy((F.col("l_linenumber") % 5).alias("fold")).agg(F.avg("l_discount").alias("f1"), F.avg("l_tax").alias("em"))
    out = metrics.fold_summary(folds, ["f1", "em"])
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("""WITH e AS (SELECT o_custkey AS kpi_id, o_orderpriority AS src_file, year(o_orderdate) AS year, min(CAST(o_totalprice AS VARCHAR)) AS v FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY ALL),
  m AS (SELECT o_custkey AS kpi_id, o_orderpriority AS src_file, year(o_orderdate) AS year, max(o_totalprice) AS v FROM orders WHERE o_orderkey % 3 <> 1 GROUP BY ALL)
  SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN e.v IS NULL THEN 'FP' WHEN m.v IS NULL THEN 'FN' WHEN abs(CAST(e.v AS DOUBLE) - m.v) < 0.0001 THEN 'TP' ELSE 'FP' END AS verdict FROM e FULL JOIN m USING (kpi_id, src_file, year)) GROUP BY verdict""")  # fmt: skip
def measure_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected against measured values by KPI, file and year."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("kpi_id"), F.col("o_orderpriority").alias("src_file"), F.year("o_orderdate").alias("year"), F.col("o_totalprice").cast("string").alias("value"), F.col("o_totalprice").alias("score"))
    out = joins.matched_measures(o.where("o_orderkey % 3 <> 0"), o.where("o_orderkey % 3 <> 1"))
    return out.groupBy("verdict").agg(F.count("*").alias("n"))


# ---- places ---------------------------------------------------------------------------------------------------------

_RECT_SQL = "i AS (SELECT l_orderkey AS page, l_linenumber AS item, CAST(l_suppkey % 40 AS DOUBLE) AS x0, CAST(l_partkey % 60 AS DOUBLE) AS y0, l_suppkey % 40 + 5 + l_quantity / 10 AS x1, l_partkey % 60 + 4.0 AS y1 FROM lineitem)"


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("item"), (F.col("l_suppkey") % 40).cast("double").alias("x0"), (F.col("l_partkey") % 60).cast("double").alias("y0"),
        (F.col("l_suppkey") % 40 + 5 + F.col("l_quantity") / 10).alias("x1"), (F.col("l_partkey") % 60 + 4.0).alias("y1"),
    )


_INTER = "greatest(least(r.x1, i.x1) - greatest(r.x0, i.x0), 0) * greatest(least(r.y1, i.y1) - greatest(r.y0, i.y0), 0)"


@query(f"WITH {_RECT_SQL} SELECT r.page, r.item AS rect, i.item FROM i r JOIN i ON r.page = i.page WHERE {_INTER} > 0.3 * (i.x1 - i.x0) * (i.y1 - i.y0)")
def items_in_rect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that lie in another's rectangle for more than three tenths."""
    items = _items(spark, sf_dir)
    rects = items.select("page", F.col("item").alias("rect"), *[F.col(c).alias(f"r_{c}") for c in ("x0", "y0", "x1", "y1")])
    return joins.items_in(rects, items, ["page"]).select("page", "rect", "item")


@query(f"""WITH {_RECT_SQL}, g AS (SELECT r.page, r.item AS a, i.item AS b, greatest(i.x0 - r.x1, r.x0 - i.x1, 0) AS dx, greatest(i.y0 - r.y1, r.y0 - i.y1, 0) AS dy FROM i r JOIN i ON r.page = i.page AND r.item <> i.item),
  k AS (SELECT *, row_number() OVER (PARTITION BY page, a ORDER BY sqrt(dx * dx + dy * dy), b) AS n FROM g) SELECT page, a AS item, b AS nearest, round(sqrt(dx * dx + dy * dy), 6) AS distance FROM k WHERE n = 1""")  # fmt: skip
def nearest_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest other item of the page."""
    items = _items(spark, sf_dir)
    others = items.select("page", F.col("item").alias("other"), *[F.col(c).alias(f"o_{c}") for c in ("x0", "y0", "x1", "y1")])
    pairs = items.join(others, "page").where("item <> other").withColumn("d", geometry.gap(geometry.Rect.of(), geometry.Rect.of("o_")))
    return ranking.nearest(pairs, ["page", "item"], F.col("d"), "other").select("page", "item", F.col("other").alias("nearest"), F.round("d", 6).alias("distance"))


@query("""WITH t AS (SELECT l_orderkey AS o, l_linenumber AS l, l_suppkey % 50 AS b, l_suppkey % 50 + CAST(l_quantity AS BIGINT) AS e FROM lineitem)
  SELECT a.o, a.l AS a, b.l AS b, a.b <= b.b AND b.e <= a.e AS covers FROM t a JOIN t b ON a.o = b.o AND a.l <> b.l AND a.b < b.e AND b.b < a.e""")
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping annotation intervals, and whether one covers the other."""
    li = read(spark, sf_dir, "lineitem")
    begin = F.col("l_suppkey") % 50
    side = lambda p: li.select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias(p), begin.alias(f"{p}_begin"), (begin + F.col("l_quantity").cast("long")).alias(f"{p}_end"))
    met = joins.overlapping(side("a"), side("b"), "o").where("a <> b")
    return met.select("o", "a", "b", ((F.col("a_begin") <= F.col("b_begin")) & (F.col("b_end") <= F.col("a_end"))).alias("covers"))


_CELL_SQL = "cells AS (SELECT l_orderkey AS t, l_linenumber AS row, unnest([0, 1, 2]) AS col, unnest([l_linestatus, CAST(l_quantity AS VARCHAR), CASE WHEN l_linenumber = 1 THEN CAST(year(l_shipdate) AS VARCHAR) ELSE CAST(l_tax AS VARCHAR) END]) AS txt FROM lineitem)"


def _cells(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """Each order as a table of three columns; whole: its rows are brought together before they become cells."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_quantity", "l_shipdate", "l_tax")
    if whole:
        li = li.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
    last = F.when(F.col("l_linenumber") == 1, F.year("l_shipdate").cast("string")).otherwise(F.col("l_tax").cast("string"))
    return li.select(F.col("l_orderkey").alias("t"), F.col("l_linenumber").alias("row"), F.posexplode(F.array("l_linestatus", F.col("l_quantity").cast("string"), last)).alias("col", "txt"))


_SQL_CELL_NUMBER = rf"regexp_full_match(translate(txt, ' ()$%', ''), '{shape.NUMBER}\**') AND len(translate(txt, ' ()$%', '')) > 0 AND NOT regexp_full_match(replace(txt, ' ', ''), '{shape.YEAR[1:-1]}')"


@query(rf"""WITH {_CELL_SQL}, g AS (SELECT t, count(DISTINCT row) AS n_rows, count(DISTINCT col) AS n_cols, count(*) AS n_cells, count(*) FILTER ({_SQL_CELL_NUMBER}) AS n_numeric,
    count(*) FILTER (({_SQL_CELL_NUMBER}) OR regexp_matches(txt, '\p{{N}}')) AS n_weak FROM cells GROUP BY t), d AS (SELECT *, n_cells / (n_rows * n_cols) AS density FROM g)
  SELECT t, n_rows, n_cols, n_numeric, n_rows >= 2 AND n_cols >= 2 AND n_cells >= 4 AND density >= 0.2 AND
    ((n_numeric > 3 AND density > 0.6) OR (n_numeric > 7 AND density > 0.4) OR n_numeric > 10 OR (n_weak > 3 AND n_cells > 5 AND density > 0.4)) AS good FROM d""")  # fmt: skip
def table_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which reconstructed tables look like tables."""
    return ranking.good_tables(_cells(spark, sf_dir), ["t"]).select("t", "n_rows", "n_cols", "n_numeric", "good")


@query(f"""WITH {_CELL_SQL}, c AS (SELECT t, row, col, min(txt) AS txt FROM cells GROUP BY ALL), w AS (SELECT t, row, string_agg('"' || txt || '"', ',' ORDER BY col) AS line FROM c GROUP BY t, row) SELECT t, row, line FROM w""")
def table_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables as CSV lines."""
    return reshape.table_lines(_cells(spark, sf_dir), ["t"]).select("t", "row", "line")


# ---- composites -----------------------------------------------------------------------------------------------------


_EXAMPLES_SQL = f"""c AS (SELECT a.ann_id, a.kpi_id, p.text, row_number() OVER (PARTITION BY a.ann_id ORDER BY md5('42|' || a.ann_id || '|' || p.page0 || '|' || p.para_idx), p.page0, p.para_idx) AS k
    FROM anns a JOIN paras p ON p.pdf_name = a.pdf_name AND p.page0 >= 1 AND p.page0 + 1 <> a.source_page[1] WHERE a.data_type = 'TEXT' AND coalesce(a.company <> 'CEZ', true)),
  united AS (SELECT ann_id, kpi_id, first_text AS text, 1 AS label FROM anns WHERE data_type = 'TEXT' AND coalesce(company <> 'CEZ', true) UNION ALL SELECT ann_id, kpi_id, text, 0 FROM c WHERE k <= 2),
  named AS (SELECT q.question, {CURATED} AS context, b.label, b.ann_id FROM united b JOIN kpis q ON CAST(b.kpi_id AS DOUBLE) = q.kpi_id)"""


@query(f"WITH {KPI_SQL}, {ANN_SQL}, {_EXAMPLES_SQL} SELECT question, context, label, ann_id FROM (SELECT *, row_number() OVER (PARTITION BY question, context ORDER BY ann_id, label) AS n FROM named) WHERE n = 1")
def relevance_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set of the relevance model: positives, sampled negatives, once for each question and context."""
    out = curation.relevance_examples(annotations(spark, sf_dir), paragraph_table(spark, sf_dir), kpis(spark), ratio=2, skip_pages=1)
    return out.select("question", "context", "label", "ann_id")


def _answered(column: str) -> str:
    return rf"regexp_replace(lower(translate({_cleaned(column, chr(92) + 'n')}, '()^+*$|\?[]{{}}', '')), '\.{{2,}}', '', 'g')"


_LINE = rf"regexp_replace(replace(answer, chr(10), ' '), '^[\s\x{{0b}}\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]+|[\s\x{{0b}}\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]+$', '', 'g')"
_SQUAD_CURATION_SQL = rf"""WITH {KPI_SQL}, {ANN_SQL}, asked AS (SELECT a.*, k.question AS plain, CASE WHEN k.add_year THEN string_split(k.question, '?')[1] || ' in year ' || a.year || '?' ELSE k.question END AS question
    FROM anns a JOIN kpis k ON CAST(a.kpi_id AS DOUBLE) = k.kpi_id),
  lined AS (SELECT *, {_LINE} AS line FROM asked), clean AS (SELECT pdf_name, kpi_id, question, page0, {_answered('line')} AS answer, {_answered('first_text')} AS part FROM lined WHERE line IS NOT NULL AND line <> ''),
  whole AS (SELECT pdf_name, page0, para_idx, {_answered('text')} AS text FROM paras),
  near AS (SELECT c.pdf_name, c.kpi_id, c.question, c.answer, (SELECT w.text FROM whole w WHERE w.pdf_name = c.pdf_name AND w.page0 = c.page0 AND contains(w.text, c.part) ORDER BY w.para_idx LIMIT 1) AS context, 0 AS extra FROM clean c),
  more AS (SELECT c.pdf_name, c.kpi_id, c.question, c.answer, w.text AS context, 1 AS extra FROM clean c JOIN whole w ON w.pdf_name = c.pdf_name AND w.page0 <> c.page0 AND contains(w.text, c.answer) WHERE CAST(c.kpi_id AS DOUBLE) NOT IN (0, 1, 9, 11)),
  once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pdf_name, question, answer, context ORDER BY extra, kpi_id) AS k FROM (SELECT * FROM near UNION ALL SELECT * FROM more)) WHERE k = 1),
  cut AS (SELECT *, string_split(context, answer) AS pieces FROM once WHERE answer <> ''),
  spots AS (SELECT pdf_name, question, answer, context, unnest(list_transform(range(1, len(pieces)), lambda k: CAST(list_sum(list_transform(pieces[1:k], lambda x: len(x))) + (k - 1) * len(answer) AS INTEGER))) AS i FROM cut),
  free AS (SELECT * FROM spots WHERE NOT regexp_full_match(answer, '\p{{N}}+') OR (i > 0 AND regexp_full_match(substr(context, i, 1), '[^0-9]')) OR regexp_full_match(substr(context, i + 1 + len(answer), 1), '[^0-9]')),
  found AS (SELECT pdf_name, question, answer, context, list(i ORDER BY i) AS starts FROM free GROUP BY ALL),
  placed AS (SELECT pdf_name, question, answer, CASE WHEN starts[1] = 0 THEN ' ' || context ELSE context END AS context, CASE WHEN starts[1] = 0 THEN list_transform(starts, lambda x: x + 1) ELSE starts END AS starts FROM found),
  rel AS (SELECT pdf_name, page0, para_idx, question, text FROM paras, kpis WHERE {_SCORE} >= 0.5),
  unanswered AS (SELECT r.pdf_name, r.question, '' AS answer, r.text AS context, [] AS starts FROM rel r WHERE r.pdf_name IN (SELECT pdf_name FROM asked) AND NOT EXISTS (SELECT 1 FROM asked a WHERE a.pdf_name = r.pdf_name AND a.page0 = r.page0)
    AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT plain, answer FROM asked WHERE answer IS NOT NULL) b WHERE b.plain = r.question AND contains(r.text, b.answer))),
  united AS (SELECT * FROM placed UNION ALL SELECT * FROM unanswered),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY pdf_name ORDER BY context, question, answer) AS id FROM united)
  SELECT pdf_name AS title, context, CAST(id AS BIGINT) AS id, question, len(starts) = 0 AS is_impossible, CASE WHEN len(starts) > 0 THEN answer END AS answer, unnest(CASE WHEN len(starts) > 0 THEN starts ELSE [NULL] END) AS answer_start FROM numbered"""


@query(_SQUAD_CURATION_SQL)
def squad_curation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set of the answer model: located answers, further ones, unanswerable questions, split by paragraph."""
    asked, paras = annotations(spark, sf_dir), paragraph_table(spark, sf_dir)
    rows = curation.answerable_rows(curation.answer_rows(asked, kpis(spark)), paras)
    rel = inference.relevant_paragraphs(paras, kpis(spark)).select("pdf_name", "page0", "para_idx", F.col("kpi").alias("question"), F.col("paragraph").alias("text"))
    known = joins.with_question(asked, kpis(spark)).where("question is not null").select("pdf_name", "page0", "question", "answer")
    return reshape.flatten_squad(curation.squad(rows, rel, known, 0.2, 7))


_NONE = "CAST(NULL AS VARCHAR)"


@query(_ANSWERS_SQL.replace("rank() OVER (PARTITION BY pdf_name, kpi ORDER BY score DESC) AS k, ", "").replace("ORDER BY score DESC, answer) AS n", "ORDER BY score DESC, answer, page0, para_idx) AS n") + f""",
boosted AS (SELECT pdf_name, kpi, page0, para_idx, coalesce(list_filter(a, lambda x: x.answer = 'no_answer')[1].score, a[1].score) AS b FROM pair)
SELECT 'KPI_EXTRACTION_ML' AS "METHOD", t.pdf_name || '.pdf' AS "PDF_NAME", t.kpi_id AS "KPI_ID", t.kpi AS "KPI_NAME", t.kpi AS "KPI_DESC", t.answer AS "ANSWER_RAW", t.answer AS "ANSWER", CAST(coalesce(t.page0 + 1, -1) AS INTEGER) AS "PAGE",
  t.paragraph AS "PARAGRAPH", t.rel AS "PARAGRAPH_RELEVANCE_SCORE", CAST(NULL AS DOUBLE) AS "POS_X", CAST(NULL AS DOUBLE) AS "POS_Y", 'Text' AS "KPI_SOURCE", t.score AS "SCORE", CAST(b.b AS DOUBLE) + 15 AS "NO_ANS_SCORE", CAST(b.b AS DOUBLE) AS "SCORE_PLUS_BOOST",
  CAST(NULL AS INTEGER) AS "KPI_YEAR", {_NONE} AS "UNIT_RAW", {_NONE} AS "UNIT" FROM top t LEFT JOIN boosted b ON b.pdf_name = t.pdf_name AND b.kpi = t.kpi AND b.page0 = t.page0 AND b.para_idx = t.para_idx WHERE t.n <= 4""")  # fmt: skip
def kpi_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: paragraphs, questions, relevance, answers, ranks and the joined result of nineteen columns."""
    return reshape.joined_result(None, inference.extract_answers(paragraph_table(spark, sf_dir), kpis(spark)))


# ---- rules and layout -----------------------------------------------------------------------------------------------

_RULE = DescriptionRule(".*(^| )(the|der|les?|las?)( |$).*", 1000.0, decay=0.8, hit_decay=0.9, half_life=20.0, free_letters=40)


@query(rf"""WITH {LINE_SQL}, n AS (SELECT pdf_name, para_idx, regexp_matches(lower(text), '^.*(^| )(the|der|les?|las?)( |$)') AS hit, len(regexp_replace(text, '[^a-z ]', '', 'g')) AS l FROM lines),
  h AS (SELECT *, sum(CAST(hit AS INT)) OVER (PARTITION BY pdf_name ORDER BY para_idx) - 1 AS k FROM n)
  SELECT pdf_name, round(coalesce(sum(1000 * power(0.8, para_idx) * power(0.9, k) * power(power(0.5, 0.05), greatest(l - 40, 0))) FILTER (hit), 0), 6) AS score FROM h GROUP BY pdf_name""")  # fmt: skip
def rule_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A description rule over the lines of each report, nearest first."""
    docs = read(spark, sf_dir, "documents").where("text is not null")
    return docs.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("pdf_name"), F.round(_RULE.match(F.split("text", "\n", -1))["score"], 6).alias("score"))


_KPI_RULE = KpiRule(1.0, "shipments", (DescriptionRule(".*[of].*", 900.0),), numeric=True, minimum_score=100.0)


@query(f"""WITH {_CELL_SQL}, c AS (SELECT t, row, col, min(txt) AS txt FROM cells GROUP BY ALL), v AS (SELECT c.t, c.row, c.col, c.txt, CAST(coalesce(y.txt, '2019') AS INTEGER) AS year
    FROM c LEFT JOIN c y ON y.t = c.t AND y.row = c.row AND y.row = 1 AND y.col = 2 WHERE c.col = 1 OR (c.col = 2 AND c.row > 1))
  SELECT 'shipments ' || t AS kpi_name, CAST(1 AS DOUBLE) AS kpi_id, year, txt AS value, CAST(900 AS DOUBLE) AS score, 'AT.indirect' AS match_type, row, col
  FROM (SELECT *, row_number() OVER (PARTITION BY t, year ORDER BY row DESC, col DESC) AS k FROM v) WHERE k = 1""")  # fmt: skip
def cell_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule path over bare cells, tables of order lines: direct and indirect years, best of each year, near the best."""
    cells = _cells(spark, sf_dir, whole=True).groupBy("t", "row", "col").agg(F.min("txt").alias("txt"))
    both = rule_based.year_measures(cells, [_KPI_RULE], ["t"], 2019).withColumn("pos", F.struct("row", "col", "match_type")).withColumn("kpi_name", F.concat("kpi_name", F.lit(" "), F.col("t").cast("string")))
    return rule_based.directory_measures(both, 100.0, ("t",)).select("kpi_name", "kpi_id", "year", "value", "score", "match_type", "row", "col")


def _placed(k: int | str, txt, x0, y, letter: float = 6.0):
    """A word of a page laid out by formula: its item, text, and box."""
    item = F.lit(k) if isinstance(k, int) else F.expr(k)
    return F.struct(item.cast("int").alias("item_id"), txt.alias("txt"), x0.cast("double").alias("x0"), y.cast("double").alias("y0"), (x0 + letter * F.length(txt)).cast("double").alias("x1"), (y + 12).cast("double").alias("y1"))


def _as_words(pages: DataFrame, height: float) -> DataFrame:
    """(doc, page, words) as positioned words; words of an item follow each other."""
    w = pages.select("doc", "page", F.explode("words").alias("w")).select("doc", "page", "w.*")
    place = F.row_number().over(Window.partitionBy("doc", "page", "item_id").orderBy("x0")) - 1
    return w.select(
        "doc", "page", "item_id", place.cast("int").alias("word_idx"), "txt", "x0", "y0", "x1", "y1", F.lit("f1").alias("font"), F.lit(10).alias("font_size"), F.lit(False).alias("is_bold"), F.lit(0.0).alias("brightness"),
        F.lit(609.0).alias("page_width"), F.lit(height).alias("page_height"),
    )


_YEARS = (2017, 2018, 2019)
_LABELS = ("Scope 1 direct GHG emissions", "Scope 2 indirect GHG emissions", "Water use")


def _emission_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each customer, ten pages a report: a headline, years, and three rows of numbers."""
    key = F.col("c_custkey")
    words = []
    line = lambda item, t, x, y: [_placed(item, F.lit(w), F.lit(x + 6.0 * len(" ".join(t.split(" ")[:j] + [""]))), F.lit(y)) for j, w in enumerate(t.split(" "))]
    words += line(0, "Greenhouse gas emissions in tonnes CO2e", 50.0, 60.0)
    for j, year in enumerate(_YEARS):
        words.append(_placed(1 + j, F.lit(str(year)), F.lit(320.0 + 100 * j), F.lit(100.0)))
    for k, label in enumerate(_LABELS):
        words += line(10 + 10 * k, label, 50.0, 120.0 + 20 * k)
        for j in range(3):
            words.append(_placed(11 + 10 * k + j, (3000 + key * (k + 2) % 1500 * 4 + j).cast("string"), F.lit(320.0 + 100 * j), F.lit(120.0 + 20 * k)))
    customers = read(spark, sf_dir, "customer").select("c_custkey").distinct()
    pages = customers.select(F.concat(F.lit("report"), F.floor(key / 10).cast("string")).alias("doc"), (key % 10).cast("int").alias("page"), F.array(*words).alias("words"))
    return _as_words(pages, 841.0)


@query("""WITH p AS (SELECT c_custkey // 10 AS d, max(c_custkey) AS k FROM customer GROUP BY 1), y AS (SELECT unnest([0, 1, 2]) AS j), r AS (SELECT unnest([0, 1]) AS k)
  SELECT 'report' || p.d AS src_file, CAST(6 + r.k AS DOUBLE) AS kpi_id, CAST(p.k % 10 AS INTEGER) AS page_num, CAST(2017 + y.j AS INTEGER) AS year, CAST(3000 + (p.k * (r.k + 2)) % 1500 * 4 + y.j AS VARCHAR) AS value, 'AT.direct' AS match_type
  FROM p, y, r""")  # fmt: skip
def rule_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule path end to end: all active rules over the tables of laid out pages, with hierarchy, headline, unit, years,
    texts anywhere on the page, and each report's best; of equal pages the last."""
    found = rule_based.report_measures(_emission_pages(spark, sf_dir), list(ACTIVE), 2019)
    return found.select("src_file", "kpi_id", "page_num", "year", "value", "match_type")


_COORDINATE_SQL = "SELECT 'report' || (c_custkey // 10) AS pdf_name, CAST(c_custkey % 10 AS INTEGER) AS page0, CAST(3000 + c_custkey * 2 % 1500 * 4 AS VARCHAR) AS answer, round(320.0 / 609, 6) AS pos_x, round((SELECT min(120 + 20 * k) FROM (SELECT unnest([0, 1, 2]) AS k) z WHERE c_custkey * (k + 2) % 1500 = c_custkey * 2 % 1500) / 841.0, 6) AS pos_y FROM (SELECT DISTINCT c_custkey FROM customer)"


@query(_COORDINATE_SQL)
def answer_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where answers stand on their pages, as shares of the page."""
    words = _emission_pages(spark, sf_dir).withColumnsRenamed({"doc": "pdf_name", "page": "page0"})
    order = F.sort_array(F.collect_list(F.struct("word_idx", "txt")))
    items = words.groupBy("pdf_name", "page0", "item_id").agg(F.array_join(F.transform(order, lambda w: w["txt"]), " ").alias("txt"), F.first("page_width").alias("page_width"), F.first("page_height").alias("page_height"))
    key = F.col("c_custkey")
    results = read(spark, sf_dir, "customer").select("c_custkey").distinct().select(
        F.concat(F.lit("report"), F.floor(key / 10).cast("string")).alias("pdf_name"), (key % 10).cast("int").alias("page0"), (3000 + key * 2 % 1500 * 4).cast("string").alias("answer")
    )
    return joins.with_coordinates(results, items, words).select("pdf_name", "page0", "answer", F.round("pos_x", 6).alias("pos_x"), F.round("pos_y", 6).alias("pos_y"))


_LAYOUT_SQL = """WITH l AS (SELECT CAST(l_orderkey // 16 AS VARCHAR) AS doc, row_number() OVER (PARTITION BY l_orderkey // 16 ORDER BY l_orderkey, l_linenumber, l_quantity, l_tax, l_discount, l_returnflag) AS r,
    'line ' || l_returnflag AS a, CAST(l_quantity AS VARCHAR) AS b, CAST(l_tax AS VARCHAR) AS c, CAST(l_discount AS VARCHAR) AS d FROM lineitem)
  SELECT doc, 0 AS table_id, CAST(r AS INTEGER) AS row, unnest([0, 1, 2, 3]) AS col, unnest([a, b, c, d]) AS txt, 'cell' AS role FROM l
  UNION ALL SELECT DISTINCT doc, 0, 0, unnest([1, 2, 3]), unnest(['2018', '2019', '2020']), 'cell' FROM l"""


@query(_LAYOUT_SQL)
def layout_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the tables on pages made of order lines: a label and three numbers in a row, years above."""
    li = read(spark, sf_dir, "lineitem").select(F.floor(F.col("l_orderkey") / 16).alias("doc"), "l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount", "l_returnflag")
    order = Window.partitionBy("doc").orderBy("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount", "l_returnflag")
    li = li.withColumn("r", F.row_number().over(order))
    y = 100.0 + 20.0 * F.col("r")
    numbers = [F.col(c).cast("string") for c in ("l_quantity", "l_tax", "l_discount")]
    body = [_placed("r * 10", F.lit("line"), F.lit(50.0), y), _placed("r * 10", F.col("l_returnflag"), F.lit(80.0), y)]
    body += [_placed(f"r * 10 + {k + 1}", t, F.lit(150.0 + 100 * k), y) for k, t in enumerate(numbers)]
    head = [_placed(k + 1, F.lit(str(2018 + k)), F.lit(150.0 + 100 * k), F.lit(100.0)) for k in range(3)]
    pages = li.select("doc", F.array(*body).alias("words")).unionByName(li.select("doc").distinct().select("doc", F.array(*head).alias("words")))
    words = _as_words(pages.select(F.col("doc").cast("string").alias("doc"), F.lit(0).alias("page"), "words"), 2600.0)
    return layout.table_cells(words).select("doc", "table_id", "row", "col", "txt", "role")


@query("""WITH d AS (SELECT 'doc' || doc_id AS pdf_name, doc_id, doc_id % 4 AS n FROM documents), w AS (SELECT pdf_name, unnest([1, 2, 3]) AS kpi_id, n FROM d)
  SELECT pdf_name, CAST(count(*) FILTER (kpi_id <= n) AS INTEGER) AS done, CAST(count(*) FILTER (kpi_id > n) AS INTEGER) AS todo, CASE WHEN count(*) FILTER (kpi_id > n) = 0 THEN 'DONE' ELSE 'TODO' END AS state FROM w GROUP BY pdf_name""")
def annotation_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of three requested KPIs each report has annotations of."""
    docs = read(spark, sf_dir, "documents").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("pdf_name"), (F.col("doc_id") % 4).alias("n"))
    each = docs.withColumn("kpi_id", F.explode(F.array(*[F.lit(float(k)) for k in (1, 2, 3)])))
    return metrics.progress(each.where("kpi_id <= n"), each)


@query("""WITH d AS (SELECT doc_id, md5('5|' || doc_id) AS m FROM documents), n AS (SELECT *, row_number() OVER (ORDER BY m, doc_id) AS k, count(*) OVER () AS c FROM d)
  SELECT doc_id, CASE WHEN k <= CAST(floor(0.7 * c) AS BIGINT) THEN 'train' ELSE 'dev' END AS split FROM n""")
def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split by an exact count of shuffled documents."""
    return sampling.split_exactly(read(spark, sf_dir, "documents").select("doc_id"), 0.3, 5, "doc_id")


@query("""WITH t AS (SELECT 'conv' || conv_id AS title, md5(text) AS context, turn, role FROM conversations), i AS (SELECT title, context, min(turn) AS first FROM t GROUP BY ALL),
  n AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY first, context) - 1 AS index FROM i) SELECT title, count(*) AS n FROM n WHERE index % 2 = 0 GROUP BY title""")
def squad_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second paragraph of each title."""
    nested = reshape.nest_squad(_squad_rows(spark, sf_dir))
    chosen = nested.select("title", F.explode(F.sequence(F.lit(0), F.size("paragraphs") - 1, F.lit(2))).alias("index"))
    return reshape.slice_squad(nested, chosen).select("title", F.size("paragraphs").cast("long").alias("n"))


@query(f"""WITH {_SPAN_SQL}, e AS (SELECT *, CASE WHEN a0 < 0 THEN -1 ELSE a0 + n END AS a1, CASE WHEN p0 < 0 THEN -1 ELSE p0 + n END AS p1 FROM s),
  v AS (SELECT *, CASE WHEN a0 < 0 OR p0 < 0 THEN 0 ELSE greatest(least(a1, p1) - greatest(a0, p0) + 1, 0) END AS ov, a0 = p0 AND a1 = p1 AS same FROM e)
  SELECT CAST(l AS DOUBLE) AS kpi_id, count(*) AS support, round(avg(CAST(same AS INT)), 6) AS em, round(avg(CASE WHEN same THEN 1.0 WHEN a0 < 0 OR p0 < 0 THEN 0.0 ELSE 2.0 * ov / (a1 - a0 + 1 + p1 - p0 + 1) END), 6) AS f1,
    round(avg(CAST((a0 < 0) = (p0 < 0) AS INT)), 6) AS accuracy FROM v GROUP BY l""")  # fmt: skip
def kpi_span_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support, exact match, F1 and accuracy of each KPI's answers."""
    li = read(spark, sf_dir, "lineitem")
    a0 = F.when(F.col("l_suppkey") % 7 == 0, -1).otherwise(F.col("l_suppkey") % 10)
    p0 = F.when(F.col("l_partkey") % 5 == 0, -1).otherwise(F.col("l_partkey") % 10)
    s = li.select(F.col("l_linenumber").cast("double").alias("kpi_id"), a0.alias("a0"), p0.alias("p0"), (F.col("l_quantity").cast("long") % 4).alias("n"))
    end = lambda c: F.when(F.col(c) < 0, -1).otherwise(F.col(c) + F.col("n"))
    out = metrics.by_kpi(s.withColumns({"a1": end("a0"), "p1": end("p0")}))
    return out.select("kpi_id", "support", *[F.round(c, 6).alias(c) for c in ("em", "f1", "accuracy")])
