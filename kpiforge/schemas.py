"""Schemas and constants of the relations that operators exchange."""

from __future__ import annotations

PARAGRAPHS = "pdf_name string, page0 int, para_idx int, text string"
KPIS = "kpi_id double, question string, sectors array<string>, add_year boolean, kpi_category array<string>"
ANNOTATIONS = (
    "number int, company string, source_file string, source_page array<int>, kpi_id string, year string, answer string, data_type string, "
    "relevant_paragraphs array<string>, annotator string, sector string, comments string"
)
KPI_MEASURE = (
    "kpi_id double, kpi_name string, src_file string, page_num int, item_ids array<int>, pos_x double, pos_y double, raw_txt string, year int, value string, "
    "score double, unit string, match_type string"
)
SQUAD = (
    "version string, data array<struct<title:string,paragraphs:array<struct<context:string,qas:array<struct<id:bigint,question:string,is_impossible:boolean,"
    "answers:array<struct<text:string,answer_start:int>>>>>>>>"
)
#: The columns of the joined result, in order.
RESULT = (
    "METHOD", "PDF_NAME", "KPI_ID", "KPI_NAME", "KPI_DESC", "ANSWER_RAW", "ANSWER", "PAGE", "PARAGRAPH", "PARAGRAPH_RELEVANCE_SCORE", "POS_X", "POS_Y",
    "KPI_SOURCE", "SCORE", "NO_ANS_SCORE", "SCORE_PLUS_BOOST", "KPI_YEAR", "UNIT_RAW", "UNIT",
)
RESULT_TYPES = {"KPI_ID": "double", "PAGE": "int", "PARAGRAPH_RELEVANCE_SCORE": "double", "POS_X": "double", "POS_Y": "double", "SCORE": "double", "NO_ANS_SCORE": "double", "SCORE_PLUS_BOOST": "double", "KPI_YEAR": "int"}
NO_ANSWER = "no_answer"
TOP_K, NO_ANSWER_BOOST = 4, -15.0
#: How a rule's match counts, and how distances on a page are measured.
MUST_INCLUDE, MAY_INCLUDE, CAN_INCLUDE, MUST_EXCLUDE, MUST_INCLUDE_EACH = range(5)
EUCLID, WEIGHTED, WEIGHTED_UP_ONLY = 0, 1, 3
