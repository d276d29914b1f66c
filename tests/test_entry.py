"""The driver's contract."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"


def test_every_query_with_sql_has_the_same_columns(spark):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry

    if not Path(SF).is_dir():
        pytest.skip("no test data here")
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    for name in (
        "paragraph_extract", "word_numbers", "top_k_answers", "items_in_rect", "split_and_folds", "exact_split", "extraction_lookup", "unanswerable_pairs", "overlapping_cells", "cell_ancestors", "misspelt_paragraphs", "contained_parts", "needed_texts", "cluster_measures", "question_answers", "scored_measures",
    ):
        df = queries[name](spark, SF)
        cur = con.execute(sql[name])
        columns = [d[0] for d in cur.description]
        assert sorted(df.columns) == sorted(columns)
        order = sorted(columns)
        key = lambda r: tuple(map(repr, r))
        theirs = sorted((tuple(r[columns.index(c)] for c in order) for r in cur.fetchall()), key=key)
        assert sorted((tuple(r[c] for c in order) for r in df.collect()), key=key) == theirs, name


def test_entry_works_without_the_training_data_operators():
    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'kpi_extraction' in e.queries() and 'pipeline' not in e.queries(); print(len(e.oracle_sql()))"
    root = str(Path(__file__).resolve().parent.parent)
    assert int(subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout) > 20
