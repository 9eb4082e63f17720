"""A fast slice of the Spark-vs-DuckDB differential check (sf0.001); the full run is tests/compare.py."""
import duckdb
import pytest

import __spark_entry__ as E
from compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"
FAST = ["c01_clean_providers", "c05_clean_text", "c12_clean_title", "c13_classify_multi", "a08_grand_kpis",
        "a12_executive_summary", "q04_score_providers", "d01_last_wins", "d04_dedup_fuzzy_04",
        "n02_flatten_dedup_sort", "h01_links", "m02_tfidf", "x1_report", "q07_constraints"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    b, bc = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert ac == bc
    assert a == b
