"""The driver's contract."""

import pytest

import __spark_entry__ as entry
from pagewright.plans.oracle import oracle_sql
from pagewright.plans.queries import queries

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql(spark):
    assert set(oracle_sql()) == set(queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "section", "md"]


@pytest.mark.parametrize("name", ["line_english", "company_parse", "toc_pages", "table_md", "column_cut", "extract_summary", "extract_reports", "extract_simplified", "extract_audit"])
def test_queries_give_the_rows_of_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from pathlib import Path

    from tools.compare import rows_of

    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    df = queries()[name](spark, SF)
    cur = con.execute(oracle_sql()[name])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in cur.description], cur.fetchall())
