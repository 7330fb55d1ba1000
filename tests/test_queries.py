"""Each query against its SQL, on the smallest tables where they are at hand."""

import os

import pytest

import __spark_entry__ as entry
from rollforge import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    out = con.execute(queries.ORACLES[name])
    names = [d[0] for d in out.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(dict(zip(names, r))[c] for c in columns)) for r in out.fetchall())
    assert got == want


@pytest.fixture(scope="module")
def long_document(tmp_path_factory):
    """Customers of two nations: one of 102 pages, one of two."""
    duckdb = pytest.importorskip("duckdb")
    folder = tmp_path_factory.mktemp("long")
    rows = "SELECT i AS c_custkey, 'Customer ' || i AS c_name, CAST(CASE WHEN i < 3050 THEN 3 ELSE 4 END AS INTEGER) AS c_nationkey, 'SEGMENT' || i % 5 AS c_mktsegment FROM range(3090) t(i)"
    duckdb.sql(f"COPY ({rows}) TO '{folder}/customer.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", ["ocr_fake_pipeline", "text_folder", "text_folder_limit"])
def test_more_than_99_pages(spark, long_document, name):
    con = pytest.importorskip("duckdb").connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM read_parquet('{long_document}/customer.parquet')")
    out = con.execute(queries.ORACLES[name])
    names = [d[0] for d in out.description]
    got = sorted(repr(tuple(r)) for r in queries.QUERIES[name](spark, long_document).select(*names).collect())
    assert got == sorted(map(repr, out.fetchall()))


def test_entry(spark):
    assert entry.entry(spark).count() == 150
    assert set(entry.oracle_sql()) <= set(entry.queries())
