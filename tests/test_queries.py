"""Every query of the engine against its SQL on the smallest data."""

import os

import duckdb
import pytest

from stemma.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    if name not in catalogue.ORACLE_SQL:
        assert got
        return
    r = duck.execute(catalogue.ORACLE_SQL[name])
    columns = [c[0] for c in r.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, r.fetchall())


#: References without a semicolon, cut, nested, numbered and unknown ones; markup over line ends; no text.
PAGES = ["<title>a&amp;b&amp</title><p>x &copy 2020 &amp;lt; &lt;b&gt;</p>", "<p>&#39;t &#39 &#38; &uuml; &ampx; &notit; &nbsp;&nbsp</p>\r\n\n\n<div\nid=1>&quot;y&quot</div>", "&", "", None, "<P>Demo: 1 &lt 2<BR/>z &middot; z</P><p>Inhalt &amp</p>"]


@pytest.mark.parametrize("name", ["html_text", "section_lines"])
def test_references_as_in_the_sql(spark, tmp_path, name):
    spark.createDataFrame(list(enumerate(PAGES)), "page_id bigint, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    df = catalogue.QUERIES[name](spark, str(tmp_path))
    r = con.execute(catalogue.ORACLE_SQL[name])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in r.description], r.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
