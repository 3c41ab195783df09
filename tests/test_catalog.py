"""Every query with SQL is held against DuckDB on the small tables."""

import os

import duckdb
import pytest

from quirelens import catalog

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    q = duck.execute(catalog.ORACLE[name])
    names = [d[0] for d in q.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in q.fetchall()), key=repr)


def test_html_text_has_no_scripts(spark):
    rows = catalog.html_text(spark, SF).collect()
    assert rows and not any("track(" in r["text"] or "<" in r["text"] for r in rows)


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 11
    assert set(e.oracle_sql()) <= set(e.queries())
