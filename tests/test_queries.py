"""Every registered query of the library's own operators against its DuckDB SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from evenfield.plans import queries as registered

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables aren't here")


def rows(frame):
    frame = frame[sorted(frame.columns)]
    told = lambda x: "NULL" if x is None or x != x else format(x, ".9g") if isinstance(x, float) else str(x)
    return sorted(tuple(told(x) for x in r) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    found = registered.queries()[name](spark, DATA).toPandas()
    expected = db.execute(registered.oracle_sql()[name]).fetchdf()
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found) == rows(expected)


@pytest.mark.parametrize("name", sorted(set(registered.queries()) - set(registered.oracle_sql())))
def test_other_queries_give_rows(spark, name):
    assert registered.queries()[name](spark, DATA).count() > 0


def test_entry_gives_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert {"column_stats", "correct_both"} <= set(__spark_entry__.queries())
