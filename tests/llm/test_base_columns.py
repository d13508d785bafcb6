"""The columns that SQL can express, of every document and conversation of the smallest tables."""

import glob
import os

import duckdb
import pytest

from evenfield.llm import base_columns
from evenfield.llm.conversation_repair import op13_conversation_repair

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables aren't here")


SQL = base_columns.SQL | {"op13_conversation_repair": base_columns.REPAIRS}


@pytest.mark.parametrize("query", [*base_columns.QUERIES, op13_conversation_repair], ids=lambda q: q.__name__)
def test_base_columns_equal_their_sql(spark, query):
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    found, expected = query(spark, DATA).toPandas(), con.execute(SQL[query.__name__]).fetchdf()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    told = lambda frame: sorted(tuple(format(x, ".9g") if isinstance(x, float) else str(x) for x in row) for row in frame[columns].itertuples(index=False))
    assert told(found) == told(expected)


def test_spans_that_fail_still_move_on():
    con = duckdb.connect()
    texts = ["token=ab token=abcdef", "secret: 'x' Secret='abcdefgh'", "ab " + "ab" * 12, None, "AKIA" + "A" * 15 + " AKIA" + "B" * 16]
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    counts = {r[0]: r[1:4] for r in con.execute(base_columns.SECRETS).fetchall()}
    assert counts == {0: (1, 0, 0), 1: (1, 0, 0), 2: (0, 0, 1), 3: (0, 0, 0), 4: (0, 1, 0)}
