"""Queries that SQL can express against their SQL, the others for their columns, on the smallest scale."""

import duckdb
import pytest

from tidemark.catalog import TABLES
from tidemark.llm.queries import catalog
from tools.oracle_check import _rows

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalog()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    assert _rows(cols, rows) == _rows(dcols, cur.fetchall())


def test_every_dealt_operator_has_a_query():
    assert {int(q[2:].split("_")[0]) for q in QUERIES if q != "pipeline"} == set(range(1, 14)) and set(ORACLE) <= set(QUERIES)
