"""Every registered query against its SQL oracle (DuckDB) on sf0.001:
same columns, same row count, same order-insensitive value hash."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from shelfwatch import queries as Q
from tests.conftest import TESTDATA
from tools.oracle_check import TABLES, digest

SF = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL oracle")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(want)
    assert digest(df.columns, rows) == digest(cols, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id_producto", "product", "date", "unit_price", "num", "num2", "variacion", "por_variacion"]
    assert df.count() > 0
