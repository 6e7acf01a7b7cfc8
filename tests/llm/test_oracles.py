"""The operators' queries against SQL, on the driver's smallest tables."""

from pathlib import Path

import duckdb
import pytest

from adjudica.llm import queries

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df, rel = queries.QUERIES[name](spark, str(DATA)), duck.sql(queries.ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    want = sorted((tuple(row[rel.columns.index(c)] for c in cols) for row in rel.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == want
