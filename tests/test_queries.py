import math
from pathlib import Path

import duckdb
import pytest

from adjudica import catalog

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v if v is None or isinstance(v, str | bool | int) else float(v)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df, rel = catalog.QUERIES[name](spark, str(DATA)), duck.sql(catalog.ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    want = sorted((tuple(plain(row[rel.columns.index(c)]) for c in cols) for row in rel.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr) == want
