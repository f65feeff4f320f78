"""Every core query against its SQL on the smallest tables."""

import decimal
import math
import os

import duckdb
import pytest

from tessera.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return float(v) if isinstance(v, decimal.Decimal) else v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = duck.sql(catalog.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    want = sorted((tuple(map(plain, r)) for r in duck.sql("select " + ", ".join(f'"{c}"' for c in cols) + f" from ({catalog.oracle_sql()[name]})").fetchall()), key=repr)
    assert got == want
