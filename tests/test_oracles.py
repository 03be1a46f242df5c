"""Every registered query of the library against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from loomtext.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    other = duck.sql(sql)
    assert columns == sorted(other.columns)
    assert rows == sorted(tuple(map(plain, r)) for r in duck.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())
