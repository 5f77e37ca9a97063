"""Every query with an SQL twin gives the twin's rows."""

import math
import os

import duckdb
import pytest

from cellgrove.queries import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FUNCTIONS = {k: f for m in registry() for k, f in m.FUNCTIONS.items()}
SQL = {k: s for m in registry() for k, s in m.SQL.items()}


def rows(values):
    def one(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
        return repr(v)

    return sorted(tuple(one(v) for v in r) for r in values)


@pytest.fixture(scope="module")
def db(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return con


def test_names_match():
    assert set(SQL) <= set(FUNCTIONS)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, data, db, name):
    if not os.path.isdir(data):
        pytest.skip("no test tables")
    df = FUNCTIONS[name](spark, data)
    want = db.sql(SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    assert rows(map(tuple, df.select(*columns).collect())) == rows(want.select(*(f'"{c}"' for c in columns)).fetchall())


@pytest.mark.parametrize("name", sorted(set(FUNCTIONS) - set(SQL)))
def test_runs(spark, data, name):
    assert FUNCTIONS[name](spark, data).count() > 0
