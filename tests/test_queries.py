"""Every registered survey query against its SQL on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from surveyloom.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(float(x) if type(x) is int else x for x in (plain(r[i]) for i in order)) for r in data], key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, DIR)
    got = duck.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, got.fetchall())
