"""Every registered query against its SQL on the smallest tables."""

import decimal

import pytest

from gableboard.plans import catalogue
from gableboard.plans.oracle import oracle_sql

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    return round(value, 6) if isinstance(value, float) else value


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(catalogue.queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = catalogue.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = db.execute(oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in cursor.fetchall()), key=repr)
