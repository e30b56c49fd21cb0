"""Every registered query against its SQL, values compared as multisets."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
from loomwork import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, small, duck, name):
    got = catalogue.QUERIES[name](spark, small)
    rows = Counter(tuple(plain(r[c]) for c in sorted(got.columns)) for r in got.collect())
    sql = catalogue.ORACLE_SQL.get(name)
    if sql is None:
        return
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    at = [names.index(c) for c in sorted(names)]
    assert rows == Counter(tuple(plain(r[k]) for k in at) for r in cur.fetchall())


def test_contract(spark):
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert entry_point.entry(spark).count() > 0
