"""Every registered query of the table operators against DuckDB over the same files."""

import os

import duckdb
import pytest

from tableflow.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(map(repr, r)) for r in df.select(*columns).collect())
    found = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    want = sorted(tuple(repr(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert sorted(names) == columns
    assert got == want
