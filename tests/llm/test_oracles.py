"""The queries that SQL can express, against that SQL on the small tables."""

import duckdb
import pytest
from helpers import SF

from millrace.llm import queries

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    want = duck.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    key = lambda row: tuple(map(str, row))
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=key) == sorted(want.fetchall(), key=key)
